import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[4]").appName("tagweave-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(folder / "shared"))
               .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""
    def sort_key(row):
        return tuple((value is None, str(type(value)), value) for value in row)

    return lambda df: sorted((tuple(r) for r in df.collect()), key=sort_key)
