"""Results that several later jobs read, written once to the shared folder.

A written table survives lost executors, where a cached one is computed again
from the fact tables, and keeps column pruning, where a checkpoint does not.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Where the package lies.
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package where the driver found it; a place that
    a node lacks does no harm there."""
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


#: Below the shared folder: the folder of the run that owns what is staged now.
_owner: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; in local mode, if none is named, one in the warehouse."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staged"
    context.setCheckpointDir(folder)
    return folder


@contextmanager
def staged_run(spark: SparkSession, written: bool = True) -> Iterator[str]:
    """What is staged inside the block lies in a folder of its own, which goes with it.

    For jobs that write their results; without ``written``, where they stay lazy, nothing is
    removed. One run at a time in a driver; a nested one belongs to the outer one.
    """
    if _owner or not written:
        yield _owner[0] if _owner else shared_folder(spark)
        return
    folder = f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"
    _owner.append(folder)
    try:
        yield folder
    finally:
        _owner.clear()
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder and all below it, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, label: str) -> str:
    """A new place in the shared folder."""
    folder = _owner[0] if _owner else shared_folder(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there."""
    path = stage_path(df.sparkSession, label)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_database(spark: SparkSession, label: str) -> str:
    """A new database of the catalog whose tables lie in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{stage_path(spark, name)}'")
    return name
