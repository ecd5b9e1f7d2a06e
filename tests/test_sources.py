import os

import pytest

from tagweave.operators.staging import shared_folder, stage, stage_path, staged_run
from tagweave.sources.schemas import ORDERS, conform
from tagweave.sources.tables import (Buckets, CatalogTables, FileTables, FrameTables, JdbcTables,
                                     Split, check_unsplit, range_predicates)
from tagweave.sources.versions import VersionedFiles


@pytest.fixture
def tags(spark):
    return spark.createDataFrame([(2, "b"), (1, "a")], "userId bigint, tag string")


@pytest.mark.parametrize("form, options", [
    ("parquet", {}), ("json", {}), ("orc", {}), ("csv", {"header": "true"})])
def test_file_tables(spark, tags, tmp_path, rows, form, options):
    store = FileTables(spark, str(tmp_path), form, options=options)
    store.write(tags, "t")
    assert rows(store.read("t", tags.schema)) == [(1, "a"), (2, "b")]
    store.write(tags, "t", mode="append")
    assert store.read("t", tags.schema).count() == 4
    # An overwrite may be computed from the table it replaces.
    kept = store.read("t", tags.schema).distinct()
    store.write(kept, "t")
    assert rows(store.read("t", tags.schema)) == [(1, "a"), (2, "b")]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_sorted_tables_are_sorted_over_all_files(spark, tmp_path):
    store = FileTables(spark, str(tmp_path))
    numbers = spark.range(500, numPartitions=4).selectExpr("(id * 37) % 500 AS userId")
    store.write(numbers, "t", sort_by="userId")
    ranges = sorted(tuple(r) for r in store.read("t").groupBy("_metadata.file_path").agg(
        {"userId": "min"}).collect())
    files = [store.spark.read.parquet(path) for path, _ in ranges]
    seen = [r.userId for f in files for r in f.collect()]
    assert seen == list(range(500))


def test_a_failed_overwrite_keeps_the_table(spark, tags, tmp_path, rows):
    store = FileTables(spark, str(tmp_path))
    store.write(tags, "t")
    with pytest.raises(Exception, match="stop"):
        store.write(tags.selectExpr("userId", "raise_error('stop') AS tag"), "t")
    assert rows(store.read("t")) == [(1, "a"), (2, "b")]
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_a_large_table_without_a_split_is_refused():
    check_unsplit("t", 10, 10)
    with pytest.raises(ValueError, match="table t has 11 rows"):
        check_unsplit("t", 11, 10)


def test_a_large_table_is_cut_at_its_own_quantiles(spark):
    # A few keys have most of the rows' range, one has a tenth of the rows.
    rows = spark.range(10_000).selectExpr(
        "CASE WHEN id % 10 = 0 THEN 7 WHEN id % 97 = 0 THEN NULL ELSE pow(2, id % 900 / 20) END "
        "AS k", "id")
    rows.createOrReplaceTempView("skewed_keys")
    store = JdbcTables(spark, "jdbc:x", {}, keys={"skewed_keys": "k"}, unsplit_rows=1000)
    asked = []

    def load(self, options):
        asked.append(options["dbtable"])
        return spark.sql(f"SELECT * FROM {options['dbtable']}")

    try:
        object.__setattr__(store, "_load", load.__get__(store))
        predicates = store.cut("skewed_keys", 10_000)
        assert "NTILE(10)" in asked[0] and 9 <= len(predicates) <= 10
        held = [rows.filter(p).count() for p in predicates]
        assert sum(held) == 10_000 and max(held) <= 2100
        assert store.cut("skewed_keys", 900) == []
        with pytest.raises(ValueError, match="no key"):
            store.cut("other", 2000)
    finally:
        spark.catalog.dropTempView("skewed_keys")


def test_range_predicates_quote_texts():
    assert range_predicates("k", ["b", "a'c", "b"]) == [
        "k <= 'a''c' OR k IS NULL", "k > 'a''c'"]
    assert range_predicates("k", []) == range_predicates("k", [4]) == ["1 = 1"]


def test_jdbc_reads_are_split(spark):
    store = JdbcTables(spark, "jdbc:x://h/db", {"user": "u", "driver": "d"},
                       {"orders": Split("id", 1, 900, 48)})
    options = store.read_options("orders")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "48"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "900")
    assert options["url"] == "jdbc:x://h/db" and options["dbtable"] == "orders"
    assert "partitionColumn" not in store.read_options("small")


def test_jdbc_overwrite_keeps_the_table(spark):
    options = JdbcTables(spark, "jdbc:x", {"user": "u"}, batch_size=500).write_options("t")
    assert options["truncate"] == "true" and options["batchsize"] == "500"


def test_catalog_tables(spark, tags, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_tags")
    store = CatalogTables(spark, "shop_tags")
    store.write(tags, "tbl_a")
    store.write(tags.limit(1), "tbl_a")
    assert store.read("tbl_a").count() == 1
    store.write(tags, "tbl_a", mode="append")
    assert spark.table("shop_tags.tbl_a").count() == 3


def test_versioned_catalog_tables_swap_a_view(spark, tags, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions")
    store = CatalogTables(spark, "versions", versioned=True)
    store.write(tags, "tbl_a")
    before = store.read("tbl_a")
    # A new version may be computed from the one it replaces.
    store.write(store.read("tbl_a").filter("userId = 1"), "tbl_a")
    assert rows(store.read("tbl_a")) == [(1, "a")]
    assert before.count() == 2
    store.write(tags, "tbl_a", mode="append")
    assert store.read("tbl_a").count() == 3
    for _ in range(3):
        store.write(tags, "tbl_a")
    versions = [t.name for t in spark.catalog.listTables("versions")
                if t.name != "tbl_a" and not t.isTemporary]
    assert len(versions) == 2


def test_a_plain_table_becomes_the_first_version(spark, tags, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS plain")
    CatalogTables(spark, "plain").write(tags, "tbl_a")
    store = CatalogTables(spark, "plain", versioned=True)
    store.write(tags.limit(0), "tbl_a", mode="append")
    assert rows(store.read("tbl_a")) == [(1, "a"), (2, "b")]
    CatalogTables(spark, "plain").write(tags, "tbl_b")
    store.write(tags.filter("userId = 2"), "tbl_b")
    assert rows(store.read("tbl_b")) == [(2, "b")]


def test_a_failed_version_leaves_nothing(spark, tags):
    spark.sql("CREATE DATABASE IF NOT EXISTS failing")
    store = CatalogTables(spark, "failing", versioned=True)
    with pytest.raises(Exception, match="stop"):
        store.write(tags.selectExpr("userId", "raise_error('stop') AS tag"), "tbl_a")
    assert [t for t in spark.catalog.listTables("failing") if not t.isTemporary] == []


def test_frame_tables(tags):
    store = FrameTables({"t": tags})
    store.write(tags, "t", mode="append")
    assert store.read("t").count() == 4
    with pytest.raises(KeyError, match="no table 'x'"):
        store.read("x")


def test_conform_casts_declared_columns_only(spark):
    df = spark.createDataFrame([("5", "7.129", "k")], "memberId string, orderAmount string, x string")
    found = conform(df, ORDERS)
    assert dict(found.dtypes) == {"memberId": "bigint", "orderAmount": "decimal(12,2)",
                                  "x": "string"}
    assert conform(found, ORDERS) is found


def test_staged_data_lies_in_the_shared_folder(spark, tags, rows):
    staged = stage(tags, "tags")
    assert rows(staged) == rows(tags)
    assert all(f.startswith("file:" + shared_folder(spark).removeprefix("file:"))
               for f in (f.replace("file://", "file:") for f in staged.inputFiles()))


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = type("C", (), {"get": staticmethod(lambda key, default: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_a_rename_that_fails_puts_the_table_back(spark, tags, tmp_path, rows, monkeypatch):
    store = FileTables(spark, str(tmp_path))
    store.write(tags, "t")
    renames = []

    class Files:
        """The file system, whose second rename does nothing and says so."""

        def __init__(self, held):
            self.held = held

        def __getattr__(self, name):
            return getattr(self.held, name)

        def rename(self, a, b):
            renames.append(b.getName())
            return len(renames) != 2 and self.held.rename(a, b)

    class Path:
        def __init__(self, held):
            self.held = held

        def getFileSystem(self, conf):
            return Files(self.held.getFileSystem(conf))

    class Jvm:
        def __init__(self):
            self.org = self.apache = self.hadoop = self.fs = self

        def Path(self, text):
            path = spark._jvm.org.apache.hadoop.fs.Path(text)
            return Path(path) if not renames and text.endswith("/t") and Jvm.first() else path

        @staticmethod
        def first(seen=[]):
            seen.append(1)
            return len(seen) == 1

    class Session:
        _jvm, sparkContext = Jvm(), spark.sparkContext

    import dataclasses
    broken = dataclasses.replace(store, spark=Session())
    with pytest.raises(OSError, match="it is as it was"):
        broken.write(tags.limit(1), "t")
    assert rows(store.read("t")) == [(1, "a"), (2, "b")]
    assert len(renames) == 3


def test_versions_are_whole_and_kept(spark, tags, tmp_path, rows):
    store = VersionedFiles(spark, str(tmp_path))
    assert store.write(tags, "t") == 1
    before = store.read("t")
    # A version may be computed from the one before; readers of that keep it.
    assert store.write(store.read("t").filter("userId = 1"), "t") == 2
    assert rows(store.read("t")) == [(1, "a")] and rows(before) == [(1, "a"), (2, "b")]
    assert store.write(tags, "t", mode="append") == 3
    assert rows(store.read("t")) == [(1, "a"), (1, "a"), (2, "b")]
    assert rows(store.read("t", version=2)) == [(1, "a")]
    assert store.versions("t") == [2, 3]
    with pytest.raises(FileNotFoundError):
        store.read("t", version=1)
    with pytest.raises(FileExistsError):
        store.write(tags, "t", mode="error")
    for _ in range(4):
        store.write(tags, "t")
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2


def test_a_failed_version_is_not_there(spark, tags, tmp_path, rows):
    store = VersionedFiles(spark, str(tmp_path))
    store.write(tags, "t")
    with pytest.raises(Exception, match="stop"):
        store.write(tags.selectExpr("userId", "raise_error('stop') AS tag"), "t")
    assert store.versions("t") == [1] and rows(store.read("t")) == [(1, "a"), (2, "b")]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1


def test_a_commit_that_fails_leaves_the_last_version(spark, tags, tmp_path, rows, monkeypatch):
    store = VersionedFiles(spark, str(tmp_path))
    store.write(tags, "t")

    def broken(self, draft, target):
        raise OSError("no rename")

    monkeypatch.setattr(VersionedFiles, "_name", broken)
    with pytest.raises(OSError, match="no rename"):
        store.write(tags.limit(1), "t")
    monkeypatch.undo()
    assert rows(store.read("t")) == [(1, "a"), (2, "b")]


def test_a_second_writer_loses_nothing(spark, tags, tmp_path, rows, monkeypatch):
    store, second = VersionedFiles(spark, str(tmp_path)), VersionedFiles(spark, str(tmp_path))
    store.write(tags, "t")
    name = VersionedFiles._name
    raced = []

    def first_come(self, draft, target):
        if not raced:
            raced.append(1)
            second.write(tags.selectExpr("userId + 10 AS userId", "tag"), "t", mode="append")
        return name(self, draft, target)

    monkeypatch.setattr(VersionedFiles, "_name", first_come)
    assert store.write(tags.selectExpr("userId + 20 AS userId", "tag"), "t", mode="append") == 3
    assert [r[0] for r in rows(store.read("t"))] == [1, 2, 11, 12, 21, 22]


def test_taken_names_are_refused_by_other_file_systems_too(spark, tmp_path):
    store = VersionedFiles(spark, str(tmp_path))
    for text in ("a", "b", "c"):
        (tmp_path / text).write_text(text)

    other = type("Other", (), {"getScheme": staticmethod(lambda: "hdfs")})
    object.__setattr__(store, "_files", lambda path: other)
    assert store._name(f"file://{tmp_path}/a", f"file://{tmp_path}/new")
    assert not store._name(f"file://{tmp_path}/b", f"file://{tmp_path}/c")
    assert (tmp_path / "c").read_text() == "c" and (tmp_path / "new").read_text() == "a"


def test_bucketed_tables_lie_by_key(spark, tags, rows):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    store = CatalogTables(spark, "bucketed", buckets=Buckets("userId", 4))
    store.write(tags, "tbl_a")
    store.write(tags, "tbl_a", mode="append")
    assert rows(store.read("tbl_a")) == [(1, "a")] * 2 + [(2, "b")] * 2
    assert len(store.read("tbl_a").inputFiles()) <= 4
    store.write(spark.range(3).toDF("other"), "tbl_b", sort_by="other")
    with pytest.raises(ValueError, match="sorted by userId"):
        store.write(tags, "tbl_a", sort_by="tag")


def test_a_run_removes_what_it_staged(spark, tags, tmp_path):
    with staged_run(spark) as folder:
        with staged_run(spark) as inner:
            assert inner == folder
        found = stage(tags, "tags")
        assert all(folder.removeprefix("file:") in f for f in found.inputFiles())
        assert found.count() == 2
    assert not os.path.exists(folder.removeprefix("file:"))
    with staged_run(spark, FrameTables.lazy is False) as folder:
        kept = stage(tags, "tags")
    assert folder == shared_folder(spark) and kept.count() == 2
    assert shared_folder(spark) in stage_path(spark, "x")
