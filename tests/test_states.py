"""States that are merged day by day against one pass over all facts."""

import pytest
from pyspark.sql import functions as F

from tagweave.operators import metrics, states
from tagweave.sources.versions import VersionedFiles

AS_OF = "2024-01-31"


@pytest.fixture(scope="module")
def orders(spark):
    return spark.range(500).select(
        F.when(F.col("id") % 50 == 7, None).otherwise(F.col("id") % 9).alias("memberId"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).cast("string").alias("orderSn"),
        (F.col("id") % 77 + 0.25).alias("orderAmount"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3).alias("couponCodeValue"),
        (F.col("id") % 4).cast("int").alias("orderStatus"),
        F.when(F.col("id") % 6 == 0, None).otherwise(F.concat(F.lit("p"), F.col("id") % 7))
        .alias("paymentCode"), (1700000000 + F.col("id") * 4000).alias("finishTime"),
        (F.col("id") % 3).cast("string").alias("day"))


@pytest.fixture(scope="module")
def logs(spark):
    return spark.range(900).select(
        (F.col("id") % 13).alias("global_user_id"),
        F.when(F.col("id") % 17 == 0, None).otherwise(F.concat(F.lit("/p/"), F.col("id") % 60))
        .alias("loc_url"),
        (F.lit("2023-11-20").cast("timestamp_ntz") + F.make_dt_interval(F.col("id") % 75, F.col(
            "id") % 24)).alias("log_time"),
        (F.col("id") % 3).cast("string").alias("day"))


def whole(spark, tmp_path, facts, kept):
    store = VersionedFiles(spark, str(tmp_path))
    for day in "012":
        state = states.add_day(store, "s", facts.filter(F.col("day") == day), day, kept)
    assert states.added_days(state) == ["0", "1", "2"]
    return store, state


def test_orders_by_day_equal_one_pass(spark, tmp_path, orders, rows):
    store, state = whole(spark, tmp_path, orders, states.ORDERS_KEPT)
    right = metrics.order_metrics(orders, AS_OF)
    found = states.metrics_of(state, states.ORDERS_KEPT, AS_OF)
    assert rows(found.select(*right.columns)) == rows(right)
    assert rows(states.metrics_of(state, states.ORDERS_KEPT, AS_OF, ["monetary"])) == rows(
        right.select("userId", "monetary"))
    with pytest.raises(ValueError, match="1 is in the state s already"):
        states.add_day(store, "s", orders, "1", states.ORDERS_KEPT)


def test_logs_by_day_equal_one_pass(spark, tmp_path, logs, rows):
    _, state = whole(spark, tmp_path, logs, states.LOGS_KEPT)
    right = metrics.log_metrics(logs, AS_OF)
    found = states.metrics_of(state, states.LOGS_KEPT, AS_OF)
    assert rows(found.select(*right.columns)) == rows(right)
    # Counted to another day, without the logs.
    assert rows(states.metrics_of(state, states.LOGS_KEPT, "2024-02-20", ["recentVisits"])) == rows(
        metrics.log_metrics(logs, "2024-02-20", ["recentVisits"]))


def test_a_new_day_reads_only_its_facts(spark, tmp_path, orders):
    path = str(tmp_path / "facts")
    orders.write.partitionBy("day").parquet(path)
    store = VersionedFiles(spark, str(tmp_path / "states"))
    facts = spark.read.parquet(path)
    states.add_day(store, "s", facts.filter("day = 0"), "0", states.ORDERS_KEPT)
    second = states.merged([store.read("s"), states.state_of(
        facts.filter("day = 1"), states.ORDERS_KEPT).select(store.read("s").columns)],
        states.ORDERS_KEPT)
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(day") == plan.count(f"[file:{path}")
    assert f"[file:{path}" in plan


def test_a_new_day_reads_only_its_facts_in_any_folder(spark, tmp_path, orders):
    """Spark cuts a plan's paths after 100 characters unless told otherwise."""
    path = str(tmp_path / ("long" * 30) / "facts")
    orders.write.partitionBy("day").parquet(path)
    store = VersionedFiles(spark, str(tmp_path / "states"))
    facts = spark.read.parquet(path)
    states.add_day(store, "s", facts.filter("day = 0"), "0", states.ORDERS_KEPT)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        second = states.merged([store.read("s"), states.state_of(
            facts.filter("day = 1"), states.ORDERS_KEPT).select(store.read("s").columns)],
            states.ORDERS_KEPT)
        plan = second._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if f"[file:{path}" in line]
    assert scans
    for line in scans:
        filters = line.split("PartitionFilters: [")[1].split("]")[0]
        assert "isnotnull(day" in filters and " = 1)" in filters


def test_sketched_pages_merge(spark, tmp_path, logs, rows):
    _, state = whole(spark, tmp_path, logs, states.LOGS_SKETCHED)
    found = states.metrics_of(state, states.LOGS_SKETCHED, AS_OF)
    right = metrics.log_metrics(logs, AS_OF)
    assert rows(found.drop("pageCount").select([c for c in right.columns if c != "pageCount"])) == (
        rows(right.drop("pageCount")))
    pairs = found.select("userId", F.col("pageCount").alias("sketched")).join(right, "userId").collect()
    assert len(pairs) == 13 and all(abs(r["sketched"] - r["pageCount"]) <= 1 for r in pairs)
    many = spark.range(200_000).select(F.lit(1).alias("global_user_id"), F.col("id").cast(
        "string").alias("loc_url"), F.lit("2024-01-01").cast("timestamp_ntz").alias("log_time"))
    parts = [states.state_of(many.filter(f"id % 2 = {k}"), states.LOGS_SKETCHED) for k in (0, 1)]
    one = states.metrics_of(states.merged(parts, states.LOGS_SKETCHED), states.LOGS_SKETCHED,
                            AS_OF, ["pageCount"]).first()["pageCount"]
    assert abs(one - 200_000) < 0.05 * 200_000
