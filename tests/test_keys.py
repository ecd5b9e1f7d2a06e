"""Key filters, hot keys, and the sweep of many bands."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import keys, match, sweep
from tagweave.operators.match import range_match, salted_join
from tagweave.operators.metrics import sold_goods

BANDS = "name string, start int, end int"


def test_a_key_filter_loses_no_partner(spark):
    facts = spark.range(20_000).select(F.concat(F.lit("o"), F.col("id") % 5000).alias("k"), "id")
    kept = spark.range(0, 5000, 10).select(F.concat(F.lit("o"), F.col("id")).alias("key"))
    passed = keys.possible_matches(facts.union(spark.sql("SELECT NULL, 1L")), "k", kept, "key")
    right = facts.join(kept, facts["k"] == kept["key"], "left_semi")
    assert passed.join(kept, passed["k"] == kept["key"], "left_semi").count() == right.count() == 2000
    assert passed.count() < 2100
    plan = passed._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "Cartesian" not in plan


def test_too_many_keys_filter_nothing(spark, monkeypatch):
    monkeypatch.setattr(keys, "MOST_KEYS", 3)
    facts = spark.range(9).withColumnRenamed("id", "k")
    assert keys.possible_matches(facts, "k", facts.limit(5), "k") is facts


def test_hot_keys_are_counted(spark, rows):
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(
        F.col("id") % 3 == 1, F.lit("warm")).otherwise(F.col("id").cast("string")).alias("k"))
    facts = facts.union(spark.sql("SELECT CAST(NULL AS STRING)"))
    assert rows(keys.hot_keys(facts, ["k"], 900)) == [("hot", 1000), ("warm", 1000)]
    assert rows(keys.hot_keys(facts, ["k"], 1001)) == []


def test_an_order_with_a_third_of_all_items_is_split(spark, rows):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        goods = spark.range(9000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("cOrderSn"),
            F.concat(F.lit("c"), F.col("id") % 5).alias("ogColor"))
        orders = spark.range(0, 9000, 2).select((F.col("id") % 40).alias("memberId"),
                                                F.col("id").cast("string").alias("orderSn"))
        columns = {"colour": F.col("ogColor")}
        plain = sold_goods(goods, orders, columns)
        split = sold_goods(goods, orders, columns, few_orders=True, hot_items=1000)
        assert rows(split) == rows(plain)
        held = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        # Four partitions: none has much over its quarter.
        assert max(held) < 0.35 * sum(held)
        whole = [r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect()]
        assert max(whole) > 0.5 * sum(whole)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def apart(draw, n):
    """Bands that don't overlap, some next to each other, some far away."""
    bands, at = [], -3000
    for i in range(n):
        at += draw.choice([1, 1, 2, 30, 500])
        end = at + draw.choice([0, 0, 5, 80, 900])
        bands.append((f"b{i}", at, end))
        at = end
    return bands


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("half_open", [False, True])
def test_the_sweep_equals_all_comparisons(spark, rows, seed, half_open):
    draw = random.Random(seed)
    bands = apart(draw, 120)
    top = bands[-1][2]
    values = [draw.choice([float(draw.choice(bands)[1]), float(draw.choice(bands)[2]) + 0.5,
                           draw.uniform(-4000, top + 100), float(draw.choice(bands)[2])])
              for _ in range(400)] + [7.0] * 300 + [None, float("nan"), float("inf"), -float("inf")]
    users = spark.createDataFrame(list(enumerate(values)), "userId bigint, m double")
    frame = spark.createDataFrame([*bands, ("none", 9, 3)], BANDS)
    assert not sweep.overlapping(frame, "start", "end")
    right = [(u, v, next((n for n, lo, hi in bands if v is not None and (
        lo <= v < hi + 1 if half_open else lo <= v <= hi)), None)) for u, v in enumerate(values)]
    for how in ("inner", "left"):
        found = range_match(users, frame, "m", "band", how=how, half_open=half_open, limit=0)
        assert sorted(map(str, rows(found))) == sorted(
            str(r) for r in right if how == "left" or r[2] is not None)
        text = found._jdf.queryExecution().optimizedPlan().toString()
        # Each row is shuffled once, by the window's part: no join and no explosion of rows.
        assert "Join" not in text and text.count("Window") <= 2


@pytest.mark.parametrize("size", [50_000, 9])
def test_overlaps_are_seen_across_parts(spark, monkeypatch, size):
    monkeypatch.setattr(sweep, "PART_BANDS", size)
    draw = random.Random(9)
    for _ in range(3):
        bands = apart(draw, 60)
        i, j = sorted(draw.sample(range(60), 2))
        longer = [(n, lo, bands[j][1] if k == i else hi) for k, (n, lo, hi) in enumerate(bands)]
        assert sweep.overlapping(spark.createDataFrame(longer, BANDS).repartition(3), "start", "end")
    assert not sweep.overlapping(spark.createDataFrame([], BANDS), "start", "end")


def test_salted_joins_take_counted_keys(spark, rows):
    facts = spark.range(100).select((F.col("id") % 4).alias("k"))
    dim = spark.range(4).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    hot = keys.hot_keys(facts, ["k"], 25)
    assert rows(salted_join(facts, dim, ["k"], hot=hot)) == rows(facts.join(dim, "k"))
    assert match.HOT_KEYS >= 4
