import random

import pytest

from tagweave.operators import match
from tagweave.operators.match import code_match, range_match, salted_join

BANDS = "name string, start int, end int"


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(1, 0), (2, 1), (3, 7), (4, None), (5, 1)],
                                 "userId bigint, gender int")


@pytest.fixture
def rules(spark):
    return spark.createDataFrame([("male", "0"), ("female", "1"), ("odd", "n/a")],
                                 "name string, rule string")


@pytest.mark.parametrize("limit", [100, 0], ids=["broadcast", "salted"])
def test_code_match_drops_unmatched_and_null_codes(users, rules, rows, limit):
    named = code_match(users, rules, "gender", "gender", limit=limit)
    assert named.columns == ["userId", "gender"]
    assert rows(named) == [(1, "male"), (2, "female"), (5, "female")]


@pytest.mark.parametrize("limit", [100, 0], ids=["broadcast", "salted"])
def test_code_match_left_keeps_everyone(users, rules, rows, limit):
    named = code_match(users, rules, "gender", "name", how="left", limit=limit)
    assert rows(named) == [(1, "male"), (2, "female"), (3, None), (4, None), (5, "female")]


@pytest.mark.parametrize("limit", [100, 0], ids=["broadcast", "blocks"])
def test_range_match_is_closed_and_drops_gaps(spark, rows, limit):
    bands = spark.createDataFrame([("a", 0, 9), ("b", 10, 19), ("c", 30, 30)], BANDS)
    users = spark.createDataFrame(
        [(1, 0.0), (2, 9.0), (3, 9.5), (4, 10.0), (5, 19.0), (6, 25.0), (7, 30.0),
         (8, -1.0), (9, None)], "userId bigint, m double")
    closed = range_match(users, bands, "m", "band", keep_metric=False, limit=limit)
    assert rows(closed) == [(1, "a"), (2, "a"), (4, "b"), (5, "b"), (7, "c")]
    stretched = range_match(users, bands, "m", "band", False, half_open=True, limit=limit)
    assert (3, "a") in rows(stretched)
    kept = range_match(users, bands, "m", "band", False, how="left", limit=limit)
    assert kept.count() == 9


def test_range_match_duplicates_a_user_of_overlapping_bands(spark, rows):
    bands = spark.createDataFrame([("a", 0, 10), ("b", 5, 20)], BANDS)
    users = spark.createDataFrame([(1, 7)], "userId bigint, m int")
    assert rows(range_match(users, bands, "m", "band")) == [(1, 7, "a"), (1, 7, "b")]


def test_range_match_on_decimals(spark, rows):
    bands = spark.createDataFrame([("a", 0, 2147483647)], BANDS)
    users = spark.createDataFrame([(1, "12.34")], "userId bigint, m string").selectExpr(
        "userId", "CAST(m AS DECIMAL(12,2)) AS m")
    assert [r[0] for r in range_match(users, bands, "m", "band").collect()] == [1]


@pytest.mark.parametrize("seed", range(3))
def test_many_bands_agree_with_brute_force(spark, rows, seed):
    draw = random.Random(seed)
    bands = []
    for i in range(60):
        start = draw.choice([draw.randrange(50), draw.randrange(5000), -draw.randrange(80),
                             -draw.randrange(2 ** 31), draw.randrange(2 ** 31 - 1)])
        end = min(2 ** 31 - 1, start + draw.choice([0, 3, 40, 700, 10 ** 6, 2 ** 30]))
        bands.append((f"b{i}", start, end))
    users = [(i, draw.choice([float(draw.randrange(60)), draw.random() * 5500,
                              draw.random() * 2 ** 31, float(draw.choice(bands)[2]),
                              float(draw.choice(bands)[1]), -3.0, -draw.random() * 90,
                              -draw.random() * 2 ** 31]))
             for i in range(300)]
    expected = sorted((u, m, name) for u, m in users for name, lo, hi in bands
                      if lo <= m <= hi)
    for limit in (256, 0):
        for how in ("inner", "left"):
            found = range_match(spark.createDataFrame(users, "userId bigint, m double"),
                                spark.createDataFrame(bands, BANDS), "m", "band", how=how,
                                limit=limit)
            got = rows(found)
            assert [r for r in got if r[2] is not None] == expected
            bare = {u for u, _ in users} - {u for u, _, _ in expected}
            assert [r[0] for r in got if r[2] is None] == (sorted(bare) if how == "left" else [])


@pytest.mark.parametrize("limit", [256, 0], ids=["broadcast", "blocks"])
def test_negative_values_meet_negative_bands(spark, rows, limit):
    bands = spark.createDataFrame([("a", -10, -1), ("b", 0, 2), ("c", 3, 9)], BANDS)
    users = spark.createDataFrame([(1, -5), (2, -1), (3, 0), (4, 3), (5, -2147483648)],
                                  "userId bigint, m int")
    assert rows(range_match(users, bands, "m", "band", limit=limit)) == [
        (1, -5, "a"), (2, -1, "a"), (3, 0, "b"), (4, 3, "c")]
    left = range_match(users, bands, "m", "band", how="left", limit=limit)
    assert (5, -2147483648, None) in rows(left)


def test_blocks_cover_a_band_exactly_once(spark):
    bands = spark.createDataFrame([("x", 3, 70000)], BANDS)
    blocks = match._cover(bands, "start", "end").collect()
    numbers = [n for b in blocks
               for n in range(b._block * 16 ** b._size, (b._block + 1) * 16 ** b._size)]
    assert sorted(n - 2 ** 31 for n in numbers) == list(range(3, 70001))
    assert len(blocks) <= 240


def test_salting_spreads_a_hot_key_and_keeps_all_rows(spark, rows):
    from pyspark.sql import functions as F
    # Four fifths of the rows have one key, and all rows of it are equal.
    facts = spark.range(0, 4000, numPartitions=16).select(
        F.when(F.col("id") % 5 == 0, F.col("id")).otherwise(1).alias("k"))
    dim = spark.createDataFrame([(1, "hot"), (2, "cold"), (5, "cool")], "k long, name string")
    joined = salted_join(facts, dim, ["k"], salts=8, hot_rows=1000)
    assert rows(joined.groupBy("name").count()) == [("cool", 1), ("hot", 3200)]
    assert salted_join(facts, dim, ["k"], "left", salts=8, hot_rows=1000).count() == 4000
    parts = (facts.filter("k = 1").select(F.pmod(F.xxhash64("k", F.spark_partition_id()), F.lit(8))
                                          .alias("s")).groupBy("s").count().collect())
    assert len(parts) > 3


def test_lookup_checks_the_size_before_it_broadcasts(spark):
    facts = spark.range(10).withColumnRenamed("id", "k")
    dim = spark.range(5).withColumnRenamed("id", "k")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" not in plan(match.lookup(facts, dim, ["k"], limit=5))
    assert "strategy=merge" in plan(match.lookup(facts, dim, ["k"], limit=4))


def test_few_rules_as_expressions_equal_the_join(spark, rows):
    from pyspark.sql import functions as F

    users = spark.createDataFrame([(i, float(m)) for i, m in enumerate(
        [-11, -10, -1, -0.5, 0, 2, 2.5, 3, 9, 9.5, 10])] + [(99, None)], "userId bigint, m double")
    bands = [("a", -10, -1), ("b", 0, 2), ("c", 3, 9)]
    for half_open in (False, True):
        joined = range_match(users, spark.createDataFrame(bands, BANDS), "m", "band", how="left",
                             half_open=half_open)
        assert rows(users.withColumn("band", match.band_name(F.col("m"), bands, half_open))) == (
            rows(joined))
    codes = [("x", "1"), ("y", "2"), ("z", None)]
    named = spark.createDataFrame([(1,), (3,), (None,)], "c int").withColumn(
        "name", match.code_name(F.col("c"), codes))
    assert rows(named) == [(1, "x"), (3, None), (None, None)]
