import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagweave.functions import columns as c
from tagweave.operators.cluster import RFE_BANDS, RFM_BANDS


def values(spark, rows, schema, *expressions):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(
        *expressions).collect()]


def test_product_id(spark):
    urls = ["http://s/product/10217.html?from=1", "http://s/product/1.html",
            "http://s/product/x.html?a", "http://s/list", "/product/5.html?a", None]
    found = values(spark, [(u,) for u in urls], "u string", c.product_id(F.col("u")))
    assert [v[0] for v in found] == ["10217", None, None, None, None, None]


def test_birth_number(spark):
    found = values(spark, [("1987-03-09",), ("unknown",), (None,)], "b string",
                   c.birth_number(F.col("b")))
    assert [v[0] for v in found] == [19870309, None, None]


def test_range_bounds(spark):
    found = values(spark, [("100-199",), ("7",), ("a-b",), (None,)], "r string",
                   c.range_bounds(F.col("r")).alias("r"))
    assert [tuple(v[0]) for v in found] == [(100, 199), (None, None), (None, None),
                                           (None, None)]


@pytest.mark.parametrize("value, score", [
    (0, None), (1, 5.0), (3, 5.0), (4, 4.0), (6, 4.0), (7, 3.0), (9, 3.0), (10, 2.0),
    (15, 2.0), (16, 1.0), (999, 1.0), (-1, None), (None, None)])
def test_recency_band_edges(spark, value, score):
    found = values(spark, [(value,)], "v int",
                   c.band_score(F.col("v"), RFM_BANDS["r_score"]))
    assert found == [(score,)]


@pytest.mark.parametrize("value, score", [
    ("9999.99", 1.0), ("10000.00", 2.0), ("49999.00", 2.0), ("49999.50", None),
    ("50000.00", 3.0), ("199999.00", 4.0), ("200000.00", 5.0)])
def test_money_band_edges_and_holes(spark, value, score):
    found = values(spark, [(value,)], "v string", c.band_score(
        F.col("v").cast("decimal(22,2)"), RFM_BANDS["m_score"]))
    assert found == [(score,)]


def test_band_scores_run_from_1_to_5():
    for bands in (RFM_BANDS, RFE_BANDS):
        for rows in bands.values():
            assert sorted(score for _, _, score in rows) == [1, 2, 3, 4, 5]


def test_vocabulary_code(spark):
    found = values(spark, [("b",), ("z",), (None,)], "w string",
                   c.vocabulary_code(F.col("w"), ["a", "b"]))
    assert [v[0] for v in found] == [2, 0, 0]


def test_slots_pad_with_null(spark):
    found = values(spark, [([5, 4, 3, 2, 1],), ([9, 8],)], "a array<int>",
                   *c.slots(F.col("a"), ["t1", "t2", "t3", "t4", "t5"]))
    assert found == [(5, 4, 3, 2, 1), (9, 8, None, None, None)]


@pytest.mark.parametrize("total, zeros, ones, vote", [
    (4, 2, 2, "0"), (3, 3, 0, "0"), (3, 0, 3, "1"), (5, 2, 3, "1"), (4, 1, 1, "-1"),
    (0, 0, 0, "-1")])
def test_share_vote(spark, total, zeros, ones, vote):
    found = values(spark, [(total, zeros, ones)], "t int, z int, o int",
                   c.share_vote(F.col("t"), F.col("z"), F.col("o")))
    assert found == [(vote,)]


def test_days_since_counts_calendar_days(spark):
    moment = dt.datetime(2024, 1, 30, 23, 59, 59)
    found = values(spark, [(moment,)], "t timestamp_ntz",
                   c.days_since("2024-01-31", F.col("t")))
    assert found == [(1,)]
    today = values(spark, [(1,)], "x int", c.days_since(None, F.current_date()))
    assert today == [(0,)]
