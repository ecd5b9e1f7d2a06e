import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagweave.operators import metrics
from tagweave.operators.metrics import (log_metrics, mode_per_key, order_metrics,
                                        product_ratings, sold_goods, user_metrics)

ORDERS = ("memberId string, orderSn string, orderAmount string, couponCodeValue string, "
          "orderStatus int, paymentCode string, finishTime bigint")
AS_OF = "2024-01-31"


def epoch(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc).timestamp())


@pytest.fixture
def orders(spark):
    return spark.createDataFrame([
        ("1", "a", "100.00", "0", 0, "cod", epoch("2024-01-01T10:00:00")),
        ("1", "b", "50.50", "10.00", 1, "cod", epoch("2024-01-30T23:59:59")),
        ("1", "c", "49.50", None, None, "alipay", epoch("2024-01-02T00:00:00")),
        ("2", "d", "10.00", "0", 0, "wxpay", epoch("2024-01-31T01:00:00")),
        ("2", None, "20.00", "0.00", 2, "alipay", epoch("2023-12-31T00:00:00")),
        ("3", "e", "0.00", "0", 0, None, epoch("2024-02-03T00:00:00")),
    ], ORDERS)


def one(df, user):
    return df.filter(F.col("userId") == user).head().asDict()


def test_order_metrics(orders):
    found = order_metrics(orders, AS_OF)
    first, second, third = (one(found, u) for u in (1, 2, 3))
    assert first["consumerDays"] == 1 and second["consumerDays"] == 0
    assert third["consumerDays"] == -3
    assert first["unitPrice"] == pytest.approx(66.67)
    assert str(first["maxOrder"]) == "100.00"
    # A NULL order number is no order, but its money counts.
    assert (second["orderCount"], str(second["monetary"])) == (1, "30.00")
    assert (first["returnCount"], first["exchangeCount"]) == (1, 1)
    assert first["payment"] == "cod"
    assert second["payment"] == "alipay"          # a tie: the smaller code
    assert third["payment"] is None


def test_one_metric_equals_the_same_metric_of_all(orders, rows):
    everything = order_metrics(orders, AS_OF)
    for name in (*metrics.ORDER_METRICS, "payment"):
        assert rows(order_metrics(orders, AS_OF, [name])) == rows(
            everything.select("userId", name)), name


def test_one_metric_needs_only_its_fields(spark, rows):
    orders = spark.createDataFrame([("1", 5), ("1", 7)], "memberId string, orderStatus int")
    assert rows(order_metrics(orders, AS_OF, ["returnCount"])) == [(1, 0)]


def test_sums_behind_the_documented_averages(spark):
    # 248 orders that total 408084.29 average 1645.50, 41 a month.
    amounts = [("29", str(i), "1645.50") for i in range(247)]
    amounts.append(("29", "last", f"{408084.29 - 247 * 1645.50:.2f}"))
    orders = spark.createDataFrame(amounts, "memberId string, orderSn string, orderAmount string")
    found = one(order_metrics(orders, AS_OF, ["unitPrice", "buyFrequency"]), 29)
    assert found == {"userId": 29, "unitPrice": 1645.50, "buyFrequency": 41.0}


def test_buy_frequency_rounds_half_up(spark):
    orders = spark.createDataFrame([("1", str(i)) for i in range(9)],
                                   "memberId string, orderSn string")
    assert one(order_metrics(orders, AS_OF, ["buyFrequency"]), 1)["buyFrequency"] == 2.0


def test_price_sensitivity(spark):
    orders = spark.createDataFrame([
        ("1", "10", "0"), ("1", "30", "0"),              # never discounted
        ("2", "8", "2"), ("2", "5", "5"),                # always
        ("3", "10", None), ("3", "10", "10"),            # NULL coupon counts as one
        ("4", "0", "0"),                                 # no money at all
    ], "memberId string, orderAmount string, couponCodeValue string")
    found = {r.userId: r.psmScore for r in order_metrics(orders, AS_OF, ["psmScore"]).collect()}
    assert found[1] == found[4] == 1e-8
    assert found[2] == pytest.approx(1 + 7 / 20 + (7 / 2) / (20 / 2))
    # Receivable money skips the order with the NULL coupon.
    assert found[3] == pytest.approx(1 + 10 / 20 + (10 / 2) / (20 / 2))


def test_mode_per_key_is_deterministic(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (2, "x"), (2, "a"),
                                (3, None), (3, None), (3, "z"), (4, None), (4, "q")],
                               "k int, v string")
    assert rows(mode_per_key(df, "k", "v")) == [(1, "a"), (2, "x"), (3, None), (4, "q")]


def test_log_metrics(spark):
    moment = dt.datetime.fromisoformat
    logs = spark.createDataFrame([
        ("1", "/a", moment("2024-01-30T10:00:00")),
        ("1", "/a", moment("2024-01-02T10:30:00")),   # 29 days
        ("1", "/b", moment("2024-01-01T09:00:00")),   # 30 days
        ("1", None, moment("2023-12-31T09:00:00")),   # 31 days
        ("1", "/c", moment("2024-02-09T23:00:00")),   # later counts as recent
        ("2", "/a", moment("2023-01-01T05:00:00")),
    ], "global_user_id string, loc_url string, log_time timestamp_ntz")
    found = log_metrics(logs, AS_OF)
    assert one(found, 1) == {"userId": 1, "recentVisits": 3, "visitDays": -9,
                             "viewCount": 4, "pageCount": 3, "activeHour": 9}
    assert one(found, 2) == {"userId": 2, "recentVisits": 0, "visitDays": 395,
                             "viewCount": 1, "pageCount": 1, "activeHour": 5}
    for name in found.columns[1:]:
        assert one(log_metrics(logs, AS_OF, [name]), 1)[name] == one(found, 1)[name]


def test_user_metrics(spark):
    users = spark.createDataFrame([("7", 1, "1987-03-09", epoch("2024-01-01T12:00:00"))],
                                  "id string, gender int, birthday string, lastLoginTime bigint")
    found = user_metrics(users, AS_OF, ["gender", "bornDate", "loginDays"])
    assert one(found, 7) == {"userId": 7, "gender": "1", "bornDate": 19870309,
                             "loginDays": 30}


def test_a_user_id_that_is_no_number_fails(spark):
    orders = spark.createDataFrame([("x1", 0)], "memberId string, orderStatus int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        order_metrics(orders, AS_OF, ["returnCount"]).collect()


def test_rows_without_a_user_belong_to_nobody(spark):
    orders = spark.createDataFrame([(None, 0, "cod"), ("1", 0, "cod")],
                                   "memberId string, orderStatus int, paymentCode string")
    for names in (["returnCount"], ["payment"], ["returnCount", "payment"]):
        assert [r.userId for r in order_metrics(orders, AS_OF, names).collect()] == [1]


def test_product_ratings(spark, rows):
    logs = spark.createDataFrame(
        [("1", "s/product/5.html?a"), ("1", "s/product/5.html?b"), ("1", "s/x"),
         ("2", None), ("2", "s/product/6.html")], "global_user_id string, loc_url string")
    assert rows(product_ratings(logs)) == [(1, 5, 2)]


def test_sold_goods_pairs_every_item_with_every_order_row(spark, rows):
    goods = spark.createDataFrame([("a", "red", "t"), ("a", "red", "t"), ("b", "blue", "t"),
                                   ("z", "red", "t")],
                                  "cOrderSn string, ogColor string, productType string")
    orders = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b")],
                                   "memberId string, orderSn string")
    found = sold_goods(goods, orders, {"color": F.col("ogColor")})
    assert rows(found) == [(1, "red"), (1, "red"), (2, "blue"), (2, "blue")]


def test_a_hot_user_is_combined_before_the_shuffle(spark):
    plan = order_metrics(
        spark.createDataFrame([("1", 0)], "memberId string, orderStatus int"),
        AS_OF, ["returnCount"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan.split("Exchange")[1]


def test_a_hot_order_is_split_by_the_join(spark):
    goods = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        .alias("cOrderSn"), F.md5(F.col("id").cast("string")).alias("ogColor"))
    orders = spark.range(20000).select(
        F.col("id").cast("string").alias("memberId"),
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string"))
        .alias("orderSn"))
    changed = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
               "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
               "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        found = sold_goods(goods, orders, {"color": F.col("ogColor")})
        assert len(found.collect()) == 20000
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
