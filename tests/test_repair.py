import datetime as dt

from pyspark.sql import functions as F

from tagweave.plans import repair

NOON = int(dt.datetime(2019, 5, 6, 13, 14, 15, tzinfo=dt.timezone.utc).timestamp())
MIDNIGHT = NOON - (13 * 3600 + 14 * 60 + 15)


def orders(spark):
    rows = [(str(i), f"sn{i}", ["alipay", "ccb", None, "cod"][i % 4], NOON)
            for i in range(1, 2001)]
    return spark.createDataFrame(
        rows, "memberId string, orderSn string, paymentCode string, finishTime bigint")


def test_orders(spark):
    fixed = repair.repair_orders(orders(spark)).cache()
    assert fixed.count() == 2000
    assert fixed.agg(F.min("memberId"), F.max("memberId")).head() == (1, 950)
    kept = fixed.filter("memberId = CAST(substr(orderSn, 3) AS INT)")
    assert kept.count() >= 949
    codes = {r.paymentCode: r.paymentName
             for r in fixed.select("paymentCode", "paymentName").distinct().collect()}
    assert codes == repair.PAYMENT_NAMES
    assert fixed.filter("CAST(substr(orderSn, 3) AS INT) % 4 = 0 AND paymentCode != 'alipay'"
                        ).count() == 0
    assert {r[0] for r in fixed.select("finishTime").distinct().collect()} == {
        NOON + 1640 * 86400}


def test_orders_are_repaired_the_same_in_any_layout(spark, rows):
    once = repair.repair_orders(orders(spark))
    assert rows(once) == rows(repair.repair_orders(orders(spark).repartition(7)))


def test_replacements_are_spread_evenly(spark):
    ids = repair.repair_orders(spark.range(200000).select(
        F.lit(5000).alias("memberId"), F.col("id").alias("orderSn"),
        F.lit("x").alias("paymentCode"), F.lit(0).cast("bigint").alias("finishTime")))
    assert ids.select("memberId").distinct().count() == 950
    shares = [r["count"] for r in ids.groupBy("paymentCode").count().collect()]
    assert len(shares) == 6 and max(shares) < 1.1 * min(shares)


def test_unknown_names(spark):
    fixed = repair.repair_orders(orders(spark).limit(1), payments={"a": "A"}, unknown="?")
    assert fixed.head().paymentName == "A"


def test_shifts_keep_or_drop_the_time_of_day(spark):
    users = spark.createDataFrame([(1, NOON)], "id int, lastLoginTime bigint")
    assert repair.shift_users(users).head().lastLoginTime == NOON + 3067 * 86400
    assert repair.shift_users(users, to_midnight=True).head().lastLoginTime == (
        MIDNIGHT + 3067 * 86400)
    logs = spark.createDataFrame([(dt.datetime(2019, 5, 6, 13, 14, 15),)],
                                 "log_time timestamp_ntz")
    shifted = dt.datetime(2019, 5, 6, 13, 14, 15) + dt.timedelta(days=1670)
    assert repair.shift_logs(logs).head().log_time == shifted
    assert repair.shift_logs(logs, to_midnight=True).head().log_time == shifted.date()
