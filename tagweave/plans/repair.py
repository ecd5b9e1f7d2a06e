"""One-off jobs that bring raw tables into the shape the tags expect."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.functions.columns import from_epoch

# Highest member id, payment codes and their names, shifts in days.
MEMBERS = 950
PAYMENT_NAMES = {
    "alipay": "支付宝",
    "wxpay": "微信支付",
    "chinapay": "银联支付",
    "cod": "货到付款",
    "kjtpay": "快捷通",
    "giftCard": "礼品卡",
}
UNKNOWN_PAYMENT = "未知支付方式"
ORDER_SHIFT, LOG_SHIFT, LOGIN_SHIFT = 1640, 1670, 3067


def _spread(key: Column, buckets: int) -> Column:
    """0 .. buckets-1 by a digest of ``key``: even, and the same on every run,
    also when a lost task is repeated."""
    digest = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10)
    return F.pmod(digest.cast("bigint"), F.lit(buckets))


def shift_epoch(seconds: Column, days: int, to_midnight: bool) -> Column:
    """Later by whole days; ``to_midnight`` also drops the time of day."""
    if not to_midnight:
        return seconds + F.lit(days * 86400)
    return F.unix_timestamp(F.date_add(from_epoch(seconds).cast("date"), days))


def shift_moment(moment: Column, days: int, to_midnight: bool) -> Column:
    if to_midnight:
        return F.date_add(moment.cast("date"), days)
    return moment + F.make_interval(days=F.lit(days))


def repair_orders(orders: DataFrame, members: int = MEMBERS,
                  payments: Mapping[str, str] = PAYMENT_NAMES,
                  unknown: str = UNKNOWN_PAYMENT, days: int = ORDER_SHIFT,
                  to_midnight: bool = False) -> DataFrame:
    """Map member ids from ``members`` on into 1..members, replace unknown payment
    codes by one of the known, derive paymentName, and move finishTime.

    What replaces a value depends on the order number only, so the name always
    belongs to the code.
    """
    member = F.col("memberId").cast("bigint")
    order = F.col("orderSn")
    codes = F.array(*[F.lit(code) for code in payments])
    names = F.create_map(*[F.lit(v) for pair in payments.items() for v in pair])
    known = F.coalesce(F.col("paymentCode").isin(*payments), F.lit(False))
    replacement = F.element_at(
        codes, (_spread(F.concat(order.cast("string"), F.lit("|pay")), len(payments))
                + 1).cast("int"))
    return (orders
            .withColumn("memberId", F.when(member >= members,
                                           _spread(order, members) + 1)
                        .otherwise(member))
            .withColumn("paymentCode", F.when(known, F.col("paymentCode"))
                        .otherwise(replacement))
            .withColumn("paymentName", F.coalesce(names[F.col("paymentCode")],
                                                  F.lit(unknown)))
            .withColumn("finishTime", shift_epoch(F.col("finishTime"), days,
                                                  to_midnight)))


def shift_logs(logs: DataFrame, days: int = LOG_SHIFT,
               to_midnight: bool = False) -> DataFrame:
    return logs.withColumn("log_time", shift_moment(F.col("log_time"), days, to_midnight))


def shift_users(users: DataFrame, days: int = LOGIN_SHIFT,
                to_midnight: bool = False) -> DataFrame:
    return users.withColumn("lastLoginTime", shift_epoch(
        F.col("lastLoginTime"), days, to_midnight))
