"""Per-user metrics, each fact table aggregated once for all tags that need it.

A metric is an expression over *measures*, sums, counts and maxima. A call
computes only the measures its metrics need, so one tag reads two columns of the
orders, and the full profile still aggregates them once.

Every aggregate has a map-side part, so a user with a third of all rows reaches
the shuffle as one row per map task. Rows without a user id belong to no user.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.functions.columns import (as_of_date, birth_number, days_since,
                                        from_epoch, product_id)
from tagweave.operators.keys import hot_keys, possible_matches
from tagweave.operators.match import salted_join
from tagweave.sources.schemas import GOODS, LOGS, ORDERS, USERS, conform

AsOf = dt.date | str | None

# Order states, the span order counts are averaged over, the age
# limit of a recent visit, and the score of a user without a discounted order.
RETURNED, EXCHANGED = 0, 1
MONTHS = 6
RECENT_DAYS = 30
NO_DISCOUNT_SCORE = 1e-8


@dataclass(frozen=True)
class Measure:
    """An aggregate over fact rows and the one that merges two such results."""

    over_rows: Callable[[AsOf], Column]
    merge: Callable[[str], Column] = F.sum


@dataclass(frozen=True)
class Metric:
    """A per-user value and the measures it is made of."""

    measures: tuple[str, ...]
    value: Callable[[AsOf], Column]


def _count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def _price_sensitivity() -> Column:
    """Share of discounted orders + share of money discounted + how deep the
    average discount is against the average order. A user without a discounted
    order has no average discount and gets a fixed small score."""
    orders, discounted, receivable, discount = (
        F.col(c).cast("double") for c in ("rows", "discounted", "receivable", "discount"))
    depth = F.try_divide(F.try_divide(discount, discounted),
                         F.try_divide(receivable, orders))
    score = (F.try_divide(discounted, orders) + F.try_divide(discount, receivable)
             + depth)
    return F.coalesce(score, F.lit(NO_DISCOUNT_SCORE))


ORDER_MEASURES: Mapping[str, Measure] = {
    "rows": Measure(lambda as_of: F.count("*")),
    "orders": Measure(lambda as_of: F.count("orderSn")),
    "amount": Measure(lambda as_of: F.sum("orderAmount")),
    "top_amount": Measure(lambda as_of: F.max("orderAmount"), F.max),
    "last_finish": Measure(lambda as_of: F.max("finishTime"), F.max),
    "returned": Measure(lambda as_of: _count_where(F.col("orderStatus") == RETURNED)),
    "exchanged": Measure(lambda as_of: _count_where(F.col("orderStatus") == EXCHANGED)),
    # A NULL coupon is not equal to 0 and so makes its order a discounted one.
    "discounted": Measure(lambda as_of: F.sum(
        F.when(F.col("couponCodeValue") == 0, 0).otherwise(1))),
    "discount": Measure(lambda as_of: F.sum("couponCodeValue")),
    "receivable": Measure(lambda as_of: F.sum(
        F.col("orderAmount") + F.col("couponCodeValue"))),
}

ORDER_METRICS: Mapping[str, Metric] = {
    "consumerDays": Metric(("last_finish",), lambda as_of: days_since(
        as_of, from_epoch(F.col("last_finish")))),
    # Rounded as a decimal: the two engines' rounding of doubles differs.
    "unitPrice": Metric(("amount", "rows"), lambda as_of: F.round(
        F.try_divide(F.col("amount"), F.col("rows")), 2).cast("double")),
    "maxOrder": Metric(("top_amount",), lambda as_of: F.col("top_amount")),
    "buyFrequency": Metric(("orders",), lambda as_of: F.round(
        F.col("orders") / F.lit(MONTHS), 0)),
    "returnCount": Metric(("returned",), lambda as_of: F.col("returned")),
    "exchangeCount": Metric(("exchanged",), lambda as_of: F.col("exchanged")),
    "orderCount": Metric(("orders",), lambda as_of: F.col("orders")),
    "monetary": Metric(("amount",), lambda as_of: F.col("amount")),
    "psmScore": Metric(("rows", "discounted", "receivable", "discount"),
                       lambda as_of: _price_sensitivity()),
}

LOG_MEASURES: Mapping[str, Measure] = {
    "views": Measure(lambda as_of: F.count("loc_url")),
    "last_visit": Measure(lambda as_of: F.max("log_time"), F.max),
    # Fewer than the limit of calendar days old, as one comparison with the first
    # such day. Visits after ``as_of`` count as recent too.
    "recent": Measure(lambda as_of: _count_where(
        F.col("log_time") >= F.date_sub(as_of_date(as_of), RECENT_DAYS - 1)
        .cast("timestamp_ntz"))),
}

LOG_METRICS: Mapping[str, Metric] = {
    "recentVisits": Metric(("recent",), lambda as_of: F.col("recent")),
    "visitDays": Metric(("last_visit",), lambda as_of: days_since(
        as_of, F.col("last_visit"))),
    "viewCount": Metric(("views",), lambda as_of: F.col("views")),
}

USER_CODES = ("gender", "job", "politicalFace", "marriage", "nationality",
              "is_blackList")


def user_metrics(users: DataFrame, as_of: AsOf = None,
                 names: Iterable[str] | None = None) -> DataFrame:
    """userId with its attribute codes, birth number and days since login."""
    names = list(names or (*USER_CODES, "bornDate", "loginDays"))
    users = conform(users, USERS)
    derived = {
        "bornDate": lambda: birth_number(F.col("birthday")),
        "loginDays": lambda: days_since(as_of, from_epoch(F.col("lastLoginTime"))),
    }
    return _by_user(users, "id").select("userId", *[
        derived[n]().alias(n) if n in derived else F.col(n) for n in names])


def order_metrics(orders: DataFrame, as_of: AsOf = None,
                  names: Iterable[str] | None = None) -> DataFrame:
    """userId with the named metrics of ``ORDER_METRICS``, and ``payment``, the
    payment code used most.

    Codes are counted in a pass of their own over two columns: counting them
    along would carry every measure through the shuffle once per user and code.
    """
    names = list(names or (*ORDER_METRICS, "payment"))
    orders = _by_user(conform(orders, ORDERS), "memberId")
    plain = [n for n in names if n != "payment"]
    parts = []
    if plain:
        parts.append(_metrics(orders, ORDER_MEASURES, ORDER_METRICS, plain, as_of))
    if "payment" in names:
        parts.append(mode_per_key(orders.withColumnRenamed("paymentCode", "payment"),
                                  "userId", "payment"))
    return _joined(parts, names)


def log_metrics(logs: DataFrame, as_of: AsOf = None,
                names: Iterable[str] | None = None) -> DataFrame:
    """userId with the named metrics of ``LOG_METRICS``, ``pageCount`` (different
    pages seen) and ``activeHour`` (the hour of day with most visits).

    Pages are counted by grouping on user and page first: no set of pages is
    ever held for one user.
    """
    names = list(names or (*LOG_METRICS, "pageCount", "activeHour"))
    logs = _by_user(conform(logs, LOGS), "global_user_id")
    plain = [n for n in names if n in LOG_METRICS]
    parts = []
    if "pageCount" in names:
        parts.append(_metrics(logs, LOG_MEASURES, LOG_METRICS, plain, as_of,
                              count_different={"pageCount": "loc_url"}))
    elif plain:
        parts.append(_metrics(logs, LOG_MEASURES, LOG_METRICS, plain, as_of))
    if "activeHour" in names:
        parts.append(mode_per_key(
            logs.select("userId", F.hour("log_time").alias("activeHour")),
            "userId", "activeHour"))
    return _joined(parts, names)


def mode_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent ``value`` per ``key``; the smaller value wins a tie, and
    any value wins over NULL.

    The winner is a minimum over counted values, which is combined before the
    shuffle, unlike a ranking window.
    """
    first = F.min(F.struct((-F.col("_n")).alias("_less"),
                           F.col(value).isNull().alias("_null"),
                           F.col(value).alias("_value")))
    return (df.groupBy(key, value).agg(F.count("*").alias("_n"))
            .groupBy(key).agg(first["_value"].alias(value)))


def _by_user(df: DataFrame, key: str) -> DataFrame:
    return df.withColumnRenamed(key, "userId").filter("userId IS NOT NULL")


def _joined(parts: list[DataFrame], names: list[str]) -> DataFrame:
    # Each part is an aggregate by user, so it is already partitioned for the join.
    return reduce(lambda a, b: a.join(b, "userId"), parts).select("userId", *names)


def _metrics(df: DataFrame, measures: Mapping[str, Measure],
             metrics: Mapping[str, Metric], names: list[str], as_of: AsOf,
             count_different: Mapping[str, str] | None = None) -> DataFrame:
    wanted = dict.fromkeys(m for n in names for m in metrics[n].measures)
    over_rows = [measures[m].over_rows(as_of).alias(m) for m in wanted]
    different = {}
    if count_different:
        (out, column), = count_different.items()
        df = df.groupBy("userId", column).agg(*over_rows) if over_rows else df.select(
            "userId", column).distinct()
        over_rows = [measures[m].merge(m).alias(m) for m in wanted]
        different = {out: F.count(column)}
    grouped = df.groupBy("userId").agg(
        *over_rows, *[c.alias(out) for out, c in different.items()])
    return grouped.select("userId", *[metrics[n].value(as_of).alias(n) for n in names],
                          *different)


def product_ratings(logs: DataFrame) -> DataFrame:
    """(userId, productId, rating): visits of each user to each product page."""
    logs = conform(logs, LOGS)
    # The plain text test spares most pages the pattern.
    return (_by_user(logs, "global_user_id")
            .filter(F.col("loc_url").contains("/product/"))
            .select("userId",
                    product_id(F.col("loc_url")).cast("bigint").alias("productId"))
            .filter("productId IS NOT NULL")
            .groupBy("userId", "productId")
            .agg(F.count("*").cast("int").alias("rating")))


def sold_goods(goods: DataFrame, orders: DataFrame, columns: Mapping[str, Column],
               few_orders: bool = False, hot_items: int | None = None) -> DataFrame:
    """userId and the given columns for each item of an order.

    Both sides of the join are facts, so neither is broadcast, and only the short coded
    columns leave it. Adaptive execution splits an order that holds very many
    items; with ``hot_items`` orders of that many are counted and split beforehand. With
    ``few_orders`` items of other orders are mostly dropped before the shuffle.
    """
    items = conform(goods, GOODS).select(
        "cOrderSn", *[c.alias(name) for name, c in columns.items()])
    owners = _by_user(conform(orders, ORDERS), "memberId").select(
        "userId", F.col("orderSn").alias("cOrderSn"))
    if few_orders:
        items = possible_matches(items, "cOrderSn", owners, "cOrderSn")
    if hot_items is None:
        return items.join(owners, "cOrderSn").select("userId", *columns)
    return salted_join(items, owners, ["cOrderSn"], hot=hot_keys(
        items, ["cOrderSn"], hot_items)).select("userId", *columns)
