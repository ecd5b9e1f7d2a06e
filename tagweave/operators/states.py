"""What metrics need of each user, kept from day to day and merged with a new day's.

A state is one table of user rows: sums, counts and maxima under the kind ``sums``, and
under other kinds how often a value occurred, for the most frequent code or hour, recent
days and different pages. All columns merge, so the state of two days is the merge of
their states, and a day's work reads that day's facts and the state, not the facts before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.functions.columns import as_of_date
from tagweave.operators import metrics
from tagweave.operators.metrics import AsOf, Measure, Metric
from tagweave.sources.schemas import LOGS, ORDERS, conform

SUMS, DAY_ADDED = "sums", "added"
#: Bits of the register index of a page sketch: 4,096 registers, 1.6 % standard error.
SKETCH_BITS = 12


@dataclass(frozen=True)
class Kept:
    """What is kept of one fact table: plain measures, and values counted by kind."""

    measures: Mapping[str, Measure]
    values: Mapping[str, Callable[[], Column]]
    user: str
    schema: object
    metrics: Mapping[str, Metric]


ORDERS_KEPT = Kept(metrics.ORDER_MEASURES, {"payment": lambda: F.col("paymentCode")},
                   "memberId", ORDERS, metrics.ORDER_METRICS)
LOGS_KEPT = Kept(
    {name: measure for name, measure in metrics.LOG_MEASURES.items() if name != "recent"},
    {"activeHour": lambda: F.hour("log_time").cast("string"),
     "day": lambda: F.to_date("log_time").cast("string"), "page": lambda: F.col("loc_url")},
    "global_user_id", LOGS, metrics.LOG_METRICS)
#: The same with a sketch of each user's pages in place of the pages.
LOGS_SKETCHED = Kept(
    {**LOGS_KEPT.measures, "pages": Measure(
        lambda as_of: F.hll_sketch_agg("loc_url", F.lit(SKETCH_BITS)), F.hll_union_agg)},
    {kind: value for kind, value in LOGS_KEPT.values.items() if kind != "page"},
    "global_user_id", LOGS, metrics.LOG_METRICS)


def state_of(facts: DataFrame, kept: Kept) -> DataFrame:
    """(userId, kind, value, n, measures...) of fact rows; rows without a user have none."""
    rows = metrics._by_user(conform(facts, kept.schema), kept.user)
    sums = rows.groupBy("userId").agg(
        F.count("*").alias("n"), *[m.over_rows(None).alias(name)
                                   for name, m in kept.measures.items()])
    sums = sums.withColumns({"kind": F.lit(SUMS), "value": F.lit(None).cast("string")})
    counts = [rows.groupBy("userId", value().alias("value")).agg(F.count("*").alias("n"))
              .withColumn("kind", F.lit(kind)) for kind, value in kept.values.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sums, *counts])


def merged(states: Iterable[DataFrame], kept: Kept) -> DataFrame:
    """One state of several."""
    whole = reduce(DataFrame.unionByName, states)
    # A sketch is merged only where there is one; counted values have none.
    return whole.groupBy("userId", "kind", "value").agg(
        F.sum("n").alias("n"), *[m.merge(name).alias(name) for name, m in kept.measures.items()])


def added_days(state: DataFrame) -> list[str]:
    """Days that a state has seen."""
    return sorted(r["value"] for r in state.filter(F.col("kind") == DAY_ADDED).collect())


def add_day(store, name: str, facts: DataFrame, day: str, kept: Kept) -> DataFrame:
    """Merge one day's facts into the state table ``name`` of ``store``; the new state.

    ``store`` must let a table be overwritten by what is read from it, as versioned
    files do. A day that was added before is refused, so a job may be repeated.
    """
    mark = facts.sparkSession.sql(
        "SELECT CAST(NULL AS BIGINT) AS userId, :kind AS kind, :day AS value, 1L AS n",
        {"kind": DAY_ADDED, "day": day})
    new = state_of(facts, kept).unionByName(mark, allowMissingColumns=True)
    if store.versions(name):
        old = store.read(name)
        if day in added_days(old):
            raise ValueError(f"{day} is in the state {name} already")
        new = merged([old, new], kept)
    store.write(new, name)
    return store.read(name)


def metrics_of(state: DataFrame, kept: Kept, as_of: AsOf = None,
               names: Iterable[str] | None = None) -> DataFrame:
    """userId with the named metrics, as one pass over all facts would give them."""
    different = {"pageCount"} if kept.user == LOGS_KEPT.user else set()
    modes = [m for m in ("payment", "activeHour") if m in kept.values]
    names = list(names or (*kept.metrics, *sorted(different), *modes))
    of_kind = lambda kind: state.filter(F.col("kind") == kind)
    sums = of_kind(SUMS)
    parts = []
    if "recentVisits" in names:
        first = F.date_sub(as_of_date(as_of), metrics.RECENT_DAYS - 1)
        recent = of_kind("day").groupBy("userId").agg(F.sum(F.when(
            F.col("value").cast("date") >= first, F.col("n")).otherwise(0)).alias("recent"))
        sums = sums.join(recent, "userId")
    shown = [kept.metrics[n].value(as_of).alias(n) for n in names if n in kept.metrics]
    if "pageCount" in names and "pages" in kept.measures:
        shown.append(F.hll_sketch_estimate("pages").alias("pageCount"))
    elif "pageCount" in names:
        parts.append(of_kind("page").groupBy("userId").agg(F.count("value").alias("pageCount")))
    for mode in modes:
        if mode in names:
            first = F.min(F.struct((-F.col("n")).alias("less"), F.col("value").isNull().alias("none"),
                                   _typed(mode).alias("value")))
            parts.append(of_kind(mode).groupBy("userId").agg(first["value"].alias(mode)))
    parts.insert(0, sums.select("userId", *shown))
    return reduce(lambda a, b: a.join(b, "userId"), parts).select("userId", *names)


def _typed(mode: str) -> Column:
    return F.col("value").cast("int") if mode == "activeHour" else F.col("value")
