"""Values and bands in one sorted order, the last band's start carried on.

Bands that don't overlap hold a value only if the last of them to start at or before it
does. So both are dealt to parts by ranges of the value and sorted together once:
a row is shuffled once, whatever the number of bands and however wide they are.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

#: Parts of the sweep for each shuffle partition, and the most there are.
FACTOR, MOST_PARTS = 2, 1000
#: Bands that one task compares with each other.
PART_BANDS = 50_000


def overlapping(bands: DataFrame, start: str, end: str) -> bool:
    """Whether two bands hold a value in common; bands that end before they start hold none."""
    held = bands.filter(F.col(start) <= F.col(end)).select(
        F.col(start).cast("double").alias("at"), F.col(end).cast("double").alias("to"))
    cuts = _cuts(held, "at", 1 + held.count() // PART_BANDS)
    # Within a part each start is compared with the largest end before it.
    before = Window.partitionBy("part").orderBy("at", "to").rowsBetween(
        Window.unboundedPreceding, -1)
    parts = (_in_parts(held, "at", cuts).withColumn("ends", F.max("to").over(before))
             .groupBy("part").agg(F.min("at").alias("at"), F.max("to").alias("to"),
                                  F.max(F.col("ends") >= F.col("at")).alias("met"))
             .orderBy("part").collect())
    reach = -float("inf")
    for r in parts:
        if r["met"] or r["at"] <= reach:
            return True
        reach = max(reach, r["to"])
    return False


def attach_last(rows: DataFrame, bands: DataFrame, value: str, name: str, start: str, end: str,
                inside: Column, how: str) -> DataFrame:
    """``rows`` with the columns (name, start, end) of the band that holds ``value``.

    ``inside`` says whether a value lies in the band beside it. ``rows`` should be staged:
    they are read to find even parts, to count them and to be joined. A part with far
    more rows than others, as one frequent value makes, is dealt out further, with a
    copy of its bands for each piece.
    """
    band = F.struct(name, start, end).alias("_band")
    held = bands.filter(F.col(start) <= F.col(end)).select(
        F.col(start).cast("double").alias("_at"), band)
    numbered = rows.withColumn("_at", F.col(value).cast("double"))
    cuts = _cuts(numbered, "_at", min(MOST_PARTS, FACTOR * int(
        rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    placed = _in_parts(numbered, "_at", cuts, "_part")
    starts = _in_parts(held, "_at", cuts, "_part")
    # Of each part its rows, and the last band to start there.
    both = starts.unionByName(placed.select("_part", "_at"), allowMissingColumns=True)
    counted = {r["_part"]: r for r in both.groupBy("_part").agg(
        F.count_if(F.col("_band").isNull()).alias("n"),
        F.max_by("_band", F.when(F.col("_band").isNotNull(), F.col("_at"))).alias("band")).collect()}
    share = max(1, 2 * sum(r["n"] for r in counted.values()) // max(1, len(cuts) - 1))
    pieces = [max(1, -(-counted[part]["n"] // share)) if part in counted else 1
              for part in range(len(cuts) - 1)]
    of_part = F.get(F.lit(pieces), F.col("_part"))
    # The band that is open where a part begins started in an earlier one.
    last = {part: r["band"] for part, r in counted.items() if r["band"] is not None}
    carried, open_ = [], None
    for part in range(len(cuts) - 1):
        if open_ is not None:
            carried.append((part, -float("inf"), open_))
        open_ = last.get(part, open_)
    if carried:
        schema = starts.select("_part", "_at", "_band").schema
        starts = starts.select("_part", "_at", "_band").unionByName(
            rows.sparkSession.createDataFrame(carried, schema))
    copies = starts.select("_part", "_at", "_band", F.explode(F.sequence(
        F.lit(0), of_part - 1)).alias("_piece"), F.lit(0).alias("_kind"))
    dealt = placed.withColumns({
        "_piece": F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), of_part).cast("int"),
        "_kind": F.lit(1)})
    so_far = Window.partitionBy("_part", "_piece").orderBy("_at", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = (copies.unionByName(dealt, allowMissingColumns=True)
           .withColumn("_band", F.last("_band", ignorenulls=True).over(so_far))
           .filter("_kind = 1"))
    shown = met.select(*rows.columns, "_band.*").withColumn("_in", F.coalesce(inside, F.lit(False)))
    if how == "inner":
        return shown.filter("_in").drop("_in")
    return shown.select(*rows.columns, *[F.when(F.col("_in"), F.col(c)).alias(c)
                                         for c in (name, start, end)])


def _cuts(rows: DataFrame, at: str, parts: int) -> list[float]:
    """Ends of parts with about equally many rows, from minus to plus infinity."""
    if parts == 1:
        return [-float("inf"), float("inf")]
    finite = rows.filter(F.col(at).isNotNull() & ~F.isnan(at) & (F.abs(at) < float("inf")))
    found = finite.approxQuantile(at, [i / parts for i in range(1, parts)], 0.25 / parts)
    return [-float("inf"), *sorted(set(found)), float("inf")]


def _in_parts(rows: DataFrame, at: str, cuts: list[float], out: str = "part") -> DataFrame:
    """``rows`` with their part; values that are no number are in the last one."""
    if len(cuts) == 2:
        return rows.withColumn(out, F.lit(0))
    placed = Bucketizer(splits=cuts, inputCol="_cut", outputCol="_bucket", handleInvalid="keep"
                        ).transform(rows.withColumn("_cut", F.coalesce(at, F.lit(float("nan")))))
    return placed.withColumn(out, F.least(F.col("_bucket").cast("int"), F.lit(len(cuts) - 2))
                             ).drop("_cut", "_bucket")
