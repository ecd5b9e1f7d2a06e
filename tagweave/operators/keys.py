"""What two large sides of a join can know of each other's keys before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a key filter, 1 MB; hashes for each key; keys that it can tell apart well.
BITS, HASHES = 1 << 23, 4
MOST_KEYS = BITS // 8
#: Buckets that keys are counted by first.
BUCKETS = 1 << 16


def _places(key: str) -> list[Column]:
    """Bits of a key: two hashes, combined."""
    one, two = (F.pmod(F.xxhash64(F.col(key), F.lit(k)), F.lit(BITS)) for k in range(2))
    return [F.pmod(one + F.lit(i) * two, F.lit(BITS)) for i in range(HASHES)]


def possible_matches(facts: DataFrame, key: str, kept: DataFrame, kept_key: str) -> DataFrame:
    """``facts`` without most rows whose ``key`` is not among ``kept``: a Bloom filter.

    For an inner join with far fewer keys than the facts have; no row that has a
    partner is lost. The filter has a fixed size and is one value of the plan. With more
    keys than it can tell apart it would pass nearly all, so facts stay as they are.
    """
    keys = kept.select(F.col(kept_key).alias("_key")).filter("_key IS NOT NULL")
    if keys.limit(MOST_KEYS + 1).count() > MOST_KEYS:
        return facts
    places = keys.select(F.explode(F.array(*_places("_key"))).alias("at"))
    words = places.groupBy((F.col("at") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(at % 64 AS INT))")).alias("bits"))
    spread = facts.sparkSession.range(BITS // 64).select(F.col("id").cast("int").alias("word")).join(
        F.broadcast(words), "word", "left")  # a megabyte
    whole = spread.groupBy().agg(F.transform(
        F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))),
        lambda x: x["bits"]).alias("filter"))
    held = whole.scalar()
    met = [F.getbit(F.get(held, (at / 64).cast("int")), (at % 64).cast("int")) == 1
           for at in _places(key)]
    passed = met[0]
    for bit in met[1:]:
        passed = passed & bit
    return facts.filter(F.col(key).isNotNull() & passed)


def hot_keys(facts: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Keys with ``rows`` rows or more, most frequent first; null keys are none.

    Keys are counted by hash buckets first, at most BUCKETS rows from each task, and
    one by one only in buckets that have as many rows as a hot key.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    named = facts.select(*keys).dropna(subset=keys).withColumn("_bucket", bucket)
    full = (named.groupBy("_bucket").agg(F.count("*").alias("_n"))
            .filter(F.col("_n") >= rows).select("_bucket"))
    counted = named.join(F.broadcast(full), "_bucket", "left_semi").groupBy(*keys).agg(
        F.count("*").alias("_n"))
    return counted.filter(F.col("_n") >= rows).orderBy(F.desc("_n"), *keys)
