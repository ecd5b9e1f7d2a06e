"""Joining per-user values to the rules that name them.

A rule side is broadcast only after its row count was checked. A larger one is
joined by a shuffle. Codes and metrics are skewed by nature, one code can cover a
third of all users: keys with very many rows are counted first and carry a salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tagweave.operators import sweep
from tagweave.operators.staging import stage

# Rows a code rule side may have to be broadcast.
BROADCAST_CODES = 10_000
# Rules that are written into an expression instead of being joined.
EXPRESSED = 64
# A range join compares every row with every band, so its bound is far lower.
BROADCAST_BANDS = 256
# Tasks one hot key is spread over in the shuffled joins, the rows that make a key
# hot, and the number of hottest keys that are looked after.
SALTS = 32
HOT_ROWS = 1_000_000
HOT_KEYS = 1000


def fits(df: DataFrame, limit: int) -> bool:
    """Whether ``df`` has at most ``limit`` rows; reads no more than that."""
    return df.limit(limit + 1).count() <= limit


def code_match(users: DataFrame, rules: DataFrame, code: str, label: str,
               how: str = "inner", limit: int = BROADCAST_CODES) -> DataFrame:
    """Replace column ``code`` by ``label``, the name whose rule equals it.

    Codes and rules are compared as text, so a numeric code meets text rules.
    An inner match drops users whose code is NULL or named by no rule.
    """
    named = attach_code(users, rules, code, "_name", how, limit)
    return named.select(*[c for c in users.columns if c != code],
                        F.col("_name").alias(label))


def range_match(users: DataFrame, bands: DataFrame, metric: str, label: str,
                keep_metric: bool = True, how: str = "inner",
                half_open: bool = False, limit: int = BROADCAST_BANDS) -> DataFrame:
    """Add ``label``, the name of the band (name, start, end) that holds ``metric``.

    Bands are closed on both sides, so 999.5 falls between 0-999 and 1000-1999
    and an inner match drops that user; ``half_open`` stretches each band to the
    next integer instead. Overlapping bands give a user one row per band.
    """
    named = attach_band(users, bands, metric, "_name", how, half_open, limit)
    return named.select(*[c for c in users.columns if keep_metric or c != metric],
                        F.col("_name").alias(label))


def code_name(code: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The name of a code by few rules (name, code) with different codes; else NULL."""
    pairs = [F.lit(v) for name, rule in rules if rule is not None for v in (rule, name)]
    return F.try_element_at(F.create_map(*pairs), code.cast("string")) if pairs else F.lit(
        None).cast("string")


def band_name(metric: Column, bands: Sequence[tuple[str, int, int]],
              half_open: bool = False) -> Column:
    """The name of the band by few bands (name, start, end) that don't overlap; else NULL."""
    named = F.lit(None).cast("string")
    for name, start, end in bands:
        upper = metric < end + 1 if half_open else metric <= end
        named = F.when((metric >= start) & upper, name).otherwise(named)
    return named


def attach_code(users: DataFrame, rules: DataFrame, code: str, out: str,
                how: str = "inner", limit: int = BROADCAST_CODES,
                rows: int | None = None) -> DataFrame:
    """``users`` with one more column ``out`` for the name of their code.

    ``rows`` is the number of rules where it is known. A helper column stays.
    """
    key = f"{out}_key"
    named = rules.selectExpr(f"name AS `{out}`", f"CAST(rule AS STRING) AS `{key}`")
    if _small(named, limit, rows):
        return users.join(F.broadcast(named),
                          F.expr(f"CAST(`{code}` AS STRING) = `{key}`"), how)
    keyed = users.withColumn(key, F.col(code).cast("string"))
    return salted_join(keyed, named, [key], how)


def attach_band(users: DataFrame, bands: DataFrame, metric: str, out: str,
                how: str = "inner", half_open: bool = False,
                limit: int = BROADCAST_BANDS, rows: int | None = None) -> DataFrame:
    """``users`` with one more column ``out`` for the name of their band.

    Helper columns stay. Bands too many to compare with each user are met in one sorted
    sweep over both, or, if they overlap, by blocks of integers.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a band match is inner or left, not {how!r}")
    start, end = f"{out}_start", f"{out}_end"
    named = bands.selectExpr(f"name AS `{out}`", f"CAST(start AS INT) AS `{start}`",
                             f"CAST(end AS INT) AS `{end}`")
    upper = f"< CAST(`{end}` AS BIGINT) + 1" if half_open else f"<= `{end}`"
    inside = F.expr(f"`{metric}` >= `{start}` AND `{metric}` {upper}")
    if _small(named, limit, rows):
        return users.join(F.broadcast(named), inside, how)
    rows = stage(users, "banded-rows")
    if not sweep.overlapping(named, start, end):
        return sweep.attach_last(rows, named, metric, out, start, end, inside, how)
    # Rows of several bands: blocks of integers that bands and values share.
    if how == "inner":
        return _join_blocks(rows, named, metric, start, end).filter(inside)
    row = f"{out}_row"
    numbered = stage(rows.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    matched = _join_blocks(numbered, named, metric, start, end).filter(inside)
    others = numbered.join(matched.select(row).distinct(), row, "left_anti")
    return matched.unionByName(others, allowMissingColumns=True).drop(row)


def _small(df: DataFrame, limit: int, rows: int | None) -> bool:
    return fits(df, limit) if rows is None else rows <= limit


def lookup(facts: DataFrame, dimension: DataFrame, keys: list[str],
           how: str = "inner", limit: int = BROADCAST_CODES,
           rows: int | None = None) -> DataFrame:
    """Equi join to a dimension: broadcast if its size allows, else salted.

    ``rows`` is the dimension's size where the caller knows it.
    """
    if _small(dimension, limit, rows):
        return facts.join(F.broadcast(dimension), keys, how)
    return salted_join(facts, dimension, keys, how)


def salted_join(facts: DataFrame, dimension: DataFrame, keys: list[str],
                how: str = "inner", salts: int = SALTS, hot_rows: int = HOT_ROWS,
                hot: DataFrame | None = None) -> DataFrame:
    """Equi join by a shuffle that cuts the facts of hot keys into ``salts`` parts.

    Keys are counted, combined before the shuffle, and only the dimension rows of hot
    ones are copied. The salt is a hash of the row and of its partition, not a random
    number: equal rows are spread too, and a task that runs again after a lost
    executor puts its rows in the same place. Keys beyond the HOT_KEYS hottest are
    joined like all others, so the result does not depend on these limits. ``hot`` has
    the keys and their ``_n`` rows where the caller counts them otherwise.
    """
    if hot is None:
        hot = (facts.groupBy(*keys).agg(F.count("*").alias("_n"))
               .filter(F.col("_n") >= hot_rows).orderBy(F.desc("_n"), *keys))
    hot = hot.limit(HOT_KEYS).drop("_n").withColumn("_hot", F.lit(True))
    found = F.broadcast(hot)  # at most HOT_KEYS rows
    salt = F.pmod(F.xxhash64(*facts.columns, F.spark_partition_id()), F.lit(salts))
    salted = facts.join(found, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), salt.cast("int")).otherwise(0)).drop("_hot")
    copies = dimension.join(found, keys, "left").withColumn("_salt", F.explode(
        F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
        .otherwise(F.array(F.lit(0))))).drop("_hot")
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


# Integers are counted from the smallest, so that negative ones have blocks too. A band
# is covered by aligned blocks of 16^0 .. 16^7 integers: at most 30 per size, 240 in
# all, however wide it is. A value then lies in one block per size.
_SIZES = range(8)
_LEAST = 2 ** 31


def _join_blocks(users: DataFrame, bands: DataFrame, metric: str, start: str,
                 end: str) -> DataFrame:
    """Users and the bands they share a block with; still to be compared."""
    covered = _cover(bands, start, end)
    # Users are placed only at the sizes in use, usually two or three.
    used = sorted(row["_size"] for row in covered.select("_size").distinct().collect())
    placed = (users.filter((F.col(metric) >= -float(_LEAST)) & (F.col(metric) < float(_LEAST)))
              .withColumn("_size", F.explode(F.array(*map(F.lit, used)).cast("array<int>")))
              .withColumn("_block", F.expr(
                  f"(CAST(floor(`{metric}`) AS BIGINT) + {_LEAST}) "
                  "DIV shiftleft(1L, 4 * _size)")))
    return salted_join(placed, covered, ["_size", "_block"]).drop("_size", "_block")


def _cover(bands: DataFrame, start: str, end: str) -> DataFrame:
    """Each band once per (_size, _block) of its cover: the blocks of a size that
    lie inside the band, less those inside a larger block that does too."""
    def run(first: str, last: str) -> str:
        return f"IF({first} <= {last}, sequence({first}, {last}), CAST(array() AS ARRAY<BIGINT>))"

    sized = (bands.withColumn("_size", F.explode(F.array(*map(F.lit, _SIZES))))
             .withColumn("_w", F.expr("shiftleft(1L, 4 * _size)"))
             .withColumn("_from", F.expr(f"`{start}` + {_LEAST}L"))
             .withColumn("_to", F.expr(f"`{end}` + {_LEAST}L")))
    spans = sized.selectExpr(
        *bands.columns, "_size",
        "(_from + _w - 1) DIV _w AS _first",
        "(_to + 1L) DIV _w - 1 AS _last",
        "(_from + 16 * _w - 1) DIV (16 * _w) * 16 AS _inner_first",
        "(_to + 1L) DIV (16 * _w) * 16 - 1 AS _inner_last")
    blocks = (f"IF(_size = {_SIZES[-1]} OR _inner_first > _inner_last, "
              f"{run('_first', '_last')}, concat({run('_first', '_inner_first - 1')}, "
              f"{run('_inner_last + 1', '_last')}))")
    return spans.select(*bands.columns, "_size", F.explode(F.expr(blocks)).alias("_block"))
