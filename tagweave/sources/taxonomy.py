"""The rule taxonomy: which table feeds a tag, and what its values are called.

Level 4 rows are tags, ``selectTable=<table>;selectField=<a>|<b>``; their level
5 children name a value: a code, or a closed integer range ``<start>-<end>``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagweave.operators.match import attach_band
from tagweave.sources.schemas import TAXONOMY, conform, require

# A closed range of integers, for taxonomies of any size.
RANGE = r"[ \t]*([0-9]+)[ \t]*-[ \t]*([0-9]+)[ \t]*"
# Rows of a taxonomy that is kept on the driver.
LITERAL_RULES = 10_000


@dataclass(frozen=True)
class SourceRule:
    table: str
    fields: tuple[str, ...]


def parse_source_rule(tag_id: int, text: str | None) -> SourceRule:
    """Read a level 4 rule; an absent or malformed one names its tag."""
    if not text or not text.strip():
        raise ValueError(f"tag {tag_id} has no source rule in the taxonomy")
    pairs = dict(part.split("=", 1) for part in text.split(";") if "=" in part)
    pairs = {key.strip(): value.strip() for key, value in pairs.items()}
    table = pairs.get("selectTable")
    fields = tuple(f.strip() for f in pairs.get("selectField", "").split("|") if f.strip())
    if not table or not fields:
        raise ValueError(f"tag {tag_id} has a malformed source rule: {text!r}")
    return SourceRule(table, fields)


@dataclass(frozen=True)
class Rules:
    """The values of one tag as a frame, and as rows where the driver has them."""

    frame: DataFrame
    values: tuple[tuple, ...] | None = None

    @property
    def rows(self) -> int | None:
        return None if self.values is None else len(self.values)


class Taxonomy:
    """The rules of all tags, read once.

    Up to ``limit`` rows are kept and become literals of the plans that use them,
    so Catalyst knows their size and no tag scans the taxonomy again. A larger
    taxonomy stays a table, filtered per tag.
    """

    def __init__(self, frame: DataFrame, limit: int = LITERAL_RULES):
        self._frame = conform(require(frame, TAXONOMY.names, "taxonomy"),
                              TAXONOMY).select(*TAXONOMY.names)
        rows = self._frame.filter("level IN (4, 5)").take(limit + 1)
        self._rows = rows if len(rows) <= limit else None

    @property
    def spark(self) -> SparkSession:
        return self._frame.sparkSession

    def source_rule(self, tag_id: int) -> SourceRule:
        if self._rows is None:
            row = (self._frame.filter("level = 4").where(F.col("id") == tag_id)
                   .select("rule").head())
        else:
            row = next((r for r in self._rows if (r.level, r.id) == (4, tag_id)), None)
        return parse_source_rule(tag_id, row.rule if row else None)

    def code_rules(self, tag_id: int) -> Rules:
        """(name, rule) of a code tag. A code with two names raises: it would give
        one user two rows."""
        if self._rows is None:
            values = self._values(tag_id)
            _refuse(tag_id, "duplicate code(s)", [r.rule for r in values.groupBy("rule").count()
                                                  .filter("count > 1").take(3)])
            return Rules(values)
        values = [(r.name, r.rule) for r in self._literal_values(tag_id)]
        seen = Counter(rule for _, rule in values)
        _refuse(tag_id, "duplicate code(s)", [rule for rule, n in seen.items() if n > 1])
        return Rules(_literals(self._frame.sparkSession, values, ("name", "rule")),
                     tuple(values))

    def band_rules(self, tag_id: int, allow_overlap: bool = False) -> Rules:
        """(name, start, end) of a range tag.

        A malformed range raises. So do overlapping ranges, since they would give
        one user two values, unless ``allow_overlap``.
        """
        if self._rows is None:
            part = lambda i: F.expr(
                f"try_cast(regexp_extract(rule, r'{RANGE}', {i}) AS INT)")
            bands = self._values(tag_id).select(
                "name", "rule", part(1).alias("start"), part(2).alias("end"))
            whole = F.coalesce(F.col("rule").rlike(rf"\A{RANGE}\z"), F.lit(False))
            broken = bands.filter(~whole | F.col("start").isNull() | F.col("end").isNull()
                                  | (F.col("start") > F.col("end"))).take(3)
            _refuse(tag_id, "malformed range(s)", [r.rule for r in broken])
            bands = bands.drop("rule")
            if not allow_overlap:
                # Two bands overlap just if the start of one lies in the other.
                starts = bands.select(F.col("start").alias("at"),
                                      F.monotonically_increasing_id().alias("row"))
                met = attach_band(starts, bands, "at", "held", limit=-1)
                twice = met.groupBy("row", "at").count().filter("count > 1").take(3)
                _refuse(tag_id, "overlapping range(s)", [f"several hold {r.at}" for r in twice])
            return Rules(bands)
        values = [(r.name, *_bounds(tag_id, r.rule)) for r in self._literal_values(tag_id)]
        spans = sorted(values, key=lambda v: v[1:])
        if not allow_overlap:
            _refuse(tag_id, "overlapping range(s)", [
                f"{a[1]}-{a[2]} and {b[1]}-{b[2]}" for a, b in zip(spans, spans[1:])
                if b[1] <= a[2]])
        kept = None if allow_overlap else tuple(values)
        return Rules(_literals(self._frame.sparkSession, values, ("name", "start", "end")), kept)

    def _values(self, tag_id: int) -> DataFrame:
        values = (self._frame.filter("level = 5").where(F.col("pid") == tag_id)
                  .select("name", "rule"))
        if values.isEmpty():
            raise ValueError(f"tag {tag_id} has no values in the taxonomy")
        return values

    def _literal_values(self, tag_id: int) -> list:
        values = [r for r in self._rows if (r.level, r.pid) == (5, tag_id)]
        if not values:
            raise ValueError(f"tag {tag_id} has no values in the taxonomy")
        return values


def _bounds(tag_id: int, rule: str | None) -> tuple[int, int]:
    found = re.fullmatch(RANGE, rule or "", re.ASCII)
    bounds = tuple(map(int, found.groups())) if found else (1, 0)
    if not bounds[0] <= bounds[1] < 2 ** 31:
        _refuse(tag_id, "malformed range(s)", [rule])
    return bounds


def _refuse(tag_id: int, fault: str, rules: list) -> None:
    if rules:
        raise ValueError(f"tag {tag_id} has {fault}: {rules[:3]}")


def _literals(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame(pa.table(
        [pa.array(column, pa.int32() if name in ("id", "pid", "level", "start", "end")
                  else pa.string()) for name, column in zip(names, zip(*rows))],
        names=list(names)))


def taxonomy_frame(spark: SparkSession,
                   tags: Iterable[tuple[int, str, str, Iterable[tuple[str, str]]]]
                   ) -> DataFrame:
    """A taxonomy from (tag id, name, source rule, [(value name, rule), ...])."""
    rows = []
    for tag_id, name, source, values in tags:
        rows.append((tag_id, 0, 4, name, source))
        rows += [(tag_id * 1000 + i, tag_id, 5, value, rule)
                 for i, (value, rule) in enumerate(values, 1)]
    return _literals(spark, rows, tuple(TAXONOMY.names))
