"""Vectors as integers, for operators that must be exact without floating point."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

#: What a component is multiplied by before it is rounded down.
SCALE = 256


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def whole_vectors(vectors: DataFrame, vector_column: str, multiple: int = 1
                  ) -> tuple[DataFrame, int]:
    """The rows with a finite vector, it in a column ``whole`` of integers instead.

    Components are floor(256 * x). Vectors of several lengths are filled with zeros to
    the longest, rounded up to a ``multiple``; that length comes with them. A component
    so large that sums of squares could leave 64 bits raises.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    kept = vectors.withColumn(vector_column, vector).filter(finite(F.col(f"`{vector_column}`")))
    held = F.col(f"`{vector_column}`")
    size, most = kept.agg(F.max(F.size(held)), F.max(F.array_max(F.transform(held, F.abs)))).first()
    width = max(1, -(-(size or 0) // multiple)) * multiple
    bound = isqrt((1 << 61) // width ** 2) // 2
    if SCALE * (most or 0) >= bound:
        raise ValueError(f"{vector_column} has components of {bound / SCALE:.4g} or more")
    ints = F.transform(held, lambda x: F.floor(x * F.lit(float(SCALE))).cast("long"))
    filled = F.concat(ints, F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size(held)))
    others = [F.col(f"`{c}`") for c in vectors.columns if c.lower() != vector_column.lower()]
    return kept.select(*others, filled.alias("whole")), width
