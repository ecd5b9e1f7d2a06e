"""Column expressions shared by the tags. All of them stay inside the JVM."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Fixed value: the address form that carries a product id.
PRODUCT_URL = r"^.+/product/(\d+)\.html.+$"

# One closed band and its score; None leaves that side open.
Band = tuple[float | None, float | None, float]


def as_of_date(as_of: dt.date | str | None) -> Column:
    """The day ages are counted to: a given date, else today."""
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def days_since(as_of: dt.date | str | None, moment: Column) -> Column:
    """Whole calendar days from ``moment`` to ``as_of`` (negative if later)."""
    return F.date_diff(as_of_date(as_of), moment)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def birth_number(birthday: Column) -> Column:
    """'1987-03-09' -> 19870309; NULL where the text is no such date."""
    return F.regexp_replace(birthday, "-", "").try_cast("int")


def product_id(url: Column) -> Column:
    """The product id inside a page address, NULL for any other address."""
    return F.nullif(F.regexp_extract(url, PRODUCT_URL, 1), F.lit(""))


def range_bounds(rule: Column) -> Column:
    """'100-199' -> struct(start 100, end 199); NULL bounds where malformed."""
    def bound(part: int) -> Column:
        return F.trim(F.split_part(rule, F.lit("-"), F.lit(part))).try_cast("int")

    two_parts = F.size(F.split(rule, "-")) == 2
    return F.struct(F.when(two_parts, bound(1)).alias("start"),
                    F.when(two_parts, bound(2)).alias("end"))


def band_score(value: Column, bands: Sequence[Band]) -> Column:
    """The score of the first band that holds ``value``, NULL in a hole."""
    score = F.lit(None).cast("double")
    for low, high, points in reversed(list(bands)):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (value >= F.lit(low))
        if high is not None:
            inside = inside & (value <= F.lit(high))
        score = F.when(inside, F.lit(float(points))).otherwise(score)
    return score


def vocabulary_code(value: Column, words: Sequence[str]) -> Column:
    """1-based place of ``value`` in ``words``; 0 for any other value or NULL."""
    listed = F.array(*[F.lit(word) for word in words])
    return F.coalesce(F.array_position(listed, value), F.lit(0)).cast("int")


def slots(items: Column, names: Sequence[str]) -> list[Column]:
    """Spread an array over columns; a short array leaves NULLs."""
    return [F.get(items, F.lit(i)).alias(name) for i, name in enumerate(names)]


def share_vote(total: Column, zeros: Column, ones: Column) -> Column:
    """'0' or '1' for whichever holds at least half, '0' on a tie, else '-1'."""
    half = F.lit(0.5)
    return (F.when(F.try_divide(zeros, total) >= half, "0")
            .when(F.try_divide(ones, total) >= half, "1")
            .otherwise("-1"))
