"""Compression of vectors to one codebook index for each part, in integers throughout.

A vector is cut into equal parts; each part position has a codebook that Lloyd's rounds
move. The nearest entry is found in the Walsh-Hadamard domain: parts and entries are
filled with zeros to a power of two, m, and transformed by additions; squared
differences there add up to m times the squared distance. They are accumulated in order
of sequency, where smooth parts have most of their energy first, and an entry whose
sum exceeds the distance to a known entry is never looked at again. Sums are exact, so
neither order nor partitioning changes a result.

A round is one pass over the staged rows: tasks send sums and counts for each entry,
at most parts x entries rows each, which Spark adds up. The driver holds codebooks only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import small_batches, staged
from tagweave.llm.integers import whole_vectors
from tagweave.operators.match import lookup

#: Parts of a vector, entries of a codebook, Lloyd's rounds.
PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Vectors compared at a time.
BLOCK = 1024


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and place in the part, as integers."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        """SHA-256 of all components in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()
                              ).hexdigest()


def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix of a power of two, by their sign changes."""
    row, column = np.indices((size, size))
    signs = np.bitwise_count(row & column) & 1
    return np.argsort(np.abs(np.diff(signs, axis=1)).sum(axis=1), kind="stable")


def transformed(parts: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the last axis, zero-padded, by sequency."""
    size = 1 << max(0, parts.shape[-1] - 1).bit_length()
    done = np.zeros((*parts.shape[:-1], size), np.int64)
    done[..., :parts.shape[-1]] = parts
    step = 1
    while step < size:
        pairs = done.reshape(*parts.shape[:-1], -1, 2, step)
        done = np.stack((pairs[..., 0, :] + pairs[..., 1, :],
                         pairs[..., 0, :] - pairs[..., 1, :]), -2).reshape(done.shape)
        step *= 2
    return done[..., sequency_order(size)]


def nearest(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each transformed point and their squared distance.

    Ties go to the lower index. Both arguments have sequencies as columns.
    """
    sums = (points[:, :1] - book[:, 0]) ** 2
    # A full distance to begin with: to the entry that the first sequency prefers.
    bound = ((points - book[sums.argmin(axis=1)]) ** 2).sum(axis=1)
    point, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[point, entry]
    for k in range(1, book.shape[1]):
        sums = sums + (points[point, k] - book[entry, k]) ** 2
        open_ = sums <= bound[point]
        point, entry, sums = point[open_], entry[open_], sums[open_]
    begins = np.searchsorted(point, np.arange(len(points)))
    least = np.minimum.reduceat(sums, begins) if len(points) else bound
    ties = np.flatnonzero(sums == least[point])
    first = ties[np.searchsorted(point[ties], np.arange(len(points)))]
    return entry[first], least // book.shape[1]


def _assigned(batch: pa.RecordBatch, books: np.ndarray, moved: np.ndarray
              ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, vectors by part, indexes, distances) of a batch, block by block."""
    parts, _, size = books.shape
    whole = batch.column("whole").flatten().to_numpy().reshape(batch.num_rows, parts, size)
    for a in range(0, len(whole), BLOCK):
        block = whole[a:a + BLOCK]
        found = [nearest(points, book) for points, book in zip(
            transformed(block).transpose(1, 0, 2), moved)]
        yield a, block, np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1)


def _sums(books: np.ndarray):
    """A task's sums and counts of the parts assigned to each entry."""

    def passes(batches):
        moved = transformed(books)
        parts, entries, _ = books.shape
        total, count = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, block, index, _ in _assigned(batch, books, moved):
                for p in range(parts):
                    np.add.at(total[p], index[:, p], block[:, p])
                    count[p] += np.bincount(index[:, p], minlength=entries)
        part, entry = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(count[part, entry]),
             pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"])

    return passes


def moved_entries(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: entries become the floored means of their parts, unused ones stay."""
    held = books.entries
    sums = rows.select("whole").mapInArrow(
        _sums(held), "part long, entry long, n long, total array<long>")
    found = (sums.select("part", "entry", "n", F.posexplode("total"))
             .groupBy("part", "entry", "pos").agg(F.sum("col").alias("total"),
                                                  F.sum("n").alias("n")).collect())
    new = held.copy()
    for r in found:  # a codebook's size
        new[r["part"], r["entry"], r["pos"]] = r["total"] // r["n"]
    return Codebooks(new)


def fit(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> Codebooks:
    """Codebooks for (id, whole) rows that begin at the smallest ids.

    Of equal ids the smaller vector comes first, null ids come last; fewer rows than
    entries give as many entries as rows.
    """
    first = rows.select("id", "whole").orderBy(F.col("id").asc_nulls_last(), "whole").limit(
        entries).collect()
    start = np.array([r["whole"] for r in first], np.int64).reshape(
        len(first), parts, width // parts)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds if len(first) else 0):
        books = moved_entries(rows, books)
    return books


def encode(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, codes, error): an index for each part and the summed squared distance."""
    held = books.entries
    kept = rows.select("id", "label", "whole")

    def passes(batches):
        moved = transformed(held)
        for batch in batches:
            for a, block, index, distance in _assigned(batch, held, moved):
                part = batch.slice(a, len(block))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("label"),
                     pa.array(list(index.astype(np.int32)), pa.list_(pa.int32())),
                     pa.array(distance.sum(axis=1))], names=["id", "label", "codes", "error"])

    kinds = dict(kept.dtypes)
    schema = f"id {kinds['id']}, label {kinds['label']}, codes array<int>, error long"
    if not held.size:
        return kept.limit(0).select("id", "label", F.array().cast("array<int>").alias("codes"),
                                    F.lit(0).cast("long").alias("error"))
    return kept.mapInArrow(passes, schema)


def decode(coded: DataFrame, books: Codebooks, codes: str = "codes") -> DataFrame:
    """``coded`` with the vector that the codes stand for, in the original scale."""
    held = [[[float(x) / 256 for x in entry] for entry in book] for book in books.entries]
    parts = [F.element_at(F.lit(book), F.col(codes)[p] + 1) for p, book in enumerate(held)]
    return coded.withColumn("vector", F.concat(*parts))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, id_column: str = "vec_id", vector_column: str = "embedding",
             label_column: str = "label") -> DataFrame:
    """(id, label, codes, error, label_error, codebooks_sha256), one row per usable vector.

    Vectors that are null or hold a null or non-finite component take no part. Shorter ones
    count as filled with zeros, an empty one as zeros only; repeated rows and rows without
    an id or label are rows like others. ``label_error`` sums the errors of equal labels,
    nulls together. An empty table gives an empty one.
    """
    small_batches(vectors.sparkSession)
    named = vectors.select(F.col(f"`{id_column}`").alias("id"),
                           F.col(f"`{label_column}`").alias("label"),
                           F.col(f"`{vector_column}`").alias("vector"))
    whole, width = whole_vectors(named, "vector", parts)
    rows = staged(whole, "whole-vectors")
    books = fit(rows, width, parts, entries, rounds)
    coded = staged(encode(rows, books), "vector-codes")
    # Null labels meet as a label of their own.
    keyed = coded.withColumns({"_held": F.col("label").isNotNull(),
                               "_label": F.coalesce("label", F.lit(0).cast(
                                   coded.schema["label"].dataType))})
    sums = keyed.groupBy("_held", "_label").agg(F.sum("error").alias("label_error"))
    joined = lookup(keyed, staged(sums, "label-errors"), ["_held", "_label"])
    return joined.select("id", "label", "codes", "error", "label_error",
                         F.lit(books.digest).alias("codebooks_sha256"))
