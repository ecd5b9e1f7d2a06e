"""Nearest neighbours by inner product, with an inverted multi-index.

The halves of a vector are quantised by a codebook each, fitted on a bounded sample;
the pair of nearest centroids is the vector's cell. A centroid's score for a query is
their inner product plus a share of what its vectors reach beyond it: half of the
query's length times their mean distance from the centroid, so that cells of long
vectors come as early as their vectors deserve. A query walks through pairs of
centroids in order of the summed scores, with a heap, until the visited cells hold
enough entries. Those, and no others, are ranked by the exact inner product.

Entries are dealt to tasks by their first centroid, in blocks of bounded size, and a
query goes to the blocks with cells that it visits. Equal vectors form one entry
with as many of their smallest ids as a result can show, so a vector that a third of
all rows share weighs no more than any other.

On vectors without any cluster structure no index finds nearly all neighbours among
few entries: ``VISIT`` is the share of entries ranked, with recall above 0.9 there.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagweave.llm.common import small_batches, staged

#: Vectors that the codebooks are fitted on, chosen by hash; centroids of each half.
SAMPLE, CENTROIDS, ROUNDS = 20_000, 64, 12
#: Share of all entries that a query ranks; share of its reach that a cell's score has.
VISIT, REACH = 0.5, 0.5
#: Bytes of a block's vectors; scores that a task holds at a time.
BLOCK_BYTES, HELD = 16 << 20, 1 << 20


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)


def codebook(points: np.ndarray, size: int) -> np.ndarray:
    """Centroids by Lloyd's rounds, begun at distinct points; ties go to the first."""
    points = np.asarray(points, float)
    centres = np.unique(points, axis=0)
    if len(centres) > size:
        centres = centres[np.random.default_rng(5).choice(len(centres), size, False)]
    for _ in range(ROUNDS):
        near = _nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def reach(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Root of the mean squared distance of each centroid's points; 0 without points."""
    near = _nearest(points, centres)
    far = ((points - centres[near]) ** 2).sum(axis=1)
    counts = np.bincount(near, minlength=len(centres))
    return np.sqrt(np.bincount(near, far, len(centres)) / np.maximum(counts, 1))


def visited(first: np.ndarray, second: np.ndarray, counts: np.ndarray, wanted: int
            ) -> list[tuple[int, int]]:
    """Cells in order of the summed scores of their halves, until they hold enough.

    Empty cells are passed over; the walk is the multi-sequence one, whose heap
    holds the pairs next to those already seen.
    """
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[rows], second[columns]
    heap, seen, found, held = [(-(a[0] + b[0]), 0, 0)], {(0, 0)}, [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = (int(rows[i]), int(columns[j]))
        if counts[cell]:
            found.append(cell)
            held += int(counts[cell])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(a[x] + b[y]), x, y))
    return found


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) rows that take part: all components finite, not all zero.

    Vectors of several lengths are filled with zeros to the longest, which changes no
    inner product.
    """
    plain = vectors.select(F.col(id_column).cast("long").alias("id"),
                           F.col(vector_column).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = plain.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad
                        & F.exists("vector", lambda x: x != 0))
    size = good.agg(F.max(F.size("vector"))).first()[0] or 0
    return good.select("id", F.concat("vector", F.array_repeat(
        F.lit(0.0), F.lit(size) - F.size("vector"))).alias("vector"))


def _matrix(column) -> np.ndarray:
    """Rows of a list column without nulls."""
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy().reshape(len(column), -1)


def search(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, id_column: str = "vec_id",
           vector_column: str = "embedding", visit: float = VISIT) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best found for each query row.

    ``is_query`` turns the id column into a condition. Candidates are all usable rows with
    another id than the query's; fewer candidates give fewer rows. Equal scores are
    ranked by the smaller id. Rows of one id and one vector count once. The score is
    the inner product of the whole vectors in double precision.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    good = staged(usable(vectors, id_column, vector_column).distinct(), "vectors")
    same = Window.partitionBy("x", "y").orderBy("id")
    hashed = good.select("id", "vector", F.xxhash64("vector").alias("x"),
                         F.xxhash64(F.lit(3), "vector").alias("y"))
    entries = (hashed.withColumn("place", F.row_number().over(same))
               .filter(F.col("place") <= k + 1).groupBy("x", "y")
               .agg(F.sort_array(F.collect_list("id")).alias("ids"),
                    F.min(F.struct("id", "vector"))["vector"].alias("vector")))
    entries = staged(entries, "entries")
    sample = np.array([r["vector"] for r in entries.orderBy("x", "y").limit(SAMPLE)
                       .select("vector").collect()], float)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    half = (sample.shape[1] + 1) // 2
    halves = sample[:, :half], sample[:, half:]
    books = tuple(codebook(part, CENTROIDS) for part in halves)
    reaches = tuple(REACH * reach(part, book) for part, book in zip(halves, books))

    def placed(batches):
        for batch in batches:
            m = _matrix(batch.column("vector"))
            i, j = (_nearest(p, c) for p, c in zip((m[:, :half], m[:, half:]), books))
            yield pa.RecordBatch.from_arrays(
                [batch.column("ids"), batch.column("vector"), batch.column("h"),
                 pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))],
                names=["ids", "vector", "h", "i", "j"])

    cells = staged(entries.select("ids", "vector", F.col("x").alias("h")).mapInArrow(
        placed, "ids array<long>, vector array<double>, h long, i int, j int"), "cells")
    counts = np.zeros((len(books[0]), len(books[1])), np.int64)
    for r in cells.groupBy("i", "j").agg(F.count("*").alias("n")).collect():  # of bounded size
        counts[r["i"], r["j"]] = r["n"]
    wanted = max(k + 1, ceil(visit * counts.sum()))
    blocks = 1 + counts.sum(axis=1) * 8 * sample.shape[1] // BLOCK_BYTES

    def walked(batches):
        for batch in batches:
            rows = []
            m = _matrix(batch.column("vector"))
            for name, q in zip(batch.column("id").to_pylist(), m):
                by_row: dict[int, list[int]] = {}
                scores = [book @ part + np.linalg.norm(part) * far for book, part, far in zip(
                    books, (q[:half], q[half:]), reaches)]
                for i, j in visited(*scores, counts, wanted):
                    by_row.setdefault(i, []).append(j)
                rows += [(i, b, 1, [name], q, js) for i, js in by_row.items()
                         for b in range(int(blocks[i]))]
            yield _rows(rows)

    deal = "i int, block int, kind int, ids array<long>, vector array<double>, js array<int>"
    asked = good.filter(is_query(F.col("id"))).mapInArrow(walked, deal)
    per_row = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("i") + 1)
    stored = cells.select("i", F.pmod("h", per_row).cast("int").alias("block"),
                          F.lit(0).alias("kind"), "ids", "vector", F.array("j").alias("js"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (stored.unionByName(asked).repartition(parts, "i", "block")
             .sortWithinPartitions("i", "block", "kind"))
    best = dealt.mapInArrow(_ranked(k),
                            "query_id long, ids array<long>, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.select("query_id", F.explode("ids").alias("vec_id"), "score")
            .filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 6
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64()),
             pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                      names=["i", "block", "kind", "ids", "vector", "js"])


class Block:
    """Entries of one first centroid, by their second one."""

    def __init__(self, table: pa.Table):
        column = table.column("js").combine_chunks().flatten().to_numpy()
        order = np.argsort(column, kind="stable")
        self.matrix = _matrix(table.column("vector").combine_chunks())[order]
        ids = table.column("ids").to_pylist()
        self.ids = [ids[i] for i in order]
        self.first = np.array([x[0] for x in self.ids])
        self.columns, begins = np.unique(column[order], return_index=True)
        self.bounds = np.append(begins, len(order))

    def scores(self, queries: np.ndarray, visits: list[list[int]]) -> tuple[np.ndarray, int]:
        """Inner products with the entries of the cells that each query visits, minus infinity
        elsewhere; and how many were computed."""
        found, products = np.full((len(queries), len(self.ids)), -np.inf), 0
        of = np.repeat(np.arange(len(visits)), [len(js) for js in visits])
        js = np.concatenate([np.asarray(js, np.int64) for js in visits])
        order = np.argsort(js, kind="stable")
        of, js = of[order], js[order]
        for j, a, b in zip(self.columns, self.bounds, self.bounds[1:]):
            mine = of[np.searchsorted(js, j):np.searchsorted(js, j, "right")]
            if len(mine):
                found[mine, a:b] = queries[mine] @ self.matrix[a:b].T
                products += len(mine) * (b - a)
        return found, products


def _ranked(k: int):
    """Per query and block the best entries among the cells that the query visits."""

    def passes(batches):
        at, held, block = None, [], None
        for batch in batches:
            i, where_block, kind = (batch.column(n).to_numpy() for n in ("i", "block", "kind"))
            where = i.astype(np.int64) << 32 | where_block
            edges = np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1
            found = []
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(where)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if at != where[a]:
                    at, held, block = where[a], [], None
                if kind[a] == 0:
                    held.append(part)
                    continue
                if not held and block is None:
                    continue
                if block is None:
                    block, held = Block(pa.Table.from_batches(held)), []
                step = max(1, HELD // len(block.ids))
                for c in range(0, part.num_rows, step):
                    found += _best(block, part.slice(c, step), k)
            if found:
                names, lists, scores = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(lists, pa.list_(pa.int64())),
                     pa.array(scores)], names=["query_id", "ids", "score"])

    return passes


def _best(block: Block, queries: pa.RecordBatch, k: int) -> list[tuple]:
    scores, _ = block.scores(_matrix(queries.column("vector")), queries.column("js").to_pylist())
    found = []
    for row, name in zip(scores, queries.column("ids").to_pylist()):
        near = np.flatnonzero(row > -np.inf)
        if len(near) > k + 1:
            least = np.partition(row[near], -(k + 1))[-(k + 1)]
            near = near[row[near] >= least]
        near = near[np.lexsort((block.first[near], -row[near]))][:k + 1]
        found += [(name[0], block.ids[e], float(row[e])) for e in near]
    return found
