"""Hard negatives by exact search in an inverted multi-index.

Two codebooks, one for each half of a vector, are fitted on a bounded sample; the pair
of nearest centroids is a row's cell. For an anchor, a centroid's bound is its inner
product with the anchor's half plus that half's length times the radius of the
centroid's rows, so no row of a cell scores more than the sum of its two bounds. A heap
walks through pairs of centroids in order of that sum, and stops once the next one is
below what every open window still needs: then the windows are certified.

Cells lie in shards of bounded size; one with more rows is dealt over several. The walk
is made twice: where anchors are dealt, to see which shards an anchor has to visit at
all, given what the sample's own rows already score, and in each shard over its
cells. Positives are found first; their scores set the windows of the negatives.

All scores are integers; the sample decides only how much is looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagweave.llm.common import small_batches, staged
from tagweave.llm.integers import whole_vectors

#: Rows that codebooks are fitted on and thresholds begin with, chosen by hash.
SAMPLE = 8192
#: Most centroids of a half; rows of a cell aimed at; rounds of the fit.
CENTROIDS, CELL, ROUNDS = 256, 64, 6
#: Least rows of a shard, and the bytes that its vectors may have.
LEAST_ROWS, SHARD_BYTES = 1024, 32 << 20
#: Rows scored together in a walk.
CHUNK = 256

_SHARDED = "shard int, kind int, id long, label long, whole array<long>, i int, j int, extra array<long>"


def codebook(points: np.ndarray, size: int) -> np.ndarray:
    """Integer centroids by Lloyd's rounds from distinct points."""
    centres = np.unique(points, axis=0)
    if len(centres) > size:
        centres = centres[np.random.default_rng(11).choice(len(centres), size, False)]
    for _ in range(ROUNDS):
        near = nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros(centres.shape)
        np.add.at(sums, near, points)
        used = counts > 0
        centres[used] = np.rint(sums[used] / counts[used, None]).astype(np.int64)
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Some centroid close to each point; radii hold for whatever it is."""
    c = centres.astype(float)
    return (points.astype(float) @ c.T - (c ** 2).sum(axis=1) / 2).argmax(axis=1)


def products(matrix: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact inner products of integers, by floating point where that is exact."""
    if not matrix.size or not other.size:
        return np.zeros((*matrix.shape[:-1], *other.shape[1:]), np.int64)
    most = int(np.abs(matrix).max()) * int(np.abs(other).max()) * matrix.shape[-1]
    if most < 1 << 53:
        return (matrix.astype(float) @ other.astype(float)).astype(np.int64)
    return matrix @ other


def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bound, i, j) for all pairs, the largest sum first, by a multi-sequence heap."""
    rows, columns = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    rows, columns = rows.tolist(), columns.tolist()
    # A row's next pair joins once the one before it left; a row, once the row above began.
    heap = [(-(a[0] + b[0]), 0, 0)] if a and b else []
    while heap:
        bound, x, y = heapq.heappop(heap)
        yield -bound, rows[x], columns[y]
        if y + 1 < len(b):
            heapq.heappush(heap, (-(a[x] + b[y + 1]), x, y + 1))
        if y == 0 and x + 1 < len(a):
            heapq.heappush(heap, (-(a[x + 1] + b[0]), x + 1, 0))


class Index:
    """Codebooks, radii, the sample and the places of cells; of bounded size."""

    def __init__(self, sample: list, rows: int, width: int):
        self.ids = np.array([r["id"] for r in sample], np.int64)
        self.labels = np.array([r["label"] for r in sample], np.int64)
        self.matrix = np.array([r["whole"] for r in sample], np.int64).reshape(-1, width)
        self.half = (width + 1) // 2
        size = min(CENTROIDS, max(1, isqrt(rows // CELL)))
        self.books = [codebook(self.matrix[:, s], size) for s in self.halves]

    @property
    def halves(self) -> tuple[slice, slice]:
        return slice(None, self.half), slice(self.half, None)

    def place(self, cells: list, shard_rows: int) -> list[tuple[int, int, int, int]]:
        """Take radii from counted cells, and deal out cells to shards.

        Returns (i, j, first shard, number of shards) of each cell that holds rows.
        """
        self.radii = [np.zeros(len(book), np.int64) for book in self.books]
        self.shards: dict[tuple[int, int], tuple[int, int]] = {}
        shard, held = 0, 0
        for r in sorted(cells, key=lambda r: (r["i"], r["j"])):
            for radii, k, far in zip(self.radii, (r["i"], r["j"]), (r["far_i"], r["far_j"])):
                radii[k] = max(radii[k], far)
            if held and held + r["n"] > shard_rows:
                shard, held = shard + 1, 0
            pieces = -(-r["n"] // shard_rows)
            self.shards[r["i"], r["j"]] = (shard, pieces)
            held += r["n"]
            if pieces > 1:
                shard, held = shard + pieces, 0
        return [(i, j, *place) for (i, j), place in self.shards.items()]

    def bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """For each half, what no row of a centroid exceeds; rows are anchors."""
        found = []
        for s, book, radii in zip(self.halves, self.books, self.radii):
            part = anchors[:, s]
            length = np.sqrt((part.astype(float) ** 2).sum(axis=1))
            reach = np.outer(length, np.sqrt(radii.astype(float))) * (1 + 1e-12)
            found.append(products(part, book.T) + np.ceil(reach).astype(np.int64) + 1)
        return found


class Positives:
    """The first rows of the anchor's own label."""

    def __init__(self, count: int):
        self.count = count

    def begin(self, anchor_id, label, extra):
        self.own, self.label = anchor_id, label
        self.ids = self.scores = np.zeros(0, np.int64)
        self.need = extra[0] if len(extra) else -(1 << 62)

    def take(self, ids, labels, scores):
        near = (labels == self.label) & (ids != self.own) & (scores >= self.need)
        if near.any():
            self.ids, self.scores = _first(np.r_[self.ids, ids[near]],
                                           np.r_[self.scores, scores[near]], self.count)
            if len(self.ids) == self.count:
                self.need = max(self.need, int(self.scores[-1]))

    def extra(self):
        """What a shard is told: the score that is needed."""
        return [self.need]

    def found(self):
        return [(self.own, 0, 0, int(i), int(s)) for i, s in zip(self.ids, self.scores)]


class Negatives:
    """The first rows of other labels in each positive's window."""

    def __init__(self, count: int, low: int, high: int):
        self.count, self.low, self.high = count, low, high

    def begin(self, anchor_id, label, extra):
        """``extra``: positive id, its score and the score needed, for each positive."""
        self.own, self.label, self.windows = anchor_id, label, []
        for positive, score, needed in np.reshape(extra, (-1, 3)).tolist():
            least, most = -(-self.low * score // 100), self.high * score // 100
            if least <= most:
                none = np.zeros(0, np.int64)
                self.windows.append([positive, score, max(least, needed), most, none, none])

    @property
    def need(self):
        return min((w[2] for w in self.windows), default=1 << 62)

    def take(self, ids, labels, scores):
        other = (labels != self.label) & (scores >= self.need)
        ids, scores = ids[other], scores[other]
        for w in self.windows if len(ids) else []:
            inside = (scores >= w[2]) & (scores <= w[3])
            if inside.any():
                w[4], w[5] = _first(np.r_[w[4], ids[inside]], np.r_[w[5], scores[inside]],
                                    self.count)
                if len(w[4]) == self.count:
                    w[2] = max(w[2], int(w[5][-1]))

    def extra(self):
        return [x for w in self.windows for x in w[:3]]

    def found(self):
        return [(self.own, w[0], w[1], int(i), int(s)) for w in self.windows
                for i, s in zip(w[4], w[5])]


def _first(ids: np.ndarray, scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:count]
    return ids[order], scores[order]


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else (
        np.zeros((0, 1), np.int64))


def _deal(index: Index, wanted):
    """Each anchor once for each shard that it has to visit."""

    def passes(batches):
        for batch in batches:
            whole = _matrix(batch.column("whole"))
            if not len(whole):
                continue
            first, second = index.bounds(whole)
            scores = products(index.matrix, whole.T)
            rows = []
            for k, (name, label, extra) in enumerate(zip(
                    batch.column("id").to_pylist(), batch.column("label").to_pylist(),
                    batch.column("extra").to_pylist())):
                wanted.begin(name, label, extra)
                wanted.take(index.ids, index.labels, scores[:, k])
                shards = set()
                for bound, i, j in cells_by_bound(first[k], second[k]):
                    if bound < wanted.need:
                        break
                    begin, pieces = index.shards.get((i, j), (0, 0))
                    shards.update(range(begin, begin + pieces))
                rows += [(shard, 1, name, label, whole[k], 0, 0, wanted.extra())
                         for shard in sorted(shards)]
            yield _batch(rows)

    return passes


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(),
             pa.int32(), pa.list_(pa.int64())]
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(columns, kinds)],
        names=["shard", "kind", "id", "label", "whole", "i", "j", "extra"])


class _Shard:
    """The rows of one shard, cell by cell."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        number = lambda name: table.column(name).to_numpy()
        order = np.lexsort((number("j"), number("i")))
        i, j = number("i")[order], number("j")[order]
        self.ids, self.labels = number("id")[order], number("label")[order]
        self.matrix = _matrix(table.column("whole").combine_chunks())[order]
        edges = np.flatnonzero((np.diff(i) != 0) | (np.diff(j) != 0)) + 1
        begins, ends = np.r_[0, edges], np.r_[edges, len(i)]
        self.rows, self.columns = np.unique(i), np.unique(j)
        self.cells = {(int(np.searchsorted(self.rows, i[a])),
                       int(np.searchsorted(self.columns, j[a]))): (int(a), int(b))
                      for a, b in zip(begins, ends)}

    def walk(self, wanted, anchor: np.ndarray, first: np.ndarray, second: np.ndarray) -> None:
        """Visit cells until what ``wanted`` still needs is above the next one's bound."""
        spans, size = [], 0
        for bound, i, j in cells_by_bound(first[self.rows], second[self.columns]):
            if bound < wanted.need:
                break
            if (i, j) in self.cells:
                spans.append(self.cells[i, j])
                size += spans[-1][1] - spans[-1][0]
            if size >= CHUNK:
                self._score(wanted, anchor, spans)
                spans, size = [], 0
        if spans:
            self._score(wanted, anchor, spans)

    def _score(self, wanted, anchor, spans):
        at = np.concatenate([np.arange(a, b) for a, b in spans])
        wanted.take(self.ids[at], self.labels[at], products(self.matrix[at], anchor))


def _visit(index: Index, wanted):
    """Shard by shard: rows first, then the anchors that visit it."""

    def passes(batches):
        at, rows, shard = None, [], None
        for batch in batches:
            where, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            edges = (np.flatnonzero((np.diff(where) != 0) | (np.diff(kind) != 0)) + 1).tolist()
            found = []
            for a, b in zip([0, *edges], [*edges, len(where)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if at != where[a]:
                    at, rows, shard = where[a], [], None
                if kind[a] == 0:
                    rows.append(part)
                    continue
                if not rows and shard is None:
                    continue
                shard = shard or _Shard(rows)
                rows = []
                anchors = _matrix(part.column("whole"))
                first, second = index.bounds(anchors)
                for k, (name, label, extra) in enumerate(zip(
                        part.column("id").to_pylist(), part.column("label").to_pylist(),
                        part.column("extra").to_pylist())):
                    wanted.begin(name, label, extra)
                    shard.walk(wanted, anchors[k], first[k], second[k])
                    found += wanted.found()
            columns = list(zip(*found)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["anchor_id", "positive_id", "positive_score", "id", "score"])

    return passes


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90,
                   id_column: str = "vec_id", vector_column: str = "embedding",
                   label_column: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    An anchor's positives are its ``positives`` best other rows of the same label; for
    each the ``negatives`` best rows of other labels whose score is ``low`` to ``high``
    hundredths of the positive's. Scores are inner products of components
    floor(256 * x); ties go to the smaller id. Fewer rows give fewer results, and a positive
    with a score below zero has an empty window.

    Rows without an id or label, with a null vector or a null or non-finite component
    take no part. Of rows that share an id the one with the smallest label and
    then vector does. Shorter vectors count as filled with zeros. No rows give none.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    named = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                           F.col(f"`{label_column}`").cast("long").alias("label"),
                           F.col(f"`{vector_column}`").alias("vector")
                           ).filter("id IS NOT NULL AND label IS NOT NULL")
    whole, width = whole_vectors(named, "vector")
    rows = staged(whole.groupBy("id").agg(F.min(F.struct("label", "whole")).alias("r"))
                  .select("id", "r.label", "r.whole"), "whole-vectors")
    count = rows.count()
    if not count:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, "
                                     "negative_id long, positive_score long, negative_score long")
    index = Index(rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect(), count, width)

    def placed(batches):
        for batch in batches:
            m = _matrix(batch.column("whole"))
            if not len(m):
                continue
            near = [(nearest(m[:, s], book), m[:, s], book)
                    for s, book in zip(index.halves, index.books)]
            far = [((part - book[k]) ** 2).sum(axis=1) for k, part, book in near]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(k.astype(np.int32)) for k, _, _ in near],
                 *[pa.array(f) for f in far]],
                names=["id", "label", "whole", "i", "j", "far_i", "far_j"])

    cells = staged(rows.mapInArrow(placed, "id long, label long, whole array<long>, i int, j int, "
                                   "far_i long, far_j long"), "cells")
    counted = cells.groupBy("i", "j").agg(F.count("*").alias("n"), F.max("far_i").alias("far_i"),
                                          F.max("far_j").alias("far_j"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard_rows = max(LEAST_ROWS, min(count // parts, SHARD_BYTES // (8 * width)))
    where = spark.createDataFrame(
        index.place(counted.collect(), shard_rows),  # CENTROIDS^2 rows at most
        "i int, j int, first int, pieces int")
    stored = cells.join(F.broadcast(where), ["i", "j"]).select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces"))).cast("int").alias("shard"),
        F.lit(0).alias("kind"), "id", "label", "whole", "i", "j",
        F.array().cast("array<long>").alias("extra"))

    def search(anchors: DataFrame, wanted) -> DataFrame:
        dealt = stored.unionByName(anchors.mapInArrow(_deal(index, wanted), _SHARDED))
        return dealt.repartition(parts, "shard").sortWithinPartitions("shard", "kind").mapInArrow(
            _visit(index, wanted), "anchor_id long, positive_id long, positive_score long, "
            "id long, score long")

    anchors = rows.filter(is_anchor(F.col("id")))
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = (search(anchors.withColumn("extra", F.array().cast("array<long>")),
                   Positives(positives))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= positives))
    none = F.lit(-(1 << 62))
    windows = staged(near.groupBy("anchor_id").agg(F.flatten(F.collect_list(
        F.array("id", "score", none))).alias("extra")), "positives")  # a few for each anchor
    found = search(anchors.join(windows, F.col("id") == F.col("anchor_id")).select(
        "id", "label", "whole", "extra"), Negatives(negatives, low, high))
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(place))
            .filter(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
