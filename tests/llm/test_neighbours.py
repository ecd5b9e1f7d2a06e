"""Nearest neighbours against all inner products."""

import math

import numpy as np
import pyarrow as pa
import pytest

from tagweave.llm import ann

NAMES = "vec_id long, embedding array<float>, score string, i int, ids string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], NAMES).repartition(3)


def exact(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x)
                                                       for x in v) and any(v)]
    out = {}
    for i, q in good:
        if i % 5 == 0:
            near = sorted((-float(q @ v), j) for j, v in good if j != i)[:k]
            out[i] = [(rank, j, -s) for rank, (s, j) in enumerate(near, 1)]
    return out


def found(spark, rows, k, visit=1):
    got = {}
    for r in ann.search(table(spark, rows), lambda c: c % 5 == 0, k, visit=visit).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in got.items()}


def same(a, b):
    assert a.keys() == b.keys()
    for q in a:
        assert [x[:2] for x in a[q]] == [x[:2] for x in b[q]]
        assert [x[2] for x in a[q]] == pytest.approx([x[2] for x in b[q]], abs=1e-12)


def test_ties_copies_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 7)]) for i in range(60)]
    rows = [(i, v if any(v) else [1.0] * 7) for i, v in rows]
    rows += [(100 + i, rows[3][1]) for i in range(80)]
    rows += [(300, None), (305, [0.0] * 7), (310, [float("nan")] * 7), (315, [None] * 7),
             (320, [float("inf")] * 7), (None, rows[0][1]), (325, [])]
    same(found(spark, rows, 6), exact(rows, 6))


def test_blocks_and_few_candidates(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_BYTES", 320)
    monkeypatch.setattr(ann, "HELD", 7)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(40)]
    same(found(spark, rows, 50), exact(rows, 50))
    assert found(spark, rows[:1], 3) == {}
    assert found(spark, [], 3) == {}


@pytest.mark.parametrize("spread", [0, 0.5, 1])
def test_recall_on_vectors_without_structure(spark, spread):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(3000, 64))
    m *= (rng.lognormal(0, spread, 3000) / np.linalg.norm(m, axis=1))[:, None]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    got, right = found(spark, rows, 20, ann.VISIT), exact(rows, 20)
    hits = sum(len({j for _, j, _ in got[q]} & {j for _, j, _ in right[q]}) for q in right)
    assert hits >= 0.9 * 20 * len(right)


def test_only_visited_cells_are_multiplied():
    rng = np.random.default_rng(4)
    m, column = rng.normal(size=(500, 8)), rng.integers(0, 9, 500)
    block = ann.Block(pa.table({"js": [[int(j)] for j in column], "vector": m.tolist(),
                                "ids": [[i] for i in range(500)]}))
    queries = rng.normal(size=(30, 8))
    visits = [[int(j) for j in range(12) if (j + k) % 3 == 0] for k in range(30)]
    scores, products = block.scores(queries, visits)
    order = [i for i, in block.ids]
    allowed = np.array([[column[i] in js for i in order] for js in visits])
    assert products == allowed.sum() == np.isfinite(scores).sum() < 0.4 * scores.size
    assert scores[allowed] == pytest.approx((queries @ m[order].T)[allowed])


def test_vectors_of_several_lengths_all_take_part(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=5 + i % 4)]) for i in range(60)]
    filled = [(i, v + [0.0] * (8 - len(v))) for i, v in rows]
    assert {q: len(v) for q, v in found(spark, rows, 70).items()} == {q: 59 for q in range(0, 60, 5)}
    same(found(spark, rows, 70), exact(filled, 70))


def test_cells_come_in_order():
    a, b = np.array([3.0, 1.0, 2.0]), np.array([0.0, 5.0])
    counts = np.array([[1, 1], [0, 1], [1, 1]])
    cells = ann.visited(a, b, counts, 10)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums, reverse=True) and len(cells) == 5
    assert ann.visited(a, b, counts, 2) == cells[:2]
