"""Hard negatives and vector codes against plain loops over all rows."""

import hashlib
import math
import random
from collections import defaultdict
from itertools import product

import duckdb
import numpy as np
import pytest

from tagweave.llm import hardnegatives, integers, oracles, queries, vectorcodes

NAMES = "vec_id long, embedding array<float>, label int, id string, whole string, i int, score int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 1, 2) for r in rows], NAMES).repartition(3)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def ints(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def awkward(rng, n=150, size=8, labels=4):
    """Rows with ties, copies, a hot vector, gaps and vectors that take no part."""
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.7]) for _ in range(size)],
             rng.randrange(labels)) for i in range(n)]
    rows += [(n + i, rows[10][1], 1) for i in range(n // 2)]
    rows += [(900, None, 1), (905, [float("nan")] * size, 1), (910, [None] * size, 2),
             (915, [float("inf")] * size, 2), (920, [1.0] * (size - 3), 2), (925, [], 3),
             (930, rows[4][1], None), (None, rows[5][1], 1), rows[20]]
    return rows


def plain_negatives(rows, every, positives=5, negatives=10):
    seen = {}
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            seen[i] = min(seen.get(i, (99,)), (label, ints(v)))
    width = max((len(v) for _, v in seen.values()), default=0)
    kept = {i: (label, v + [0] * (width - len(v))) for i, (label, v) in seen.items()}
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other)
                        for i, (other, w) in kept.items() if i != a)
        for s, p in [(-s, i) for s, i, other in scored if other == label][:positives]:
            window = [(i, -t) for t, i, other in scored
                      if other != label and 30 * s <= -100 * t <= 90 * s]
            out += [(a, p, rank, i, s, t) for rank, (i, t) in enumerate(window[:negatives], 1)]
    return sorted(out)


def found_negatives(spark, rows, every):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in hardnegatives.hard_negatives(
        table(spark, rows), lambda c: c % every == 0).select(columns).collect())


@pytest.mark.parametrize("least, cell", [(1024, 64), (7, 2)])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, least, cell):
    monkeypatch.setattr(hardnegatives, "LEAST_ROWS", least)
    monkeypatch.setattr(hardnegatives, "SHARD_BYTES", 1)
    monkeypatch.setattr(hardnegatives, "CELL", cell)
    rows = awkward(random.Random(3))
    found = found_negatives(spark, rows, 10)
    assert found == plain_negatives(rows, 10) and len(found) > 100


def test_hard_negatives_of_few_or_no_rows(spark):
    assert found_negatives(spark, [], 1) == []
    assert found_negatives(spark, [(0, [1.0], 1), (1, [0.5], 1), (2, [0.3], 2)], 1) == (
        plain_negatives([(0, [1.0], 1), (1, [0.5], 1), (2, [0.3], 2)], 1))
    one_label = [(i, [1.0, i / 10], 1) for i in range(5)]
    assert found_negatives(spark, one_label, 1) == []


def test_walks_stop_early_where_vectors_have_structure(monkeypatch):
    monkeypatch.setattr(hardnegatives, "CELL", 2)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16)) * 4
    rows = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.1
    whole = np.floor(256 * rows).astype(np.int64)
    sample = [{"id": i, "label": i % 2, "whole": v} for i, v in enumerate(whole[:800].tolist())]
    index = hardnegatives.Index(sample, 4000, 16)
    near = [hardnegatives.nearest(whole[:, s], b) for s, b in zip(index.halves, index.books)]
    far = [((whole[:, s] - b[k]) ** 2).sum(axis=1)
           for s, b, k in zip(index.halves, index.books, near)]
    groups = defaultdict(list)
    for row, cell in enumerate(zip(*map(np.ndarray.tolist, near))):
        groups[cell].append(row)
    index.place([{"i": i, "j": j, "n": len(g), "far_i": int(far[0][g].max()),
                  "far_j": int(far[1][g].max())} for (i, j), g in groups.items()], 200)
    first, second = index.bounds(whole[:50])
    looked = 0
    for k in range(50):
        wanted = hardnegatives.Positives(5)
        wanted.begin(k, k % 2, [])
        wanted.take(index.ids, index.labels, hardnegatives.products(index.matrix, whole[k]))
        last = None
        for bound, i, j in hardnegatives.cells_by_bound(first[k], second[k]):
            assert last is None or bound <= last
            last = bound
            if bound < wanted.need:
                break
            rows_of = np.array(groups.get((i, j), []), int)
            looked += len(rows_of)
            if len(rows_of):
                scores = whole[rows_of] @ whole[k]
                assert scores.max() <= bound
    assert looked < 0.2 * 50 * 4000


def test_products_are_exact_beyond_floats():
    a = np.array([[1 << 30, 3]], np.int64)
    b = np.array([[(1 << 30) + 1, 7]], np.int64)
    assert hardnegatives.products(a, b.T)[0, 0] == (1 << 30) * ((1 << 30) + 1) + 21


def plain_codes(rows, parts=16, entries=64, rounds=2):
    kept = [(i, label, ints(v)) for i, v, label in rows if usable(v)]
    width = max(1, -(-max((len(v) for _, _, v in kept), default=0) // parts)) * parts
    kept = [(i, label, v + [0] * (width - len(v))) for i, label, v in kept]
    size = width // parts
    cut = lambda v, p: v[p * size:(p + 1) * size]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[2]))[:entries]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            groups = defaultdict(list)
            for _, _, v in kept:
                groups[near(cut(v, p), book)[1]].append(cut(v, p))
            for k, g in groups.items():
                book[k] = [sum(c) // len(g) for c in zip(*g)]
    coded = []
    for i, label, v in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    sums = defaultdict(int)
    for _, label, _, error in coded:
        sums[label] += error
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()
                            ).hexdigest()
    return [(i, code, error, sums[label], digest) for i, label, code, error in coded]


def found_codes(spark, rows):
    coded = vectorcodes.compress(table(spark, rows))
    return [(r["id"], "".join(f"{k:02x}" for k in r["codes"]), r["error"], r["label_error"],
             r["codebooks_sha256"]) for r in coded.collect()]


@pytest.mark.parametrize("size", [16, 40, 7])
def test_codes_equal_plain_rounds(spark, size):
    rows = awkward(random.Random(size), 120, size)
    order = lambda r: tuple(map(str, r))
    assert sorted(found_codes(spark, rows), key=order) == sorted(plain_codes(rows), key=order)


def test_codes_of_few_or_no_rows(spark):
    assert found_codes(spark, []) == []
    few = [(1, [0.5] * 16, None), (2, [0.5] * 16, None), (0, [-0.25] * 16, 3)]
    assert sorted(found_codes(spark, few)) == sorted(plain_codes(few))


def test_decoded_vectors_lie_at_the_stated_error(spark):
    rows = [r for r in awkward(random.Random(9), 100, 32) if usable(r[1])]
    whole, width = integers.whole_vectors(
        table(spark, rows).selectExpr("vec_id AS id", "label", "embedding AS vector"), "vector", 16)
    books = vectorcodes.fit(whole, width)
    coded = vectorcodes.decode(vectorcodes.encode(whole, books), books)
    for r in coded.join(whole.select("id", "whole"), "id").collect():
        if r["id"] != 20:  # two rows have it
            assert sum((256 * x - y) ** 2 for x, y in zip(r["vector"], r["whole"])) == r["error"]


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError, match="components"):
        found_codes(spark, [(1, [1e30] * 16, 1)])


@pytest.mark.parametrize("size", [1, 2, 3, 4, 6, 8, 13])
def test_transformed_distances_are_multiples_of_the_distance(size):
    rng = np.random.default_rng(size)
    points, book = rng.integers(-300, 300, (50, size)), rng.integers(-300, 300, (9, size))
    book[4] = book[2]
    index, distance = vectorcodes.nearest(vectorcodes.transformed(points),
                                          vectorcodes.transformed(book))
    right = ((points[:, None] - book) ** 2).sum(axis=2)
    assert index.tolist() == right.argmin(axis=1).tolist()
    assert distance.tolist() == right.min(axis=1).tolist()


def test_sequencies_rise():
    for size in (1, 2, 4, 8, 16):
        order = vectorcodes.sequency_order(size)
        matrix = np.array([[1 - 2 * (bin(a & b).count("1") & 1) for b in range(size)]
                           for a in range(size)])[order]
        changes = (np.diff(matrix, axis=1) != 0).sum(axis=1)
        assert changes.tolist() == list(range(size))


@pytest.mark.parametrize("name", ["op11_certified_negatives", "op13_walsh_codes"])
def test_queries_equal_their_sql(spark, tmp_path, name):
    rng = random.Random(12)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(32)], rng.choice([None, *range(10)]))
            for i in range(0, 900, 3)]
    rows += [(2000, None, 1), (2100, [float("nan")] * 32, 2), (2200, rows[0][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    path = str(tmp_path / "embeddings.parquet")
    frame.coalesce(1).write.parquet(path)
    found = queries.queries()[name](spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/*.parquet'")
    result = db.execute(oracles.SQL[name])
    right = [dict(zip([d[0] for d in result.description], r)) for r in result.fetchall()]
    key = lambda r: tuple(sorted(r.items()))
    assert sorted((r.asDict() for r in found.collect()), key=key) == sorted(right, key=key)
    assert right
