"""Line dedup, near duplicates and repeated bytes, against plain versions."""

import random

import numpy as np
import pytest

import cases
from tagweave.llm import linededup, neardup, suffixes
from tagweave.llm.components import components

ROWS = cases.documents()
REPEATED = ROWS + [ROWS[0], ROWS[0], (None, ROWS[1][1]), (None, None), (ROWS[3][0], "other text")]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("rows", [ROWS, REPEATED], ids=["plain", "repeated"])
def test_lines(spark, rows):
    done = linededup.drop_repeated_lines(cases.frame(spark, rows))
    assert set(cases.CLASH) < set(done.columns)
    got = [tuple(r) for r in done.select("doc_id", "n_lines", "n_dropped", "text").collect()]
    assert ordered(got) == ordered(cases.dropped_lines(rows))


def test_lines_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", "old")], "doc_id long, text string, n_lines string")
    assert [tuple(r) for r in linededup.drop_repeated_lines(docs).collect()] == [(1, "a\nb", 2, 0)]


def test_lines_shards_and_a_hot_line(spark, monkeypatch):
    monkeypatch.setattr(linededup, "SHARD_KEYS", 3)
    rows = [(i, f"the hottest of all lines\nthis one is shared by {i % 20} of them\nown {i}")
            for i in range(200)]
    got = linededup.drop_repeated_lines(cases.frame(spark, rows)).select(
        "doc_id", "n_lines", "n_dropped", "text").collect()
    assert ordered(map(tuple, got)) == ordered(cases.dropped_lines(rows))


def test_a_line_in_a_third_of_all_documents_has_parts_of_its_own(spark, monkeypatch):
    rows = [(i, "a line that very many documents hold\n" * (i % 3 == 0) + f"line {i // 3} of a few "
             "documents each") for i in range(900)]
    parts = []
    plain = linededup._parts
    monkeypatch.setattr(linededup, "_parts", lambda *a: parts.append(plain(*a)) or parts[-1])
    monkeypatch.setattr(linededup, "SHARD_KEYS", 20)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = linededup.drop_repeated_lines(docs)
    assert {tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()} == set(
        cases.dropped_lines(rows))
    assert max(parts[0].values()) > linededup.PARTS


def test_columns_that_differ_by_case_are_replaced(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, "x")], "Doc_ID long, TEXT string, N_Lines int, "
                                 "Rest string")
    done = linededup.drop_repeated_lines(docs)
    assert done.columns == ["Doc_ID", "TEXT", "Rest", "n_lines", "n_dropped"]
    assert tuple(done.first()) == (1, "a\nb", "x", 2, 0)


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, np.uint64)
    held = linededup.PerfectHash(keys)
    assert sorted(held.places(keys)) == list(range(5000))
    assert linededup.PerfectHash(keys[:0]).places(keys).max() == -1


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    got = neardup.near_duplicates(cases.frame(spark, ROWS), neardup.Rule(words=size)).collect()
    expected = cases.near_components(ROWS, size)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert len(got) == len(ROWS)
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)


def test_near_duplicates_of_repeated_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (5, "quite another text of some words"), (None, text), (2, None),
            (2, None)]
    got = neardup.near_duplicates(cases.frame(spark, rows)).collect()
    assert ordered((r["doc_id"], r["component_id"], r["kept"]) for r in got) == ordered(
        [(5, None, False), (5, None, False), (5, 5, True), (None, None, True), (2, 2, True),
         (2, 2, True)])


def test_a_large_band_with_several_components(spark, monkeypatch):
    """Members that the first comparison leaves apart are compared in blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(neardup, "SERVED", 4)
    rng = random.Random(3)
    centre = [f"c{i}" for i in range(60)]
    rows = []
    for family in range(3):
        own = centre[:40] + [f"f{family}x{i}" for i in range(20)]
        for _ in range(15):
            w = list(own)
            for k in rng.sample(range(60), 2):
                w[k] = f"r{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    got = neardup.near_duplicates(cases.frame(spark, rows), neardup.Rule(words=2)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == (
        cases.near_components(rows, 2))


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 1 << 63, 400, np.uint64) for _ in range(2))
    both = np.unique(np.concatenate([a, b]))
    assert (neardup.sketch(both) == np.maximum(neardup.sketch(a), neardup.sketch(b))).all()
    like = np.concatenate([a[:380], b[:20]])
    rows = [neardup.sketch(x)[None] for x in (a, like, b)]
    assert neardup.plausible(rows[0], rows[1], [400], [400], 80).all()
    assert not neardup.plausible(rows[0], rows[2], [400], [400], 80).any()


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {
        **{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("rows,bucket", [(ROWS, 1 << 20), (REPEATED, 500)])
def test_repeated_bytes(spark, monkeypatch, rows, bucket):
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", bucket)
    rng = random.Random(4)
    passage = cases.prose(rng, 30)
    rows = rows + [(200 + i, passage[i:] + "ab" * 40 + passage[:60 + i]) for i in range(6)]
    got = suffixes.remove_repeats(cases.frame(spark, rows)).collect()
    assert ordered((*r[:4], bytes(r[4])) for r in map(tuple, got)) == ordered(
        cases.removed_bytes(rows))


def test_suffixes_are_sorted():
    rng = np.random.default_rng(6)
    for high in (2, 4, 200):
        text = np.append(rng.integers(1, high + 1, 600), 0).astype(np.uint16)
        text[rng.integers(0, 600, 8)] = 0
        wanted = rng.random(601) < 0.7
        order = suffixes.sorted_suffixes(text, wanted, 12)
        assert sorted(order) == list(np.flatnonzero(wanted))
        shown = [tuple(text[i:i + 12]) + (0,) * 12 for i in order]
        shown = [s[:12] for s in shown]
        assert shown == sorted(shown)
        shared = suffixes.common_prefixes(text, order, 12)
        assert all((shown[k][:s] == shown[k + 1][:s]) for k, s in enumerate(shared))


@pytest.mark.parametrize("operator", [
    linededup.drop_repeated_lines, neardup.near_duplicates, suffixes.remove_repeats])
def test_empty_tables(spark, operator):
    assert operator(cases.frame(spark, [])).collect() == []
    assert len(operator(cases.frame(spark, [(1, None), (2, "")])).collect()) == 2


def test_anchors_follow_from_a_row_alone():
    """Neighbours in a bucket and their order don't change a row's anchors."""
    import pyarrow as pa

    from tagweave.llm.common import flat

    rng = random.Random(7)
    texts = [cases.prose(rng, rng.randrange(1, 40)) for _ in range(60)]
    own = {}
    for _ in range(4):
        rng.shuffle(texts)
        data, rows = flat(pa.array(texts))
        at, hashes, row = suffixes.anchors(data, rows)
        for k, t in enumerate(texts):
            found = sorted(zip((at[row == k] - rows[k]).tolist(), hashes[row == k].tolist()))
            assert own.setdefault(t, found) == found
            places = [p for p, _ in found]
            for start in range(len(t) - suffixes.SIZE + 1):
                assert any(start <= p <= start + suffixes.SIZE - suffixes.GRAM for p in places)


def test_hashes_of_all_places_equal_those_of_spans(monkeypatch):
    from tagweave.llm import common

    data = np.random.default_rng(8).integers(0, 256, 500).astype(np.uint8)
    at = np.arange(481)
    right = common.span_hashes(data, at, at + 20)
    monkeypatch.setattr(common, "SLICE", 64)
    assert (common.prefix_hashes(data, 20) == right).all()
    assert len(common.prefix_hashes(data[:19], 20)) == 0


def test_prefixes_in_blocks(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 7)
    text = np.append(np.random.default_rng(9).integers(1, 3, 200), 0).astype(np.uint16)
    order = suffixes.sorted_suffixes(text, np.ones(201, bool), 9)
    shown = [[*text[i:i + 9], *[0] * 9][:9] for i in order]
    assert suffixes.common_prefixes(text, order, 9).tolist() == [
        next((k for k in range(9) if a[k] != b[k]), 9) for a, b in zip(shown, shown[1:])]


def test_surroundings_end_with_their_documents(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(suffixes, "BLOCK", 5)
    rng = random.Random(10)
    texts = [cases.prose(rng, 25) for _ in range(8)]
    texts += [texts[0][:70], texts[0][:70], "", "short", texts[1][9:] + "\u00e9" * 30]
    ids = [rng.randrange(100) for _ in texts]
    held = suffixes._Bucket(pa.table({"id": ids, "text": texts}), 3)
    at, row, place, distinct, bounds = held.surroundings(np.ones(len(held.distinct), bool))
    anchor, left, right, bodies, least = distinct()
    reach = suffixes.PLACES - 1
    seen, earliest = {}, {}
    for p, r, k in zip(at, row, place):
        start, end = held.rows[r], held.rows[r + 1]
        around = bytes(held.data[max(start, p - reach):min(end, p + suffixes.GRAM + reach)])
        shown = bytes(bodies[k][reach - left[k]:reach + suffixes.GRAM + right[k]])
        assert (around, left[k]) == (shown, min(reach, p - start))
        assert not bodies[k][:reach - left[k]].any()
        assert not bodies[k][reach + suffixes.GRAM + right[k]:].any()
        assert seen.setdefault((around, left[k]), k) == k
        earliest[k] = min(earliest.get(k, 100), ids[r])
    assert len(seen) == len(least) == bounds[-1] < len(at)
    assert [earliest[k] for k in range(len(least))] == least.tolist()
    for s, (a, b) in enumerate(zip(bounds, bounds[1:])):
        assert (anchor[a:b] % np.uint64(3) == s).all()


def test_replies_hold_a_value_for_each_run():
    rng = np.random.default_rng(11)
    for n in (1, 7, 8, 300):
        found = np.repeat(rng.integers(-(1 << 63), 1 << 62, n), suffixes.PLACES)
        bits, values = suffixes._runs(found)
        assert len(suffixes.unpacked(values, "<i8")) == n
        assert (suffixes._whole(bits, values) == found).all()
        found[rng.random(len(found)) < 0.3] = suffixes.HIGHEST
        assert (suffixes._whole(*suffixes._runs(found)) == found).all()
