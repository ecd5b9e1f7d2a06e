"""Removing bytes that an earlier document has too, by sorted suffixes.

A byte goes if a string of SIZE bytes that covers it also starts in a document with a
smaller id. Equal strings meet by content, not by position:

1. Every string of SIZE bytes holds an anchor, a gram of GRAM bytes whose hash is the
   least in it; equal strings have equal anchors at equal places. About one position
   in 16 is one. Documents are dealt to buckets of bounded size; a bucket sends the
   hashes of its distinct anchors to shards and learns which of them other buckets
   have too.
2. For repeated anchors a bucket sends what surrounds them, as far as strings with
   the anchor reach, to a shard of the anchor: equal surroundings once, with the
   smallest id of their documents.
3. The shard sorts the suffixes of the surroundings by two-stage sorting: suffixes
   smaller than their successors directly, the others by scanning the buckets of first
   symbols in order, each placing those that precede its members. Neighbours with a
   common prefix of SIZE bytes are one string, and the smallest id of its
   documents goes back.
4. Buckets mark what is covered by strings with a smaller id than the document's own.

What a shard holds is bounded by distinct surroundings, not by how often they occur
in a bucket, so copies of one text weigh little.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import (flat, mixed, packed, prefix_hashes, sections, small_batches,
                                 unpacked)

#: Bytes of a repeated string, and of an anchor in it.
SIZE, GRAM = 50, 20
#: Places of a string around its anchor; bytes around an anchor, with it.
PLACES = SIZE - GRAM + 1
AROUND = SIZE + PLACES - 1
BUCKET_BYTES, BUCKETS_PER_SHARD = 3 << 20, 4
#: Bytes whose anchors are looked for at a time.
SECTION = 1 << 19
#: Surroundings hashed, compared and marked at a time.
BLOCK = 1 << 12
#: Surroundings whose suffixes are sorted at a time, if one anchor has no more.
SORTED = 10_000
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(x: np.ndarray, size: int, least) -> np.ndarray:
    """``least`` (a minimum or maximum) of each ``size`` neighbours."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = least(x[:len(x) - step], x[step:])
        have += step
    return x


def anchors(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, hashes and rows of all anchors; every string of SIZE bytes in a row has one."""
    found = []
    for a, b in sections(rows, SECTION):
        part, bounds = data[rows[a]:rows[b]], rows[a:b + 1] - rows[a]
        n = len(part) - GRAM + 1
        if len(part) < SIZE:
            continue
        to_end = np.repeat(bounds[1:], np.diff(bounds))[:n] - np.arange(n)
        hashes = prefix_hashes(part, GRAM)
        hashes[to_end < GRAM] = _NONE
        least = _slide(hashes, PLACES, np.minimum)
        # Strings that cross rows count for nothing: anchors follow from a row's own text.
        least[to_end[:len(least)] < SIZE] = 0
        edge = np.zeros(PLACES - 1, np.uint64)
        most = _slide(np.concatenate([edge, least, edge]), PLACES, np.maximum)
        at = np.flatnonzero((most == hashes) & (hashes != _NONE))
        found.append((at + rows[a], hashes[at], np.searchsorted(bounds, at, "right") - 1 + a))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def sorted_suffixes(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in order of their first ``depth`` symbols, by two-stage sorting.

    ``text`` holds symbols from 0 to 256 and ends with 0. Suffixes that agree in so
    many symbols are neighbours, in any order.
    """
    n = len(text)
    at = np.arange(n)
    differs = np.append(text[:-1] != text[1:], True)
    next_step = np.minimum.accumulate(np.where(differs, at, n - 1)[::-1])[::-1]
    smaller = np.append(text[:-1] < text[1:], True)[next_step] | (text == 0)
    # A suffix that is induced needs its successors, up to one that is sorted directly.
    stop = np.minimum.accumulate(np.where(smaller, at, n - 1)[::-1])[::-1]
    change = np.zeros(n + 1, np.int64)
    change[:n] += wanted
    change[1:] -= np.bincount(stop[wanted], minlength=n)
    needed = np.cumsum(change[:n]) > 0
    direct = np.flatnonzero(needed & smaller)
    wide = np.concatenate([text, np.zeros(depth + 7, text.dtype)]).astype(np.uint64)
    seven = wide[:n + depth].copy()  # seven symbols from each place on
    for i in range(1, 7):
        seven <<= np.uint64(9)
        seven |= wide[i:n + depth + i]
    keys = [seven[direct + first] >> np.uint64(9 * max(first + 7 - depth, 0))
            for first in range(0, depth, 7)]
    direct = direct[np.lexsort(keys[::-1])]
    first = text[direct]
    induced = needed & ~smaller
    waiting: dict[int, list[np.ndarray]] = {}
    order = []
    for c in np.unique(text[needed]):
        c = int(c)
        bucket = waiting.pop(c, [])
        fresh = bucket
        while fresh:  # suffixes whose successor starts with the same symbol
            before = np.concatenate(fresh) - 1
            before = before[before >= 0]
            before = before[induced[before] & (text[before] == c)]
            fresh = [before] if len(before) else []
            bucket = bucket + fresh
        low, high = np.searchsorted(first, [c, c + 1])
        bucket = np.concatenate([*bucket, direct[low:high]])
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[induced[before] & (text[before] > c)]
        before = before[np.argsort(text[before], kind="stable")]
        symbols, starts = np.unique(text[before], return_index=True)
        for symbol, a, b in zip(symbols, starts, [*starts[1:], len(before)]):
            waiting.setdefault(int(symbol), []).append(before[a:b])
    order = np.concatenate(order) if order else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Symbols that each suffix shares with the next one in order, up to ``depth``."""
    wide = np.concatenate([text, np.zeros(depth, text.dtype)])
    shared = np.empty(max(len(order) - 1, 0), np.int64)
    for a in range(0, len(shared), BLOCK):
        held = _windows(wide, order[a:a + BLOCK + 1], depth)
        same = np.zeros((len(held) - 1, depth + 1), bool)  # the first that is not ends it
        np.equal(held[:-1], held[1:], out=same[:, :depth])
        shared[a:a + BLOCK] = same.argmin(axis=1)
    return shared


def _windows(x: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Rows of the ``size`` values of ``x`` from each place on."""
    whole = np.dtype((np.void, size * x.itemsize))
    held = np.ndarray(len(x) - size + 1, whole, np.ascontiguousarray(x), 0, x.itemsize)[at]
    return held.view(x.dtype).reshape(len(at), size)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the keys in order, where each distinct key starts there, and each one's number."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.append(True, ranked[1:] != ranked[:-1])[:len(keys)]
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), of


def _by_shard(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys by shard, else as they are, and the bounds of the shards."""
    shard = (keys % np.uint64(shards)).astype(np.min_scalar_type(shards))
    order = np.argsort(shard, kind="stable")
    return order, np.searchsorted(shard[order], np.arange(shards + 1))


def earliest(bodies: np.ndarray, left: np.ndarray, right: np.ndarray, anchor: np.ndarray,
             ids: np.ndarray) -> np.ndarray:
    """For distinct surroundings the smallest id of each of their PLACES strings.

    Strings that reach beyond a document get HIGHEST. An anchor with one kind of
    surroundings needs no sorting: all its strings have the same documents.
    """
    n = len(ids)
    place = np.arange(PLACES)
    valid = (place >= PLACES - 1 - left[:, None]) & (
        place + SIZE <= PLACES - 1 + GRAM + right[:, None].astype(np.int64))
    found = np.where(valid, ids[:, None], HIGHEST)
    _, of, kinds = np.unique(anchor, return_inverse=True, return_counts=True)
    several = np.flatnonzero(kinds[of] > 1)
    several = several[np.argsort(of[several], kind="stable")]
    edges = np.append(np.flatnonzero(np.diff(of[several], prepend=-1)), len(several))
    a = 0
    while a < len(several):  # whole anchors, about so many surroundings at a time
        b = int(edges[np.searchsorted(edges, min(a + SORTED, len(several)))])
        _sort_into(found, several[a:b], bodies, left, right, valid, ids)
        a = b
    return found


def _sort_into(found, several, bodies, left, right, valid, ids) -> None:
    column = np.arange(AROUND)
    text = np.zeros((len(several), AROUND + 1), np.uint16)
    inside = (column >= PLACES - 1 - left[several, None]) & (
        column < PLACES - 1 + GRAM + right[several, None].astype(np.int64))
    text[:, :AROUND] = np.where(inside, bodies[several].astype(np.uint16) + 1, 0)
    wanted = np.zeros((len(several), AROUND + 1), bool)
    wanted[:, :PLACES] = valid[several]
    text = text.ravel()
    order = sorted_suffixes(text, wanted.ravel(), SIZE)
    if len(order):
        new = np.append(True, common_prefixes(text, order, SIZE) < SIZE)
        row, at = several[order // (AROUND + 1)], order % (AROUND + 1)
        least = np.minimum.reduceat(ids[row], np.flatnonzero(new))
        found[row, at] = least[np.cumsum(new) - 1]


class _Bucket:
    """Anchors of a bucket's texts; the distinct ones in a fixed order by shard."""

    def __init__(self, table: pa.Table, shards: int):
        self.shards = shards
        self.ids = table.column("id").to_numpy()
        self.data, self.rows = flat(table.column("text"))
        self.at, hashes, self.row = anchors(self.data, self.rows)
        ranked, first, code = _groups(hashes)
        distinct = hashes[ranked[first]]
        order, self.bounds = _by_shard(distinct, shards)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.code, self.distinct = place[code], distinct[order]

    def in_several_rows(self) -> np.ndarray:
        low, high = np.zeros((2, len(self.distinct)), np.int64)
        high[self.code] = self.row  # rows ascend and the last one assigned stays
        low[self.code[::-1]] = self.row[::-1]
        return low != high

    def surroundings(self, repeated: np.ndarray):
        """Occurrences of repeated anchors; their distinct surroundings by shard, if called for."""
        mine = np.flatnonzero(repeated[self.code])
        at, row, code = self.at[mine], self.row[mine], self.code[mine]
        left = np.minimum(at - self.rows[row], PLACES - 1).astype(np.uint8)
        right = np.minimum(self.rows[row + 1] - at - GRAM, PLACES - 1).astype(np.uint8)
        edge = np.zeros(AROUND, np.uint8)
        wide = np.concatenate([edge[:PLACES - 1], self.data, edge])
        marks = np.empty(len(mine), np.uint64)
        for a in range(0, len(mine), BLOCK):
            b = slice(a, a + BLOCK)
            marks[b] = _marks(_bodies(wide, at[b], left[b], right[b]), left[b], right[b])
        ranked, starts, of = _groups(marks)
        first = ranked[starts]
        anchor = self.distinct[code[first]]
        order, bounds = _by_shard(anchor, self.shards)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))

        def distinct():
            kept = first[order]
            ids = self.ids[row[ranked]]
            least = np.minimum.reduceat(ids, starts) if len(ids) else ids
            return (anchor[order], left[kept], right[kept],
                    _bodies(wide, at[kept], left[kept], right[kept]), least[order])

        return at, row, place[of], distinct, bounds


def _bodies(wide: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The bytes around anchors, 0 beyond their documents; ``wide`` starts PLACES - 1 early."""
    bodies = _windows(wide, at, AROUND)
    cut = np.flatnonzero((left < PLACES - 1) | (right < PLACES - 1))
    column = np.arange(AROUND)
    bodies[cut] *= (column >= PLACES - 1 - left[cut, None]) & (
        column < PLACES - 1 + GRAM + right[cut, None].astype(np.int64))
    return bodies


def _marks(bodies: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of each surroundings, its ends included; a body is ten words of 8 bytes."""
    marks = left.astype(np.uint64) << np.uint64(8) | right
    for a in range(0, len(marks), BLOCK):
        held = marks[a:a + BLOCK]
        for word in np.ascontiguousarray(bodies[a:a + BLOCK]).view(np.uint64).T:
            held ^= word
            held ^= held >> np.uint64(29)
            held *= np.uint64(0x9E3779B97F4A7C15)
            held ^= held >> np.uint64(32)
    return mixed(marks)


_ASK = "shard int, bucket int, hashes binary"
_SEND = ("shard int, bucket int, known binary, anchor binary, lefts binary, rights binary, "
         "bodies binary, least binary")
_REPLY = "shard int, bucket int, known binary, least binary"


def _table(rows: list[tuple], columns: str) -> pa.Table:
    names = [c.split() for c in columns.split(", ")]
    kinds = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}
    lists = list(zip(*rows)) or [[]] * len(names)
    return pa.table({n: pa.array(x, kinds[k]) for (n, k), x in zip(names, lists)})


def _runs(values: np.ndarray) -> tuple[bytes, bytes]:
    """Where values differ from the one before, as bits, and these values."""
    new = np.append(True, values[1:] != values[:-1])
    return np.packbits(new).tobytes(), packed(values[new])


def _whole(new: bytes, values: bytes) -> np.ndarray:
    """The rows of PLACES values that ``_runs`` took."""
    bits = np.unpackbits(np.frombuffer(new, np.uint8))
    bits = bits[:len(bits) // PLACES * PLACES]
    return unpacked(values, "<i8")[np.cumsum(bits, dtype=np.int64) - 1]


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
                   ) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and the bytes kept (binary).

    A byte of the UTF-8 text is removed if a string of SIZE bytes around it within the
    document also starts in a document with a smaller id, by the texts as given.
    ``n_spans`` counts maximal removed runs. A null text is empty, shorter texts than
    SIZE bytes are kept; rows that repeat an id don't count as earlier than each
    other, a null id is earlier than all. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    given = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)).alias("id"),
                        text.alias("text"))
    size = given.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = 1 + size // BUCKET_BYTES
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 1 + buckets // BUCKETS_PER_SHARD)
    dealt = given.withColumn("bucket", F.pmod(
        F.xxhash64("id", "text"), F.lit(buckets)).cast("int"))

    def ask(table: pa.Table) -> pa.Table:
        held, bucket = _Bucket(table, shards), table.column("bucket")[0].as_py()
        return _table([(s, bucket, packed(held.distinct[held.bounds[s]:held.bounds[s + 1]]
                                          >> np.uint64(16))) for s in range(shards)], _ASK)

    def tell(table: pa.Table) -> pa.Table:
        hashes = [unpacked(x, "<u8") for x in table.column("hashes").to_pylist()]
        bounds = np.cumsum([0, *map(len, hashes)])
        _, of, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        bits = times[of] > 1
        return _table([(s, bucket, np.packbits(bits[a:b]).tobytes()) for s, bucket, a, b in zip(
            table.column("shard").to_pylist(), table.column("bucket").to_pylist(), bounds,
            bounds[1:])], _ASK)

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        held, bucket = _Bucket(table, shards), table.column("bucket")[0].as_py()
        repeated = held.in_several_rows()
        for s, bits in zip(replies.column("shard").to_pylist(),
                           replies.column("hashes").to_pylist()):
            a, b = held.bounds[s], held.bounds[s + 1]
            repeated[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a) > 0
        _, _, _, distinct, bounds = held.surroundings(repeated)
        columns = distinct()
        rows = [(s, bucket, b"", *(packed(x[a:b]) for x in columns))
                for s, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
        rows.append((-1 - bucket, bucket, np.packbits(repeated).tobytes(), *[b""] * 5))
        return _table(rows, _SEND)

    def judge(table: pa.Table) -> pa.Table:
        if table.column("shard")[0].as_py() < 0:
            return table.select(["shard", "bucket", "known", "least"])
        parts = [[unpacked(x, kind) for x in table.column(name).to_pylist()] for name, kind in (
            ("anchor", "<u8"), ("lefts", "u1"), ("rights", "u1"), ("bodies", "u1"),
            ("least", "<i8"))]
        bounds = np.cumsum([0, *map(len, parts[0])])
        anchor, left, right, bodies, ids = (np.concatenate(p) for p in parts)
        bodies = bodies.reshape(-1, AROUND)
        ranked, starts, of = _groups(_marks(bodies, left, right))
        first, least = ranked[starts], np.minimum.reduceat(ids[ranked], starts)
        found = earliest(bodies[first], left[first], right[first], anchor[first], least)
        return _table([(s, bucket, *_runs(found[of[a:b]].ravel())) for s, bucket, a, b in zip(
                           table.column("shard").to_pylist(),
                           table.column("bucket").to_pylist(), bounds, bounds[1:])], _REPLY)

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        held = _Bucket(table, shards)
        replies = replies.sort_by("shard")
        known = np.frombuffer(replies.column("known")[0].as_py(), np.uint8)
        repeated = np.unpackbits(known, count=len(held.distinct)) > 0
        at, row, place, _, _ = held.surroundings(repeated)
        least = [_whole(*x) for x in zip(replies.column("known").to_pylist()[1:],
                                         replies.column("least").to_pylist()[1:])]
        least = np.concatenate([np.zeros(0, np.int64), *least]).reshape(-1, PLACES)
        starts = np.zeros(SIZE - 1 + len(held.data), bool)
        for a in range(0, len(at), BLOCK):
            b = slice(a, a + BLOCK)
            which, offset = np.nonzero(least[place[b]] < held.ids[row[b], None])
            starts[at[b][which] + (SIZE - PLACES) + offset] = True
        gone = _slide(starts, SIZE, np.logical_or)
        rows = held.rows
        total = np.append(np.int32(0), np.cumsum(gone, dtype=np.int32))
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = rows[1:-1][rows[1:-1] < len(gone)]
        begins[inner] = gone[inner]
        spans = np.append(np.int32(0), np.cumsum(begins, dtype=np.int32))
        kept = (rows - total[rows]).astype(np.int32)
        return pa.table({
            "id": table.column("id"), "n_bytes": pa.array(np.diff(rows)),
            "n_removed": pa.array(np.diff(total[rows]).astype(np.int64)),
            "n_spans": pa.array(np.diff(spans[rows]).astype(np.int64)),
            "kept": pa.Array.from_buffers(pa.binary(), len(rows) - 1, [
                None, pa.py_buffer(kept), pa.py_buffer(held.data[~gone])])})

    told = dealt.groupBy("bucket").applyInArrow(ask, _ASK).groupBy("shard").applyInArrow(
        tell, _ASK)
    sent = dealt.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(send, _SEND)
    judged = sent.groupBy("shard").applyInArrow(judge, _REPLY)
    done = dealt.groupBy("bucket").cogroup(judged.groupBy("bucket")).applyInArrow(
        cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return done.select(F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"), "n_bytes",
                       "n_removed", "n_spans", "kept")
