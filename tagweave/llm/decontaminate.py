"""Benchmark passages in documents, by Wu-Manber search for many patterns.

Texts are reduced to words with one blank between and around them, and each
window of a benchmark item becomes a pattern of that form. Patterns of similar
length form a class with a table of its own: for each block of bytes, how far the
search may move on from it. Most positions are skipped; where the shift is zero, the
hash of the block selects a bucket of patterns, and each is compared byte by byte.

All texts of a batch are searched at once: they lie in one buffer, cut into
sections with a cursor each, and the cursors move in step.

The benchmark's windows are staged in blocks of a bounded number. One block is broadcast
at a time and released after its pass over the documents, which needs no shuffle; of
several passes only the documents with hits are merged. So neither the driver nor a
worker ever holds more than one block.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import flat, sections, small_batches, staged

#: Bytes that part words: all ASCII but digits and letters. Other bytes belong to words.
GAP = np.ones(128, bool)
GAP[48:58] = GAP[65:91] = GAP[97:123] = False
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and GAP[c] else c
               for c in range(256))
#: Windows of the benchmark that one broadcast holds.
BLOCK_WINDOWS = 200_000
BLOCK, SECTION, SLOTS = 8, 512, 1 << 20


def reduced(text: bytes) -> bytes:
    """Words in lower case with one blank between and around them; none: empty."""
    words = text.translate(_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b""


def windows(text: bytes, size: int) -> list[bytes]:
    """All windows of ``size`` words of a reduced text; a shorter text is one window."""
    words = text.split()
    if not words:
        return []
    return [b" " + b" ".join(words[i:i + size]) + b" "
            for i in range(max(1, len(words) - size + 1))]


@dataclass
class _Class:
    """Patterns of similar length: shift by block, and patterns by their first block end."""

    shortest: int
    block: int
    shift: np.ndarray
    ends: np.ndarray
    order: list[bytes]


class Searcher:
    """Finds all occurrences of all patterns in a buffer."""

    def __init__(self, patterns: list[bytes]):
        self.classes = []
        by_size: dict[int, list[bytes]] = {}
        for p in sorted(set(patterns)):
            by_size.setdefault(len(p).bit_length(), []).append(p)
        for group in by_size.values():
            shortest = min(map(len, group))
            block = min(BLOCK, shortest)
            heads = np.frombuffer(b"".join(p[:shortest] for p in group), np.uint8)
            heads = heads.reshape(len(group), shortest)
            farthest = shortest - block + 1
            shift = np.full(SLOTS, min(farthest, 255), np.uint8)
            for at in range(farthest):
                slots = _slots(_blocks(heads, at, block))
                np.minimum.at(shift, slots, min(farthest - 1 - at, 255))
            last = _blocks(heads, shortest - block, block)
            by_end = np.argsort(last, kind="stable")
            self.classes.append(_Class(shortest, block, shift, last[by_end],
                                       [group[i] for i in by_end]))

    def __call__(self, data: np.ndarray) -> list[tuple[int, bytes]]:
        """(first byte, pattern) of every occurrence."""
        padded = np.concatenate([data, np.zeros(BLOCK, np.uint8)])
        raw = data.tobytes()
        found = []
        for c in self.classes:
            found += self._search(c, padded, raw)
        return found

    @staticmethod
    def _search(c: _Class, data: np.ndarray, raw: bytes) -> list[tuple[int, bytes]]:
        size, found = len(raw), []
        first = c.shortest - c.block
        at = np.arange(first, size - c.block + 1, SECTION)
        stop = np.minimum(at + SECTION, size - c.block + 1)
        while len(at):
            block = np.zeros(len(at), np.uint64)
            for i in range(c.block):
                block |= data[at + i].astype(np.uint64) << np.uint64(8 * i)
            shift = c.shift[_slots(block)].astype(np.int64)
            hits = np.flatnonzero(shift == 0)
            if len(hits):
                low = np.searchsorted(c.ends, block[hits], "left")
                high = np.searchsorted(c.ends, block[hits], "right")
                for k, a, b in zip(hits[high > low], low[high > low], high[high > low]):
                    begin = int(at[k]) - first
                    found += [(begin, p) for p in c.order[a:b] if raw.startswith(p, begin)]
            at = at + np.maximum(shift, 1)
            left = at < stop
            at, stop = at[left], stop[left]
        return found


def _blocks(heads: np.ndarray, at: int, size: int) -> np.ndarray:
    block = np.zeros(len(heads), np.uint64)
    for i in range(size):
        block |= heads[:, at + i].astype(np.uint64) << np.uint64(8 * i)
    return block


def _slots(block: np.ndarray) -> np.ndarray:
    return ((block * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)


def benchmark_windows(benchmark: DataFrame, size: int, id_column: str, text_column: str
                      ) -> DataFrame:
    """Distinct (window, item_id); items without words or id have none."""

    def cut(batches):
        for batch in batches:
            data, rows = flat(batch.column(0))
            found = [(w, item) for k, item in enumerate(batch.column(1).to_pylist())
                     for w in windows(reduced(data[rows[k]:rows[k + 1]].tobytes()), size)]
            columns = list(zip(*found)) or [[], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())],
                names=["window", "item_id"])

    return (benchmark.filter(F.col(id_column).isNotNull())
            .select(F.col(text_column).cast("string"), F.col(id_column).cast("string"))
            .mapInArrow(cut, "window binary, item_id string").distinct())


def _hits(text_rows: list[bytes], searcher: Searcher, items: dict[bytes, list[str]]
          ) -> list[tuple[np.ndarray, set[str]]]:
    """Per text which words are hit, and the items whose windows occur."""
    rows = np.cumsum([0, *map(len, text_rows)])
    data = np.frombuffer(b"".join(text_rows), np.uint8)
    found: list[tuple[np.ndarray, set[str]]] = []
    occurrences: dict[int, list[tuple[int, bytes]]] = {}
    for begin, pattern in searcher(data):
        k = int(np.searchsorted(rows, begin, "right")) - 1
        if begin + len(pattern) <= rows[k + 1]:
            occurrences.setdefault(k, []).append((begin - int(rows[k]), pattern))
    none = np.zeros(0, bool)
    for k, text in enumerate(text_rows):
        if k not in occurrences:
            found.append((none, set()))
            continue
        blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
        change = np.zeros(len(blanks), np.int64)
        held: set[str] = set()
        for begin, pattern in occurrences[k]:
            a = int(np.searchsorted(blanks, begin))
            change[a] += 1
            change[int(np.searchsorted(blanks, begin + len(pattern) - 1))] -= 1
            held.update(items[pattern])
        found.append((np.cumsum(change)[:-1] > 0, held))
    return found


FOUND = "n_words:bigint,places:array<bigint>,items:array<string>"


def find_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = 10,
                   text_column: str = "text", item_id: str = "item_id",
                   item_text: str = "text", out_column: str = "found") -> DataFrame:
    """All rows and columns of ``docs`` plus a struct of what was found in the text.

    ``n_words`` counts words (runs of digits, letters and non-ASCII characters, A-Z
    in lower case), ``n_hit`` those inside an occurrence of a window of ``size``
    consecutive words of an item, ``items`` the ids, sorted as text, of items with
    occurring windows. An item of fewer words is one window, one without words has
    none; items that repeat an id count as one. A null text has no words, an empty
    benchmark finds nothing. A column named like ``out_column`` is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    table = staged(benchmark_windows(benchmark, size, item_id, item_text).groupBy("window").agg(
        F.sort_array(F.collect_set("item_id")).alias("items")), "windows")
    blocks = 1 + table.count() // BLOCK_WINDOWS

    def shipped(block: int):
        mine = table.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        return spark.sparkContext.broadcast(
            {bytes(r["window"]): list(r["items"]) for r in mine.collect()})

    given = docs.select(F.struct("*").alias("row"),
                        F.col(f"`{text_column}`").cast("string").alias("text"))
    n_hit = lambda places: F.size(places).cast("long").alias("n_hit")
    if blocks == 1:
        done = given.select("row", _search(shipped(0))("text").alias("f")).select("row", F.struct(
            "f.n_words", n_hit("f.places"), "f.items").alias("found"))
    else:
        rows = staged(given.withColumn("number", F.monotonically_increasing_id()), "numbered")
        passes = []
        for block in range(blocks):
            part = shipped(block)
            found = rows.select("number", _search(part)("text").alias("f")).select("number", "f.*")
            # The first pass names every row, with its words.
            passes.append(staged(found.filter("size(items) > 0") if block else found, "hits"))
            part.destroy()
        every = lambda name: F.array_distinct(F.flatten(F.collect_list(name)))
        merged = reduce(DataFrame.unionAll, passes).groupBy("number").agg(F.struct(
            F.max("n_words").alias("n_words"), n_hit(every("places")),
            F.array_sort(every("items")).alias("items")).alias("found"))
        done = rows.join(merged, "number")
    kept = [c for c in docs.columns if c.lower() != out_column.lower()]
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept],
                       F.col("found").alias(out_column))


def _search(shipped):
    """Per text its words, the places of those that are hit, and the items, by one block."""
    name = uuid.uuid4().hex

    @F.arrow_udf(f"struct<{FOUND}>")
    def search(texts: pa.Array) -> pa.Array:
        data, rows = flat(texts)
        known, words, places, items = shipped.value, [], [], []
        for a, b in sections(rows):
            held = [reduced(data[rows[k]:rows[k + 1]].tobytes()) for k in range(a, b)]
            words += [max(0, t.count(b" ") - 1) for t in held]
            found = _hits(held, _searcher(name, known), known) if known else [
                (np.zeros(0, bool), set()) for _ in held]
            places += [np.flatnonzero(x) for x, _ in found]
            items += [sorted(p) for _, p in found]
        return pa.StructArray.from_arrays(
            [pa.array(words, pa.int64()), pa.array(places, pa.list_(pa.int64())),
             pa.array(items, pa.list_(pa.string()))], names=["n_words", "places", "items"])

    return search


_BUILT: dict[str, Searcher] = {}


def _searcher(name: str, known: dict[bytes, list[str]]) -> Searcher:
    """The searcher of one block; a worker process keeps only the last."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Searcher(list(known))
    return _BUILT[name]
