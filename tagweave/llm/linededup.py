"""Removing lines that many documents repeat, by a sharded minimal perfect hash.

1. Each document gives the 128-bit hashes of its distinct keys of lines. They are
   counted by a grouped aggregate that combines before its shuffle, so a line in
   a third of all documents is no hot key. Keys in too few documents go.
2. The other keys are dealt to shards by their hash. Each shard builds a minimal
   perfect hash over its keys, which places fingerprints, document counts and the
   largest document id in compact arrays without gaps.
3. Documents send their hashes to the shards, and a shard's arrays are replicated to
   the probing parts of the shard, of which one with a very frequent key has as many
   more as its count asks for. A task reads the arrays of one part, then probes batch by
   batch, so it holds one shard and one batch. No line is joined with a line, and no
   array is broadcast.
4. The few hits go back to their documents, which drop the lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import flat, lowered, mixed, small_batches, staged

BLANKS = " \t\n\x0b\f\r"
#: Keys that one shard's arrays hold, about; parts that probe one shard, at least.
SHARD_KEYS = 200_000
PARTS = 4
#: Bits for each key in a level of the perfect hash.
GAMMA = 1.7
LOWEST = -(1 << 63)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit values, as levels of bits with ranks.

    A value that collides at one level goes on to the next; the place of a value is
    the number of set bits before its own. Values that were not given may get any
    place, or none (-1).
    """

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, np.uint64)
        self.levels: list[np.ndarray] = []
        while len(values):
            size = max(64, int(GAMMA * len(values)))
            slot = self._slot(values, len(self.levels), size)
            taken = np.bincount(slot, minlength=size)
            self.levels.append(taken == 1)
            values = values[taken[slot] != 1]
        bits = np.concatenate(self.levels) if self.levels else np.zeros(0, bool)
        self.ranks = np.cumsum(bits, dtype=np.int64) - 1
        self.starts = np.cumsum([0, *(len(x) for x in self.levels)])

    @staticmethod
    def _slot(values: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mixed(values ^ salt) % np.uint64(size)).astype(np.int64)

    def places(self, values: np.ndarray) -> np.ndarray:
        values = np.asarray(values, np.uint64)
        found = np.full(len(values), -1, np.int64)
        rest = np.arange(len(values))
        for level, bits in enumerate(self.levels):
            slot = self._slot(values[rest], level, len(bits))
            hit = bits[slot]
            found[rest[hit]] = self.ranks[self.starts[level] + slot[hit]]
            rest = rest[~hit]
        return found


class Shard:
    """Fingerprints, counts and largest ids at the places of a perfect hash."""

    def __init__(self, keys: np.ndarray, prints: np.ndarray, counts: np.ndarray,
                 largest: np.ndarray):
        self.hash = PerfectHash(keys)
        order = np.argsort(self.hash.places(keys))
        self.prints, self.counts = prints[order], counts[order]
        self.largest = largest[order]

    def probe(self, keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many documents hold each key (0: none known) and the largest of them."""
        places = self.hash.places(keys)
        known = (places >= 0) & (len(self.prints) > 0)
        known[known] = self.prints[places[known]] == prints[known]
        counts, largest = np.zeros(len(keys), np.int64), np.full(len(keys), LOWEST)
        counts[known] = self.counts[places[known]]
        largest[known] = self.largest[places[known]]
        return counts, largest


def _keys(docs: DataFrame, least_chars: int) -> DataFrame:
    """Per document its row id and the hashes of its distinct long keys."""
    keys = F.filter(
        F.transform(F.split(lowered(F.col("text")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS))),
        lambda x: F.length(x) >= least_chars)
    hashed = F.array_distinct(F.transform(
        keys, lambda x: F.struct(F.xxhash64(x).alias("k"), F.xxhash64(F.lit(7), x).alias("f"))))
    return docs.select("id", "h", hashed.alias("keys"))


def repeated_keys(keys: DataFrame, least_docs: int) -> DataFrame:
    """Keys that enough documents hold, with their count and the largest id."""
    return (keys.select("id", F.explode("keys").alias("key"))
            .groupBy(F.col("key.k").alias("k"), F.col("key.f").alias("f"))
            .agg(F.count("*").alias("n"), F.max("id").alias("largest"))
            .filter(F.col("n") >= least_docs))


def _parts(counted: DataFrame, shards: int) -> dict[int, int]:
    """Parts of the shards that repeated keys send over twice the mean of probes.

    Other keys are even over the shards. ``counted`` has the shard and the count ``n`` of
    each repeated key, so no probe is counted again.
    """
    sums = {r["shard"]: r["n"] for r in counted.groupBy("shard").agg(
        F.sum("n").alias("n")).collect()}
    share = max(1, 2 * sum(sums.values()) // shards)
    return {s: PARTS * -(-n // share) for s, n in sums.items() if n > share}


def _dropped(keys: DataFrame, repeated: DataFrame, shards: int) -> DataFrame:
    """Per document (id, h) the hashes of keys whose lines it loses, packed."""
    shard = lambda k: F.pmod(k, F.lit(shards)).cast("int")
    parts = _parts(repeated.select(shard(F.col("k")).alias("shard"), "n"), shards)
    of_shard = F.lit(PARTS)
    if parts:
        more = F.create_map(*[F.lit(v) for pair in parts.items() for v in pair])
        of_shard = F.coalesce(F.try_element_at(more, F.col("shard")), of_shard)
    arrays = repeated.withColumn("shard", shard(F.col("k"))).withColumn(
        "part", F.explode(F.sequence(F.lit(0), of_shard - 1)))
    index = arrays.select(
        "shard", "part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("id"),
        F.lit(0).cast("long").alias("h"), "k", "f", "n", "largest")
    # Keys that no other document holds cannot be told apart here; all are probed.
    probes = keys.select("id", "h", F.explode("keys").alias("key")).select(
        "id", "h", "key", shard(F.col("key.k")).alias("shard")).select(
        "shard", F.pmod(F.xxhash64("id", "h"), of_shard).cast("int").alias("part"),
        F.lit(1).alias("kind"), "id", "h", F.col("key.k").alias("k"), F.col("key.f").alias("f"),
        F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("largest"))
    total = shards * PARTS + sum(parts.values()) - PARTS * len(parts)
    dealt = index.unionByName(probes).repartition(total, "shard", "part")
    dealt = dealt.sortWithinPartitions("shard", "part", "kind")

    def probed(batches):
        at, built, shard_keys = None, None, []
        for batch in batches:
            shards_, parts, kinds, ids, hs, k, f, n, largest = (
                c.to_numpy(zero_copy_only=False) for c in batch.columns)
            where = shards_.astype(np.int64) << 32 | parts
            edges = np.flatnonzero((np.diff(where) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(where)]):
                if a == b:
                    continue
                if at != where[a]:
                    at, built, shard_keys = where[a], None, []
                if kinds[a] == 0:
                    shard_keys.append((k[a:b].view(np.uint64), f[a:b], n[a:b], largest[a:b]))
                    continue
                if not shard_keys:
                    continue
                if built is None:
                    built = Shard(*(np.concatenate(x) for x in zip(*shard_keys)))
                counts, last = built.probe(k[a:b].view(np.uint64), f[a:b])
                hit = (counts > 0) & (last != ids[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[a:b][hit]) for x in (ids, hs, k)], names=["id", "h", "k"])

    hits = dealt.mapInArrow(probed, "id long, h long, k long")
    return hits.groupBy("id", "h").agg(F.collect_set("k").alias("lost"))


def drop_repeated_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3,
                        id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows and columns, the text without lines that many documents hold.

    A line's key is the line without ASCII blanks at both ends and with A-Z in lower
    case. Keys of ``least_chars`` code points or more found in ``least_docs``
    documents or more lose all lines but those in the document with the largest id
    of them. Returns the columns of ``docs`` plus ``n_lines`` (before dropping) and
    ``n_dropped``, which replace columns of these names, however their case. A null text counts as one
    empty line and becomes the empty text. Each row is a document, also where ids
    repeat; a null id is smaller than all others. The key's hash has 128 bits.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    whole = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(LOWEST)).alias("id"),
        F.xxhash64(text).alias("h"), text.alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns
                   if c.lower() != text_column.lower()]).alias("rest"))
    keys = _keys(whole, least_chars)
    repeated = staged(repeated_keys(keys, least_docs), "repeated-lines")
    shards = 1 + repeated.count() // SHARD_KEYS
    wide = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTS)
    lost = _dropped(keys, repeated, wide)
    joined = whole.join(lost, ["id", "h"], "left")

    def cut(batches):
        for batch in batches:
            lines, drops, kept = [], [], []
            data, rows = flat(batch.column("text"))
            marks = batch.column("lost").to_pylist()
            for k, gone in enumerate(marks):
                raw = data[rows[k]:rows[k + 1]].tobytes()
                n = raw.count(b"\n") + 1
                lines.append(n)
                if gone:
                    gone, held = set(gone), raw.split(b"\n")
                    left = [x for x, m in zip(held, batch.column("marks")[k].values.to_pylist())
                            if m is None or m not in gone]
                    drops.append(n - len(left))
                    raw = b"\n".join(left)
                else:
                    drops.append(0)
                kept.append(raw)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest"), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(lines, pa.int64()), pa.array(drops, pa.int64())],
                names=["rest", "text", "n_lines", "n_dropped"])

    def line_key(line):
        key = F.btrim(line, F.lit(BLANKS))
        return F.when(F.length(key) >= least_chars, F.xxhash64(key))

    marks = F.when(F.col("lost").isNotNull(),
                   F.transform(F.split(lowered(F.col("text")), "\n"), line_key))
    ready = joined.select("rest", "text", "lost", marks.alias("marks"))
    schema = ready.schema["rest"].dataType.simpleString()
    out = ready.mapInArrow(cut, f"rest {schema}, text string, n_lines long, n_dropped long")
    order = [F.col("text").alias(c) if c.lower() == text_column.lower()
             else F.col("rest").getField(c).alias(c)
             for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    return out.select(*order, "n_lines", "n_dropped")
