"""Language-model scores by prediction by partial matching over bytes.

The model predicts each byte of a text, and its end, from the bytes before it. Its
trie of contexts is held as sorted arrays of grams (context and next symbol) with
the counts of the training texts, one level for each order. A symbol that a context
has not seen costs that context's escape (seen symbols against occurrences), and the
next shorter context is asked, without the symbols that the longer one had seen; at
last come the symbols that no text had. The model is pretrained: counts are those
of all training texts, for every scored text alike.

1. One pass counts pairs of symbols; with at most 257 x 257 of them they go to the driver.
2. Documents are dealt to buckets of bounded size. A bucket sends its distinct grams
   and words, with their training counts, to shards: grams by their two nearest
   context symbols, words by hash. A shard thus holds every count that its grams
   ask for but those of pairs.
3. A shard adds up the counts, computes each gram's code length and each word's
   count, and answers each bucket in the order of what it sent. Each bucket hears of
   every shard, and so learns the number of distinct words too.
4. Buckets add up the answers over their documents.

Neither the trie nor the vocabulary is ever whole in one place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagweave.llm.common import (
    LOWER, SPACE, flat, mixed, packed, sections, small_batches, span_hashes, unpacked,
    word_bounds)

#: Context symbols of the longest contexts.
ORDER = 5
#: The symbol after a text, also taken as context before it; symbols in all.
END, SYMBOLS = 256, 257
BITS = 9
#: Bytes of text in a bucket; buckets that one more shard is opened for.
BUCKET_BYTES, BUCKETS_PER_SHARD = 8 << 20, 2
LOWEST = -(1 << 63)


def symbols(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray,
                                                         np.ndarray]:
    """Texts as symbols: lower-case words with one blank between them, then the end.

    Returns symbols with ORDER ends after each text, the positions that are
    predicted, the number of them per text, and the hashes of words with the first
    word of each text, as one array of hashes and one of bounds.
    """
    data = LOWER[data]
    starts, ends, first = word_bounds(data, rows)
    keep = ~SPACE[data]
    later = np.ones(len(starts), bool)
    later[first[:-1][first[:-1] < first[1:]]] = False
    blanks = starts[later] - 1
    keep[blanks] = True
    data[blanks] = 32
    sizes = np.concatenate([[0], np.cumsum(keep)])[rows]
    sizes = np.diff(sizes)
    n = len(sizes)
    begin = np.concatenate([[0], np.cumsum(sizes + ORDER)])
    out = np.full(ORDER + begin[-1], END, np.uint64)
    text = np.arange(sizes.sum()) + np.repeat(begin[:-1] - np.concatenate(
        [[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if n else begin[:-1], sizes)
    out[ORDER + text] = data[keep]
    predicted = np.arange((sizes + 1).sum()) + np.repeat(
        begin[:-1] - np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        if n else begin[:-1], sizes + 1)
    return out, ORDER + predicted, sizes + 1, (span_hashes(data, starts, ends), first)


def grams(stream: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each position its symbol in the low bits and ``order`` symbols before it above."""
    keys = stream.copy()
    for j in range(1, order + 1):
        keys[j:] |= stream[:-j] << np.uint64(BITS * j)
    return keys


class _Level:
    """Distinct grams of one order with their counts, and sums by context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        context = keys >> np.uint64(BITS)
        new = np.concatenate([[True], context[1:] != context[:-1]]) if len(keys) else np.zeros(0, bool)
        self.context = np.cumsum(new) - 1
        self.contexts = context[new]
        n = len(self.contexts)
        self.total = np.bincount(self.context, counts, n)
        self.kinds = np.bincount(self.context, counts > 0, n).astype(np.int64)


def code_lengths(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int = ORDER
                 ) -> np.ndarray:
    """log10 probability of the last symbol of each gram.

    ``keys`` are distinct and sorted and hold all grams of each of their nearest two
    context symbols; ``pairs[a, b]`` counts symbol b after a in all training texts.
    """
    levels = {order: _Level(keys, counts)}
    for j in range(order - 1, 1, -1):
        mask = np.uint64((1 << BITS * (j + 1)) - 1)
        short, place = np.unique(levels[j + 1].keys & mask, return_inverse=True)
        levels[j] = _Level(short, np.bincount(place, levels[j + 1].counts > 0, len(short)))
    near = np.flatnonzero(pairs.ravel())
    last = [(np.uint64(k // SYMBOLS) << np.uint64(BITS)) | np.uint64(k % SYMBOLS) for k in near]
    mask = np.uint64((1 << 2 * BITS) - 1)
    asked = np.unique(np.concatenate([np.array(last, np.uint64),
                                      np.unique(levels[2].keys & mask)]))
    levels[1] = _Level(asked, pairs[(asked >> np.uint64(BITS)).astype(int),
                                    (asked & np.uint64(511)).astype(int)].astype(float))
    single = pairs.sum(axis=0)
    shown = np.unique(np.concatenate([np.flatnonzero(single).astype(np.uint64),
                                      asked & np.uint64(511)]))
    levels[0] = _Level(shown, single[shown.astype(int)].astype(float))
    found = np.zeros(len(keys))
    open_ = np.ones(len(keys), bool)
    at = np.arange(len(keys))
    above = None
    for j in range(order, -1, -1):
        level = levels[j]
        if above is not None:
            mask = np.uint64((1 << BITS * (j + 1)) - 1)
            low = np.searchsorted(level.keys, above.keys & mask)
            at = low[at]
            seen = above.counts > 0
            gone = np.bincount(above.context, level.counts[low] * seen, len(above.contexts))
            of = level.context[low]
            by_context = np.zeros(len(above.contexts), np.int64)
            by_context[above.context] = of
            total = (level.total[by_context] - gone)[upper]
            kinds = (level.kinds[by_context] - above.kinds)[upper]
        else:
            total, kinds = level.total[level.context], level.kinds[level.context]
        hit = open_ & (level.counts[at] > 0)
        found[hit] += np.log10((2 * level.counts[at][hit] - 1) / (2 * total[hit]))
        open_ &= ~hit
        miss = open_ & (total > 0)
        found[miss] += np.log10(kinds[miss] / (2 * total[miss]))
        above, upper = level, level.context[at]
    found[open_] -= np.log10(max(1, SYMBOLS - int((single > 0).sum())))
    return found


def _pair_counts(docs: DataFrame) -> tuple[np.ndarray, int, int]:
    """Counts of symbol pairs and of tokens in training texts, and bytes of all texts."""

    def passes(batches):
        for batch in batches:
            found = np.zeros(SYMBOLS * SYMBOLS + 2, np.int64)
            learn = batch.column(1).to_numpy(zero_copy_only=False)
            data, rows = flat(batch.column(0))
            found[-1] = len(data)
            for a, b in sections(rows):
                stream, at, sizes, (words, first) = symbols(
                    data[rows[a]:rows[b]], rows[a:b + 1] - rows[a])
                at = at[np.repeat(learn[a:b], sizes)]
                pairs = stream[at - 1] * np.uint64(SYMBOLS) + stream[at]
                found[:-2] += np.bincount(pairs.astype(np.int64), minlength=SYMBOLS * SYMBOLS)
                found[-2] += (np.diff(first) + 1)[learn[a:b]].sum()
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])],
                                             names=["pair", "n"])

    table = docs.select("text", "learn").mapInArrow(passes, "pair long, n long")
    counts = np.zeros(SYMBOLS * SYMBOLS + 2, np.int64)
    for r in table.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # of bounded size
        counts[r["pair"]] = r["n"]
    return counts[:-2].reshape(SYMBOLS, SYMBOLS), int(counts[-2]), int(counts[-1])


class _Bucket:
    """Distinct grams and words of a bucket's texts, in a fixed order by shard."""

    def __init__(self, table: pa.Table, shards: int):
        self.learn = table.column("learn").to_numpy()
        stream, at, self.sizes, (words, self.first) = symbols(*flat(table.column("text")))
        codes, keys = pd.factorize(grams(stream)[at])
        del stream, at
        near = mixed((keys >> np.uint64(BITS)) & np.uint64((1 << 2 * BITS) - 1))
        self.grams = self._by_shard(codes, keys, near, self.sizes, shards)
        codes, keys = pd.factorize(words)
        self.words = self._by_shard(codes, keys, keys, np.diff(self.first), shards)

    def _by_shard(self, codes, keys, by, sizes, shards):
        shard = (by % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((keys, shard))
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        codes = place[codes]
        learned = np.bincount(codes, np.repeat(self.learn, sizes), len(keys)).astype("<u4")
        return codes, keys[order], learned, np.searchsorted(shard[order], np.arange(shards + 1))


_SENT = "shard int, bucket int, grams binary, gram_counts binary, words binary, word_counts binary"
_SENT_SCHEMA = pa.schema([("shard", pa.int32()), ("bucket", pa.int32()), *[
    (c, pa.binary()) for c in ("grams", "gram_counts", "words", "word_counts")]])


def score_texts(docs: DataFrame, training: Column, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """Per row: doc_id, learn, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` says which rows the model learns from; every row is scored. Tokens
    are words in lower case (A-Z), then one end. ``base_score`` is the sum of log10
    of (count + 1) / (train_tokens + distinct training tokens + 1), ``score`` the
    model's log10 probability of the words with one blank between them, and the end.
    A null text is empty and scored as its end. Rows that repeat an id are scored
    each; a null ``training`` counts as false. Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    given = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                        F.coalesce(training, F.lit(False)).alias("learn"), text.alias("text"))
    pairs, tokens, size = _pair_counts(given)
    buckets = 1 + size // BUCKET_BYTES
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 1 + buckets // BUCKETS_PER_SHARD)
    dealt = given.withColumn("bucket", F.pmod(
        F.xxhash64("doc_id", "text"), F.lit(buckets)).cast("int"))

    def send(table: pa.Table) -> pa.Table:
        held = _Bucket(table, shards)
        bucket = table.column("bucket")[0].as_py()
        rows = []
        for s in range(shards):
            row = [s, bucket]
            for _, keys, learned, bounds in (held.grams, held.words):
                row += [packed(x[bounds[s]:bounds[s + 1]]) for x in (keys, learned)]
            rows.append(row)
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), _SENT_SCHEMA.types)],
                        schema=_SENT_SCHEMA)

    def answer(table: pa.Table) -> pa.Table:
        replies, distinct = {}, 0
        for name in ("grams", "words"):
            keys = [unpacked(x, "<u8") for x in table.column(name).to_pylist()]
            learned = [unpacked(x, "<u4") for x in table.column(f"{name[:-1]}_counts").to_pylist()]
            bounds = np.cumsum([0, *map(len, keys)])
            own, place = np.unique(np.concatenate(keys), return_inverse=True)
            counts = np.bincount(place, np.concatenate(learned), len(own))
            if name == "grams":
                result = code_lengths(own, counts, pairs).astype("<f4") if len(own) else np.zeros(
                    0, "<f4")
            else:
                result, distinct = counts.astype("<u4"), int((counts > 0).sum())
            replies[name] = [packed(result[place[a:b]]) for a, b in zip(bounds, bounds[1:])]
        return pa.table({
            "bucket": table.column("bucket"), "shard": table.column("shard"),
            "lengths": pa.array(replies["grams"], pa.binary()),
            "known": pa.array(replies["words"], pa.binary()),
            "distinct": pa.array([distinct] * table.num_rows, pa.int64())})

    answers = dealt.groupBy("bucket").applyInArrow(send, _SENT).groupBy("shard").applyInArrow(
        answer, "bucket int, shard int, lengths binary, known binary, distinct long")
    ended = int(pairs[:, END].sum())

    def collect(table: pa.Table, replies: pa.Table) -> pa.Table:
        held = _Bucket(table, shards)
        replies = replies.sort_by("shard")
        smooth = tokens + sum(replies.column("distinct").to_pylist()) + (tokens > 0) + 1
        lengths = np.concatenate([unpacked(x, "<f4") for x in
                                  replies.column("lengths").to_pylist()]).astype(float)
        known = np.concatenate([unpacked(x, "<u4") for x in
                                replies.column("known").to_pylist()]).astype(float)
        rows = np.arange(len(held.sizes))
        score = np.bincount(np.repeat(rows, held.sizes), lengths[held.grams[0]], len(rows))
        n_words = np.diff(held.first)
        of = np.repeat(rows, n_words)
        counts = known[held.words[0]]
        base = np.bincount(of, np.log10((counts + 1) / smooth), len(rows)) + np.log10(
            (ended + 1) / smooth)
        return pa.table({
            "doc_id": table.column("doc_id"), "learn": table.column("learn"),
            "n_tokens": pa.array((n_words + 1).astype(np.int64)),
            "n_known": pa.array((np.bincount(of, counts > 0, len(rows))
                                 + (ended > 0)).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(rows), tokens, np.int64)),
            "base_score": pa.array(base), "score": pa.array(score)})

    return dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
        collect, "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, "
                 "base_score double, score double")
