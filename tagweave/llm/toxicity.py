"""Toxicity by compression distance.

Zstandard dictionaries are made of ordinary text and of what is peculiar to toxic
text, one of its common pieces and one of the rare ones. A window of a document is
compressed after the ordinary dictionary alone, after the common pieces put before it, and
after the rare ones put before both; the bytes saved say how much of the window resembles
toxic text. Windows overlap, so that each word lies in one whose end is far enough for a
match. The largest saving of a window, the sum of the savings, no stretch counted twice,
and their mean go through a logistic calibration that is fitted on the labelled rows. Rare
pieces have features of their own, so that chance finds don't weaken the common ones.

Only the fit reads labels, on a bounded sample. Scoring is one pass over whole
texts, window by window.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tagweave.llm.common import flat, small_batches, staged

#: Labelled documents of each class that the fit may use, chosen by a hash of the id.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 4000, 8000
#: Windows of ordinary text that its dictionary is trained on, one of every so many bytes.
ORDINARY_WINDOWS, STRETCH = 20_000, 1024
#: zstd finds hardly any match in the last TAIL bytes of a window: a step leaves room for
#: them and for the longest word with the blanks around it.
WINDOW, STEP, TAIL, LEVEL = 64, 28, 8, 9
ORDINARY_BYTES, TOXIC_BYTES = 16_384, 16_384  # of each of the toxic dictionaries
#: Words and pairs of words are peculiar to toxic text that occur in so many toxic
#: documents of the sample, in a share of them so many times that of ordinary ones, and
#: by chance alone exp(LEAST_EVIDENCE) times less likely. The strongest are used.
LEAST_SUPPORT, LEAST_ODDS, LEAST_EVIDENCE = 3, 20, 8
#: Share of the toxic sample from which a piece is common; bytes a window must save by
#: rare ones.
COMMON_SHARE, LEAST_SAVED = 0.05, 3
TOXIC_PIECES, LONGEST_WORD = 1000, 24
#: Bytes of the parts of a word longer than LONGEST_WORD, as in scripts without blanks.
PARTS = 6, 9, 12, 24
#: Copies of a text with fewer words than this count one by one.
FEW_WORDS = 10
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; without dictionaries every score is ``base``."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    base: float
    rare: bytes = b""


def _compressor(dictionary: bytes):
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False,
        write_dict_id=False).compress


class _Savings:
    """Features of texts: largest saving, log of the sum, mean over all windows.

    First by common pieces, then by rare ones beyond them.
    """

    def __init__(self, model: Model):
        self.plain = _compressor(model.ordinary)
        self.common = _compressor(model.toxic + model.ordinary) if model.toxic else None
        self.all = (_compressor(model.rare + model.toxic + model.ordinary) if model.rare
                    else None)

    def __call__(self, text: bytes) -> tuple[float, ...]:
        if not text:
            return (0.0,) * 6
        text = b" " + text + b" " * TAIL
        common, rare = [], []
        for at in range(0, max(1, len(text) - TAIL), STEP):
            window = text[at:at + WINDOW]
            size = len(self.plain(window))
            less = min(size, len(self.common(window))) if self.common else size
            common.append(size - less)
            saved = less - len(self.all(window)) if self.all else 0
            rare.append(saved if saved >= LEAST_SAVED else 0)
        return _features(common) + _features(rare)


def _features(savings: list[int]) -> tuple[float, float, float]:
    taken = passed = 0  # best sums of windows that aren't neighbours: with the last one, without
    for saved in savings:
        taken, passed = passed + saved, max(taken, passed)
    total = max(taken, passed)
    return float(max(savings)), float(np.log1p(total)), total / len(savings)


def _logistic(features: np.ndarray, weights) -> np.ndarray:
    z = weights[0] + features @ np.asarray(weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _calibrate(features: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Weights of a logistic model by Newton steps, with a small ridge."""
    x = np.column_stack([np.ones(len(features)), features])
    weights = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * features.shape[1])
    for _ in range(50):
        p = _logistic(features, weights)
        slope = x.T @ (toxic - p) - ridge @ weights
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge
        step = np.linalg.solve(bend, slope)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(w) for w in weights)


def _trained(size: int, samples: list[bytes], shortest: bytes) -> bytes:
    """Content of a trained dictionary, or the samples themselves if they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()[-size:]
    except (zstandard.ZstdError, ValueError):
        return shortest[-size:]


def _pieces(text: bytes, key: int) -> dict[bytes, int]:
    """Words, pairs of neighbours and parts of long words, each with its least context.

    The context is a hash of the words on both sides; copies of a text have the same
    least one. A text of few words has its ``key`` as the only context.
    """
    words = WORD.findall(text)
    few = len(words) < FEW_WORDS
    hashes = [0, *map(zlib.crc32, words), 0, 0]
    found: dict[bytes, int] = {}

    def add(piece, context):
        context = key if few else context
        if context < found.get(piece, context + 1):
            found[piece] = context

    for k, word in enumerate(words):
        before, after, later = hashes[k], hashes[k + 2], hashes[k + 3]
        if len(word) <= LONGEST_WORD:
            add(word, _mixed(before, after))
            if k + 1 < len(words) and len(words[k + 1]) <= LONGEST_WORD:
                add(word + b" " + words[k + 1], _mixed(before, later))
            continue
        for size in PARTS:
            for i in range(len(word) - size + 1):
                if word[i] & 0xC0 != 0x80 and (i + size == len(word)
                                               or word[i + size] & 0xC0 != 0x80):
                    add(word[i:i + size], _mixed(
                        zlib.crc32(word[max(0, i - 6):i]) if i else before,
                        zlib.crc32(word[i + size:i + size + 6]) if i + size < len(word)
                        else after))
    return found


def _windows(text: bytes) -> list[bytes]:
    """A window of every STRETCH bytes, at a place chosen by a hash of them."""
    found = []
    for i in range(0, len(text), STRETCH):
        part = text[i:i + STRETCH]
        places = max(1, len(text[i:i + STRETCH + WINDOW]) - WINDOW + 1)
        at = i + zlib.crc32(part) % min(places, STRETCH)
        found.append(text[at:at + WINDOW])
    return found


def _mixed(a: int, b: int) -> int:
    return (a * 0x9E3779B1 + b * 0x85EBCA77) & 0x7FFFFFFF


def _chosen(rows: list[bytes]) -> list[bytes]:
    """The strongest pieces; none that merely adds a word to a chosen one."""
    kept: dict[bytes, None] = {}
    for piece in rows:
        words = piece.split(b" ")
        if len(kept) < TOXIC_PIECES and (len(words) == 1 or not any(w in kept for w in words)):
            kept[piece] = None
    return list(kept)


def _joined(pieces: list[bytes]) -> bytes:
    """The pieces with blanks around them, the strongest last."""
    return b" ".join([b"", *reversed(pieces), b""])[-TOXIC_BYTES:] if pieces else b""


def sample_of(labels: DataFrame, training: Column, id_column: str, label_column: str
              ) -> DataFrame:
    """A bounded number of labelled ids of each class, the same at every run."""
    usable = labels.filter(training & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), F.col(label_column).alias("toxic")).distinct()
    parts = [usable.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
             for y, n in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE))]
    return parts[0].unionByName(parts[1])


def fit(docs: DataFrame, labels: DataFrame, training: Column, id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "toxic") -> Model:
    """Fit on labelled documents for which ``training`` (over labels) holds.

    Uses at most TOXIC_SAMPLE and ORDINARY_SAMPLE documents. Null labels and ids are
    left out; a document with both labels is a sample of both. Without one of the
    classes, every document scores their share.
    """
    small_batches(docs.sparkSession)
    chosen = F.broadcast(sample_of(labels, training, id_column, label_column))  # bounded
    # Four jobs read the sample, which is small beside the documents it is taken from.
    sample = staged(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string")
                                .alias("text")).join(chosen, "doc_id").select(
        "text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("key")),
        "labelled-sample")

    def pieces(batches):
        for batch in batches:
            data, rows = flat(batch.column(0))
            found, ordinary = [], Counter()
            keys = batch.column(2).to_pylist()
            for k, toxic in enumerate(batch.column(1).to_pylist()):
                text = data[rows[k]:rows[k + 1]].tobytes().lower()
                if toxic:
                    found += [(p, c, 0) for p, c in _pieces(text, keys[k]).items()]
                else:
                    ordinary.update(_pieces(text, keys[k]).keys())
            found += [(p, None, n) for p, n in ordinary.items()]
            columns = list(zip(*found)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int64())], names=["piece", "context", "elsewhere"])

    def ordinary_windows(batches):
        for batch in batches:
            data, rows = flat(batch.column(0))
            found = [w for k in range(len(rows) - 1)
                     for w in _windows(data[rows[k]:rows[k + 1]].tobytes().lower())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["piece"])

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n"))
             .collect()}
    n_toxic, n_ordinary = sizes.get(1, 0), sizes.get(0, 0)
    base = n_toxic / max(1, n_toxic + n_ordinary)
    if not n_toxic or not n_ordinary:
        return Model(b"", b"", (), base)
    counted = sample.mapInArrow(pieces, "piece binary, context long, elsewhere long").groupBy(
        "piece", "context").agg(F.sum("elsewhere").alias("elsewhere")).groupBy("piece").agg(
        F.count("context").alias("seen"), F.sum("elsewhere").alias("elsewhere"))
    seen, elsewhere = F.col("seen"), F.col("elsewhere")
    both = (seen + elsewhere) / (n_toxic + n_ordinary)
    evidence = (seen * F.log(seen / n_toxic / both)
                + F.when(elsewhere > 0, elsewhere * F.log(elsewhere / n_ordinary / both))
                .otherwise(0))
    strongest = counted.filter(
        (seen >= LEAST_SUPPORT) & (seen * n_ordinary >= elsewhere * (LEAST_ODDS * n_toxic))
        & (evidence >= LEAST_EVIDENCE)).orderBy(evidence.desc(), F.length("piece"), "piece")
    found = {bytes(r["piece"]): r["seen"]
             for r in strongest.limit(20 * TOXIC_PIECES).collect()}
    peculiar = _chosen(list(found))
    if not peculiar:
        return Model(b"", b"", (), base)
    plain = [bytes(r["piece"]) for r in sample.filter("toxic = 0").mapInArrow(
        ordinary_windows, "piece binary").orderBy(F.xxhash64("piece"), "piece")
        .limit(ORDINARY_WINDOWS).collect()]
    often = max(LEAST_SUPPORT, COMMON_SHARE * n_toxic)
    common, rare = (_joined([p for p in peculiar if (found[p] >= often) == c])
                    for c in (True, False))
    model = Model(_trained(ORDINARY_BYTES, [w for w in plain if len(w) > 8], b"".join(plain)),
                  common, (), base, rare)

    def features(batches):
        savings = _Savings(model)
        for batch in batches:
            data, rows = flat(batch.column(0))
            found = [savings(data[rows[k]:rows[k + 1]].tobytes().lower())
                     for k in range(len(rows) - 1)]
            columns = np.array(found, float).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c) for c in columns], batch.column(1)],
                names=["a", "b", "c", "d", "e", "f", "toxic"])

    rows = sample.mapInArrow(features, "a double, b double, c double, d double, e double, "
                             "f double, toxic int").collect()
    table = np.array([tuple(r) for r in rows], float)
    return replace(model, weights=_calibrate(table[:, :6], table[:, 6]))


def score(docs: DataFrame, model: Model, text_column: str = "text",
          score_column: str = "score") -> DataFrame:
    """All rows and columns of ``docs`` with a score from 0 to 1 over the whole text.

    A null or empty text has no savings and gets the lowest score. A column that
    already bears the name of the score is replaced.
    """
    if not model.weights:
        return docs.withColumn(score_column, F.lit(float(model.base)))
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        savings = _kept(model)
        data, rows = flat(texts)
        found = np.array([savings(data[rows[k]:rows[k + 1]].tobytes().lower())
                          for k in range(len(rows) - 1)], float).reshape(-1, 6)
        return pa.array(_logistic(found, model.weights))

    return docs.withColumn(score_column, toxicity(F.col(text_column).cast("string")))


_HELD: dict[Model, _Savings] = {}


def _kept(model: Model) -> _Savings:
    """One pair of compressors for a worker process."""
    if model not in _HELD:
        _HELD.clear()
        _HELD[model] = _Savings(model)
    return _HELD[model]
