"""Packing token sequences by vector bin packing.

An example asks for three things at once: tokens, one segment, and loss-bearing
tokens. A sequence offers a limit of each. The open sequence takes, again and
again, the example with the largest dot product of what it asks for and what the
sequence has left, each dimension weighted by its mean demand. If examples may be
cut, the largest one is cut to fill what is left.

The work is one pass without a shuffle: each task packs its rows in buffers of a
bounded number of examples and tokens, and takes the rows of its last, unfilled
sequence along to its next buffer. Only a task's very last sequence has padding.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import LOWER, flat, sections, small_batches, span_hashes, word_bounds

#: Examples and tokens that a task holds before it packs them.
BUFFER_ROWS, BUFFER_TOKENS = 2048, 8_000_000
#: Words whose ids a worker remembers.
REMEMBERED = 1_000_000
#: What parts words before the tokenizer sees them: a subset of its white space.
_BLANK = np.zeros(256, bool)
_BLANK[[10, 32]] = True


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss: int = 4096


def fill(tokens, loss, limits: Limits, may_cut: bool) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, first token, number of tokens).

    Examples without tokens are left out. One that exceeds a limit by itself gets
    a sequence of its own when it may not be cut. When it may, all its tokens must
    bear loss.
    """
    tokens, loss = np.array(tokens, np.int64), np.array(loss, np.int64)
    live = np.flatnonzero(tokens > 0)
    place, tokens, loss = live, tokens[live], loss[live]
    start = np.zeros(len(live), np.int64)
    most = np.array([limits.tokens, limits.segments, limits.loss], float)
    full = []
    if may_cut:
        size = min(limits.tokens, limits.loss)
        for k in np.flatnonzero(tokens >= size):
            cuts = int(tokens[k] // size)
            full += [[(int(place[k]), i * size, size)] for i in range(cuts)]
            start[k], tokens[k], loss[k] = cuts * size, tokens[k] % size, loss[k] % size
    alive = tokens > 0
    if not alive.any():
        return full
    weight = np.array([tokens[alive].mean(), 1, loss[alive].mean()]) / most**2
    bins, left = [], int(alive.sum())
    while left:
        if len(alive) > 64 and left < len(alive) // 2:
            place, tokens, loss, start = (x[alive] for x in (place, tokens, loss, start))
            alive = np.ones(left, bool)
        room, held = most.copy(), []
        while left and room[1] >= 1:
            fits = alive & (tokens <= room[0]) & (loss <= room[2])
            w = weight * room
            gain = np.where(fits, tokens * w[0] + loss * w[2] + w[1], -1.0)
            k = int(gain.argmax())
            size = int(tokens[k])
            if gain[k] < 0:
                if may_cut:
                    size = int(min(room[0], room[2]))
                    k = int(np.where(alive, tokens, -1).argmax())
                elif not held:
                    k = int(np.where(alive, tokens, -1).argmax())
                    size = int(tokens[k])
                else:
                    break
                if not size:
                    break
            held.append((int(place[k]), int(start[k]), size))
            lost = int(loss[k]) if size == tokens[k] else size
            room -= (size, 1, lost)
            start[k] += size
            tokens[k] -= size
            loss[k] -= lost
            if not tokens[k]:
                alive[k] = False
                left -= 1
        bins.append(held)
    return full + bins


class _Encoder:
    """Ids of whole texts, word by word between blanks, remembering words' ids.

    Words are told apart by a 64-bit hash. A-Z count as lower case and a full stop or
    comma after a last ASCII letter as a word of its own, as the tokenizer sees them;
    texts that may hold its special tokens are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content.encode() for t in
                   self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(special) if special else None
        self._forget()

    def _forget(self):
        self.place = pd.Index(np.zeros(0, np.uint64))
        self.ids, self.bounds = np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _learn(self, data, hashes, starts, ends):
        """Encode new words, many at once, and remember them."""
        if len(self.place) + len(hashes) > REMEMBERED:
            self._forget()
        ids, sizes = [], []
        for at in range(0, len(starts), 200):
            words = [data[a:b].tobytes().decode("utf-8") for a, b in
                     zip(starts[at:at + 200], ends[at:at + 200])]
            found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            first = np.cumsum([0, *(len(w) + 1 for w in words[:-1])])
            at_word = np.searchsorted(first, [x for x, _ in found.offsets], "right") - 1
            ids.append(np.array(found.ids, "<u4"))
            sizes.append(np.bincount(at_word.astype(np.int64), minlength=len(words)))
        self.place = self.place.append(pd.Index(hashes))
        self.ids = np.concatenate([self.ids, *ids])
        self.bounds = np.concatenate(
            [self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(sizes))])

    def __call__(self, data: np.ndarray, rows: np.ndarray) -> list[bytes]:
        """The ids of each row as little-endian 32-bit numbers."""
        raw, data = data, LOWER[data]
        starts, ends, _ = word_bounds(data, rows, _BLANK)
        long = ends - starts > 1
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        cut = long & ((last == 44) | (last == 46)) & (before >= 97) & (before <= 122)
        starts = np.concatenate([starts, ends[cut] - 1])
        ends = np.concatenate([ends - cut, ends[cut]])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        first = np.searchsorted(starts, rows)
        codes, hashes = pd.factorize(span_hashes(data, starts, ends))
        place = self.place.get_indexer(hashes)
        new = place < 0
        if new.any():
            seen = np.zeros(len(hashes), np.int64)
            seen[codes[::-1]] = np.arange(len(codes))[::-1]
            if len(self.place) + new.sum() > REMEMBERED:
                new[:] = True
            self._learn(data, hashes[new], starts[seen[new]], ends[seen[new]])
            place = self.place.get_indexer(hashes)
        place = place[codes]
        sizes = self.bounds[place + 1] - self.bounds[place]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.bounds[place] - stops[:-1], sizes)
                       + np.arange(stops[-1])]
        found = [ids[stops[a]:stops[b]].tobytes() for a, b in zip(first, first[1:])]
        if self.mark is not None and self.mark in data.tobytes():
            for k, (a, b) in enumerate(zip(rows, rows[1:])):
                if self.mark in data[a:b].tobytes():
                    text = raw[a:b].tobytes().decode("utf-8")
                    found[k] = np.array(self.tokenizer.encode(
                        text, add_special_tokens=False).ids, "<u4").tobytes()
        return found


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """One for each worker process, so that tasks after the first find words known."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")
_OUT = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                  ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                  ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _piece_batches(bins, rows, first: int) -> Iterator[pa.RecordBatch]:
    """One row for each piece; a batch holds few enough ids to stay small."""
    for at in range(0, len(bins), 256):
        found = [(rows[k][0], start, size, rows[k][1][4 * start:4 * (start + size)],
                  len(rows[k][1]) // 4, first + at + i, offset)
                 for i, held in enumerate(bins[at:at + 256])
                 for (k, start, size), offset in zip(held, np.cumsum(
                     [0, *(size for _, _, size in held)]).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found), _OUT.types)], schema=_OUT)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, limits: Limits = Limits(),
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Whole documents as pieces of sequences; every id lies in exactly one piece.

    A document's ids are those of the tokenizer file ``tokenizer`` without special
    tokens, then ``end_id``; a null or empty text is ``end_id`` alone. ``ids`` holds
    a piece's ids as little-endian unsigned 32-bit numbers. Sequence ids are unique
    and differ between tasks; offsets have no gaps. Rows that repeat an id are
    packed as documents of their own. No rows give no rows; other columns are
    ignored.
    """
    small_batches(docs.sparkSession)
    tail = np.array([end_id], "<u4").tobytes()

    def packed(batches):
        encode = _encoder(tokenizer)
        sequence = TaskContext.get().partitionId() << 33
        rows, kept, held = [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            data, bounds = flat(batch.column(1))
            for a, b in sections(bounds):
                span = bounds[a:b + 1]
                ids_of = encode(data[span[0]:span[-1]], span - span[0])
                for name, ids in zip(names[a:b], ids_of):
                    rows.append((name, ids + tail))
                    kept.append((0, len(ids) // 4 + 1))
                    held += len(ids) // 4 + 1
                if len(rows) < BUFFER_ROWS and held < BUFFER_TOKENS:
                    continue
                bins = _with_starts(fill(*([[n for _, n in kept]] * 2), limits, True), kept)
                last = bins.pop()
                yield from _piece_batches(bins, rows, sequence)
                sequence += len(bins)
                rows, kept = ([rows[k] for k, _, _ in last], [(s, n) for _, s, n in last])
                held = sum(n for _, n in kept)
        if rows:
            bins = _with_starts(fill(*([[n for _, n in kept]] * 2), limits, True), kept)
            yield from _piece_batches(bins, rows, sequence)

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                         F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(packed, PIECES)


def _with_starts(bins, kept):
    """Pieces of what is left of documents, as pieces of the documents."""
    return [[(k, kept[k][0] + start, size) for k, start, size in held] for held in bins]


def pack_examples(examples: DataFrame, limits: Limits, id_column: str = "id",
                  tokens_column: str = "tokens", loss_column: str = "loss_tokens"
                  ) -> DataFrame:
    """Whole instruction examples, given their token and loss counts, as sequences.

    Returns id, tokens, loss_tokens, sequence_id and offset, one row for each
    example with tokens (a null count is 0). Examples are never cut; one beyond a
    limit is alone in its sequence.
    """
    small_batches(examples.sparkSession)

    def packed(batches):
        sequence = TaskContext.get().partitionId() << 33
        rows = []

        def emit(bins):
            found = [(*rows[k], sequence + i, offset) for i, held in enumerate(bins)
                     for (k, _, _), offset in zip(held, np.cumsum(
                         [0, *(size for _, _, size in held)]).tolist())]
            columns = list(zip(*found)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=["id", "tokens", "loss_tokens", "sequence_id", "offset"])

        for batch in batches:
            kind = batch.column(0).type
            rows += zip(*(c.to_pylist() for c in batch.columns))
            if len(rows) >= BUFFER_ROWS:
                bins = fill([r[1] for r in rows], [r[2] for r in rows], limits, False)
                last = bins.pop() if bins else []
                yield emit(bins)
                sequence += len(bins)
                rows = [rows[k] for k, _, _ in last]
        if rows:
            yield emit(fill([r[1] for r in rows], [r[2] for r in rows], limits, False))

    count = lambda name: F.coalesce(F.col(name).cast("long"), F.lit(0))
    chosen = examples.select(F.col(id_column).alias("id"), count(tokens_column).alias("tokens"),
                             count(loss_column).alias("loss_tokens"))
    kind = chosen.schema["id"].dataType.simpleString()
    return chosen.mapInArrow(
        packed, f"id {kind}, tokens long, loss_tokens long, sequence_id long, offset long")
