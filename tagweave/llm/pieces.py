"""Encoding and decoding with a SentencePiece model of the merge (BPE) kind.

A text's symbols are its characters. An agenda holds all neighbouring symbols whose
concatenation is a piece; the one with the highest score is merged first, of equal ones
the leftmost, and the new neighbours join the agenda. Characters without a piece
become byte pieces.

No piece of the usual vocabularies has a space behind another character, so no merge
crosses such a place: a text falls into segments that are encoded apart. In an Arrow
batch each distinct segment is encoded once, all short ones side by side: a round takes
the head of every segment's agenda. Segments of more than ``SHORT`` symbols have a heap
each. A vocabulary with such pieces is read from the model and then texts stay whole.

What a batch encodes is compared with the sentencepiece library's ids for the same
segments; a difference raises. Nothing crosses the network.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagweave.llm.common import flat, sections, small_batches, span_hashes

#: Symbols of a segment up to which segments are encoded side by side.
SHORT = 48
#: Bytes of one Arrow batch: the larger, the fewer segments are met again.
BATCH_BYTES = 6 << 20
#: Bytes of segments that the library checks at a time, ids that it decodes.
CHECKED, DECODED = 1 << 16, 1 << 18
MARK = "▁"
#: The rank of no merge; a place within a segment fits below it.
_NEVER = np.int64(1) << 50


class Vocabulary:
    """The pieces of a model as a table of merges: (left, right) to rank and piece.

    Symbols are piece ids; a character without a piece is its code point beyond ``size``.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = p = SentencePieceProcessor(model_file=path)
        self.size = size = p.get_piece_size()
        known = [i for i in range(size)
                 if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        if any(p.is_unused(i) for i in known) or not p.is_byte(p.piece_to_id("<0x41>")):
            raise ValueError(f"{path} has unused pieces or no byte pieces")
        # Escaped, prefixed and otherwise unchanged.
        if p.normalize("  a AéⅧ  ") != f"{MARK * 3}a{MARK}AéⅧ{MARK * 2}":
            raise ValueError(f"{path} rewrites texts")
        self.bytes = np.array([p.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        spelled = {p.id_to_piece(i).replace(MARK, " "): i for i in known}
        self.apart = not any(a != " " and b == " " for s in spelled for a, b in zip(s, s[1:]))
        chars = {ord(s): i for s, i in spelled.items() if len(s) == 1}
        self.chars = np.arange(0x110000, dtype=np.int64) + size
        self.chars[list(chars)] = list(chars.values())
        symbol = lambda s: spelled.get(s, ord(s) + size if len(s) == 1 else None)
        # Equal scores have one rank: the leftmost goes first then.
        scores = sorted({p.get_score(i) for i in known}, reverse=True)
        rank = {score: k for k, score in enumerate(scores)}
        merges = {}
        for s, i in spelled.items():
            for cut in range(1, len(s)):
                left, right = symbol(s[:cut]), symbol(s[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = (rank[p.get_score(i)], i)
        self.merges = merges
        # The same by open addressing for whole columns of pairs; the last slot stays free.
        bits = max(8, (4 * len(merges)).bit_length())
        self.shift, self.free = np.uint64(64 - bits), 1 << bits
        self.keys = np.full(self.free + 1, -1, np.int64)
        self.ranks = np.full(self.free + 1, _NEVER)
        self.made = np.full(self.free + 1, -1, np.int64)
        places = self._slots(np.array([*merges], np.int64)).tolist()
        for (key, (order, piece)), at in zip(merges.items(), places):
            while self.keys[at] >= 0:
                at = (at + 1) % self.free
            self.keys[at], self.ranks[at], self.made[at] = key, order, piece

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slots of pairs in the table of merges; ``free`` where they do not merge."""
        wanted = left << 32 | right
        at = self._slots(wanted)
        held = self.keys[at]
        open_ = np.flatnonzero(held != wanted)
        while len(open_):
            end = held[open_] < 0
            at[open_[end]] = self.free
            open_ = open_[~end]
            at[open_] = (at[open_] + 1) % self.free
            held[open_] = self.keys[at[open_]]
            open_ = open_[held[open_] != wanted[open_]]
        return at


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """The model at ``path``, read once by each worker."""
    return Vocabulary(path)


def encode_long(held: Vocabulary, symbols: list[int]) -> list[int]:
    """One segment by a heap of (rank, place of the left symbol, both symbols)."""
    symbols, n = list(symbols), len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    agenda = []

    def add(a: int, b: int) -> None:
        if a >= 0 and b < n:
            found = held.merges.get(symbols[a] << 32 | symbols[b])
            if found:
                heapq.heappush(agenda, (found[0], a, b, symbols[a], symbols[b], found[1]))

    for a in range(n - 1):
        add(a, a + 1)
    while agenda:
        _, a, b, x, y, made = heapq.heappop(agenda)
        if symbols[a] != x or b != right[a] or symbols[b] != y:
            continue  # one of them was merged meanwhile
        symbols[a], symbols[b] = made, -1
        right[a] = right[b]
        if right[a] < n:
            left[right[a]] = a
        add(left[a], a)
        add(a, right[a])
    return [s for s in symbols if s >= 0]


def encode_short(held: Vocabulary, symbols: np.ndarray, counts: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Segments side by side: all symbols left, and how many each segment has."""
    whose = np.repeat(np.arange(len(counts)), counts)
    # The agenda: what each symbol makes with the next one of its segment.
    with_next = np.full(len(symbols), held.free)
    same = np.flatnonzero(whose[:-1] == whose[1:])
    with_next[same] = held.pairs(symbols[same], symbols[same + 1])
    ended = []
    while len(symbols):
        begins = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1]])
        sizes = np.diff(np.r_[begins, len(symbols)])
        place = np.arange(len(symbols)) - np.repeat(begins, sizes)
        heads = np.minimum.reduceat(held.ranks[with_next] << 8 | place, begins)
        open_ = heads >> 8 < _NEVER
        stay = np.repeat(open_, sizes)
        if not open_.all():
            ended.append((whose[~stay], symbols[~stay]))
        at = begins[open_] + (heads[open_] & 255)
        symbols[at] = held.made[with_next[at]]
        stay[at + 1] = False
        changed = np.zeros(len(symbols), bool)
        changed[at] = True
        before = at[at > 0] - 1
        changed[before] = True  # of another segment: found unchanged below
        symbols, whose, with_next, changed = (
            x[stay] for x in (symbols, whose, with_next, changed))
        new = np.flatnonzero(changed)
        with_next[new] = held.free
        new = new[new + 1 < len(symbols)]
        new = new[whose[new] == whose[new + 1]]
        with_next[new] = held.pairs(symbols[new], symbols[new + 1])
    if not ended:
        return symbols, np.zeros(len(counts), np.int64)
    whose, symbols = (np.concatenate(x) for x in zip(*ended))
    order = np.argsort(whose, kind="stable")
    return symbols[order], np.bincount(whose, minlength=len(counts))


def encode_segments(held: Vocabulary, data: bytes, counts: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of segments, whose UTF-8 lies end to end, and the number of each.

    ``counts`` has the characters of each segment; none is empty.
    """
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    symbols = held.chars[points]
    long = counts > SHORT
    of_long = np.repeat(long, counts)
    left, sizes = encode_short(held, symbols[~of_long], counts[~long])
    if long.any():
        begins = np.cumsum(counts) - counts
        done = [np.array(encode_long(held, symbols[begins[k]:begins[k] + counts[k]].tolist()))
                for k in np.flatnonzero(long).tolist()]
        short, sizes = left, _spread(long, np.array([len(x) for x in done]), sizes)
        left = _spread(np.repeat(long, sizes), np.concatenate(done), short)
    unknown = left >= held.size
    if not unknown.any():
        return left.astype(np.int32), sizes
    spelled = (left[unknown] - held.size).astype(np.uint32).tobytes().decode("utf-32-le").encode()
    code = left[unknown] - held.size
    wide = np.ones(len(left), np.int64)
    wide[unknown] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
    ids = np.repeat(left, wide)
    ids[np.repeat(unknown, wide)] = held.bytes[np.frombuffer(spelled, np.uint8)]
    ends = np.cumsum(wide)
    last = np.cumsum(sizes)
    total = np.r_[0, ends[last - 1]] if len(sizes) else np.zeros(1, np.int64)
    return ids.astype(np.int32), np.diff(total)


def refuse_difference(held: Vocabulary, data: bytes, lengths: np.ndarray, ids: np.ndarray,
                      counts: np.ndarray) -> None:
    """Raise if the library encodes these segments otherwise.

    Segments stand end to end in texts of about ``CHECKED`` bytes; one of spaces only is
    the last of its text. The library puts a space in front of a text, which is the
    first segment's own.
    """
    ends, last = np.cumsum(lengths), np.cumsum(counts)
    blank = np.flatnonzero(np.frombuffer(data, np.uint8)[ends - 1] == 32) + 1
    a, texts, tokens = 0, [], []
    while a < len(lengths):
        begin = ends[a] - lengths[a]
        b = max(a + 1, int(np.searchsorted(ends, begin + CHECKED)))
        stop = np.searchsorted(blank, a, "right")
        b = min([b, *blank[stop:stop + 1].tolist()])
        texts.append(data[begin + 1:ends[b - 1]].decode())
        tokens.append(ids[last[a] - counts[a]:last[b - 1]])
        if not texts[-1]:  # one space, which ends a text
            texts[-1] = "a "
            tokens[-1] = np.r_[held.library.encode("a"), tokens[-1]].astype(np.int32)
        a = b
    for text, own, library in zip(texts, tokens, held.library.encode(texts, num_threads=1)):
        if not np.array_equal(own, np.array(library, np.int32)):
            raise ValueError(f"the library encodes otherwise: {text[:200]!r}")


def _spread(where: np.ndarray, inside: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """One column of two, by a condition on its rows."""
    whole = np.empty(len(where), np.int64)
    whole[where], whole[~where] = inside, outside
    return whole


def _taken(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans' values end to end."""
    ends = np.cumsum(lengths)
    kind = np.int32 if len(data) < 1 << 30 and len(ends) and ends[-1] < 1 << 30 else np.int64
    at = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    at += np.arange(len(at), dtype=kind)
    return data[at]


def encode_rows(held: Vocabulary, data: np.ndarray, rows: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of prefixed texts in one buffer, and the bounds of each text's ids."""
    if held.apart:
        # A segment begins with the spaces before its word; spaces at the end are one, too.
        first = np.zeros(len(data) + 1, bool)
        first[rows[:-1][np.diff(rows) > 0]] = True
        space = data == 32
        first[1:-1] |= space[1:] & ~space[:-1]
        starts = np.flatnonzero(first[:-1])
    else:
        starts = rows[:-1][np.diff(rows) > 0]
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(rows), np.int64)
    lengths = np.diff(np.r_[starts, len(data)])
    _, chosen, which = np.unique(span_hashes(data, starts, starts + lengths),
                                 return_index=True, return_inverse=True)
    if not (np.array_equal(lengths[chosen][which], lengths)
            and np.array_equal(_taken(data, starts[chosen][which], lengths), data)):
        chosen = which = np.arange(len(starts))  # different segments of one hash
    spans = _taken(data, starts[chosen], lengths[chosen])
    lead = np.r_[0, np.cumsum((spans & 0xC0) != 0x80)]
    ends = np.cumsum(lengths[chosen])
    counts = np.diff(lead[np.r_[0, ends]])
    ids, sizes = encode_segments(held, spans.tobytes(), counts)
    refuse_difference(held, spans.tobytes(), lengths[chosen], ids, sizes)
    begins = np.cumsum(sizes) - sizes
    bounds = np.r_[0, np.cumsum(sizes[which])]
    return (_taken(ids, begins[which], sizes[which]),
            bounds[np.searchsorted(starts, rows)])


def encode_texts(docs: DataFrame, model: str, text_column: str = "text", out: str = "ids",
                 keep: list[str] | None = None, decoded: str | None = None) -> DataFrame:
    """``docs`` with one more column, the token ids of each whole text.

    A null text counts as empty, an empty one has no ids; malformed UTF-8 becomes
    U+FFFD. No begin or end ids. The columns ``keep``, by default all, stay as they are, one
    named like ``out`` is replaced; an empty table stays empty. With ``decoded`` a column
    of that name has the text that the library makes of the ids.
    """
    text = F.make_valid_utf8(F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")))
    prefixed = F.when(F.length(text) > 0, F.concat(F.lit(" "), F.replace(
        text, F.lit(MARK), F.lit(" ")))).otherwise(F.lit(""))

    def made(given: pa.Array) -> list[pa.Array]:
        held = vocabulary(model)
        ids, bounds = encode_rows(held, *flat(given))
        found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
        return [found, _decoded(held, ids, bounds)] if decoded else [found]

    return _with_arrow(docs, prefixed, docs.columns if keep is None else keep,
                       {out: "array<int>"} | ({decoded: "string"} if decoded else {}), made)


def decode_texts(coded: DataFrame, model: str, ids_column: str = "ids",
                 out: str = "decoded") -> DataFrame:
    """``coded`` with one more column, the text that the library makes of the ids.

    Null ids give the empty text.
    """
    given = F.coalesce(F.col(f"`{ids_column}`").cast("array<int>"), F.array().cast("array<int>"))

    def made(given: pa.Array) -> list[pa.Array]:
        bounds = np.r_[0, np.cumsum(given.value_lengths().to_numpy())].astype(np.int64)
        return [_decoded(vocabulary(model), given.flatten().to_numpy(), bounds)]

    return _with_arrow(coded, given, coded.columns, {out: "string"}, made)


def _decoded(held: Vocabulary, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Texts of rows of ids, some rows at a time."""
    texts = []
    for a, b in sections(bounds, DECODED):
        rows = [ids[x:y].tolist() for x, y in zip(bounds[a:b], bounds[a + 1:b + 1])]
        texts.append(pa.array(held.library.decode(rows, num_threads=1), pa.string()))
    return pa.concat_arrays(texts) if texts else pa.array([], pa.string())


def _with_arrow(df: DataFrame, given: Column, keep: list[str], out: dict[str, str],
                made) -> DataFrame:
    """The columns ``keep`` and new ones that ``made`` gives for each batch of ``given``."""
    small_batches(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    others = [c for c in keep if c.lower() not in {name.lower() for name in out}]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    both = df.select(row.alias("row"), given.alias("given"))
    schema = both.schema.simpleString()[7:-1].rpartition(",given:")[0]
    names = [f"made{k}" for k in range(len(out))]

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *made(batch.column("given"))], names=["row", *names])

    done = both.mapInArrow(passes, ", ".join([schema, *[
        f"{name} {kind}" for name, kind in zip(names, out.values())]]))
    return done.select(*[F.col("row").getField(c).alias(c) for c in others],
                       *[F.col(name).alias(shown) for name, shown in zip(names, out)])
