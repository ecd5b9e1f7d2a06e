"""Chat formatting in budgeted windows, with a loss mask and a way back.

Turns are rendered by a template whose control strings are escaped inside roles and
texts, reversibly. Prefix sums of the turns' tokens choose spans of whole turns that
fit the budget; each later window repeats the system turn and as many last turns as
the history budget allows, with their targets masked. So each assistant text bears
loss in exactly one window.

Tokens are counted on the rendered turn, marks, role and escapes included, before the
shuffle, evenly over all tasks. Then a task reads
its conversations turn by turn in order and holds one window's turns, so a
conversation of any length is formatted, and read back, in bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagweave.llm.common import flat, sections, small_batches
from tagweave.llm.packing import _encoder

#: The template's marks: a turn opens with its role's mark and closes with CLOSE.
MARKS = {"system": "[SYS]", "user": "[INST]", "assistant": "[ASST]"}
NAME_OPEN, NAME_CLOSE, CLOSE = "[ROLE]", "[/ROLE]", "</s>"
_CONTROL = r"/?(?:s>|(?:SYS|INST|ASST|ROLE)\])"
_PLAIN = re.compile(rf"([<\[])(\\*)({_CONTROL})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_CONTROL})")
_TURN = re.compile(r"\[(?:(SYS|INST|ASST)\]|ROLE\](.*?)\[/ROLE\])(.*?)</s>", re.S)
_ROLE = {mark[1:-1]: role for role, mark in MARKS.items()}


@dataclass(frozen=True)
class Budget:
    """Tokens of a window, and those of them that repeated history may take."""

    window: int = 2048
    history: int = 512


def escape(text: str) -> str:
    """Texts without control strings; one backslash more after the first character."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text starts and ends in it."""
    head = MARKS.get(role) or NAME_OPEN + escape(role) + NAME_CLOSE
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse(window: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, start and end of the escaped text of each turn."""
    for m in _TURN.finditer(window):
        role = _ROLE[m[1]] if m[1] else unescape(m[2])
        yield role, unescape(m[3]), m.start(3), m.end(3)


WINDOWS = ("conv_id long, window long, text string, n_turns long, n_repeated long, "
           "n_tokens long, loss_starts array<long>, loss_ends array<long>")
_WINDOWS = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()),
    ("n_turns", pa.int64()), ("n_repeated", pa.int64()), ("n_tokens", pa.int64()),
    ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64()))])


class _Conversation:
    """Turns that wait for their window, and those that the next one repeats."""

    def __init__(self, conv_id, budget: Budget):
        self.conv_id, self.budget, self.n = conv_id, budget, 0
        self.system, self.history, self.waiting, self.held = None, [], [], 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        if self.n == 0 and not self.waiting and self.system is None and role == "system":
            self.system = (role, text, tokens)
        self.waiting.append((role, text, tokens))
        self.held += tokens
        while self.waiting and self.held > self._room():
            yield self.cut()

    def _room(self) -> int:
        return self.budget.window - sum(t for _, _, t in self._repeated())

    def _repeated(self) -> list:
        return ([self.system] if self.n and self.system else []) + self.history

    def cut(self) -> tuple:
        """The next window: the longest span of waiting turns that fits, at least one."""
        repeated = self._repeated()
        prefix = np.cumsum([t for _, _, t in self.waiting])
        fits = max(1, int(np.searchsorted(prefix, self._room(), "right")))
        span, self.waiting = self.waiting[:fits], self.waiting[fits:]
        self.held = sum(t for _, _, t in self.waiting)
        parts, starts, ends, at = [], [], [], 0
        for k, (role, text, _) in enumerate(repeated + span):
            shown, a, b = render(role, text)
            if k >= len(repeated) and role == "assistant":
                starts.append(at + a)
                ends.append(at + b)
            parts.append(shown)
            at += len(shown)
        row = (self.conv_id, self.n, "".join(parts), len(parts), len(repeated),
               sum(t for _, _, t in repeated + span), starts, ends)
        turns = [t for t in self.history + span if t is not self.system]
        last = np.cumsum([t for _, _, t in turns[::-1]])
        keep = int(np.searchsorted(last, self.budget.history, "right"))
        self.history = turns[len(turns) - keep:]
        self.n += 1
        return row


def format_windows(turns: DataFrame, tokenizer: str, budget: Budget = Budget()) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text), one row each, in order.

    A window holds the system turn (if the conversation begins with one), last turns
    of the window before as far as the history budget allows, and new turns, whole,
    as far as the budget allows; a turn that exceeds the budget by itself is alone
    with what is repeated. ``n_tokens`` sums the turns' tokens, which the window's own never
    exceed: a turn ends and begins with a mark. ``loss_starts`` and ``loss_ends`` bound, in code points,
    the texts that bear loss: those of new assistant turns. Null roles and texts are
    empty; a null conv_id is a conversation of its own; null turns come first, and
    turns of equal number in order of role and text. Other columns are ignored.
    Windows of a conversation lie in one partition, in order.
    """
    small_batches(turns.sparkSession)

    @F.arrow_udf("long")
    def count(roles: pa.Array, texts: pa.Array) -> pa.Array:
        shown = pa.array([render(role, text)[0] for role, text in zip(
            roles.to_pylist(), texts.to_pylist())], pa.string())
        data, rows = flat(shown)
        encode, found = _encoder(tokenizer), []
        for a, b in sections(rows):
            found += [len(x) // 4 for x in encode(data[rows[a]:rows[b]],
                                                  rows[a:b + 1] - rows[a])]
        return pa.array(found, pa.int64())

    named = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (named.withColumn("tokens", count("role", "text"))
               .repartition(parts, "conv_id")
               .sortWithinPartitions("conv_id", "turn", "role", "text")
               .select("conv_id", "role", "text", "tokens"))

    def formatted(batches):
        now, found = None, []
        for batch in batches:
            for conv_id, role, text, tokens in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None and now.waiting:
                        found.append(now.cut())
                    now = _Conversation(conv_id, budget)
                found += now.add(role, text, tokens)
            if found:
                yield _batch(found, _WINDOWS)
                found = []
        if now is not None and now.waiting:
            yield _batch([now.cut()], _WINDOWS)

    return ordered.mapInArrow(formatted, WINDOWS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


_READ = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("n_windows", pa.int64())])


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation, taken from the windows of ``format_windows`` alone.

    Number and SHA-256 of the turns (role, line feed, text, line feed) without those
    that windows repeat; code points and SHA-256 of all text under the loss mask;
    code points of all windows; number of windows.
    """

    def read(batches):
        now = None
        for batch in batches:
            done = []
            for conv_id, _, text, _, repeated, _, starts, ends in zip(
                    *(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv_id:
                    if now is not None:
                        done.append(_closed(now))
                    now = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                now[5] += len(text)
                now[6] += 1
                for k, (role, said, _, _) in enumerate(parse(text)):
                    if k >= repeated:
                        now[1] += 1
                        now[2].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, ends):
                    said = unescape(text[a:b])
                    now[3] += len(said)
                    now[4].update(said.encode())
            if done:
                yield _batch(done, _READ)
        if now is not None:
            yield _batch([_closed(now)], _READ)

    return windows.mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
              "loss_sha256 string, formatted_chars long, n_windows long")


def _closed(now: list) -> tuple:
    return (now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5], now[6])
