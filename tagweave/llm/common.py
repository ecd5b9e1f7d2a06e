"""Helpers shared by the operators: Arrow text columns, word bounds, hashes, staging.

A document's words and spans are found with whole-column numpy operations on the
UTF-8 bytes of an Arrow batch; positions are byte positions in that buffer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, SparkSession, functions as F

from tagweave.operators.staging import find_package, stage as staged  # noqa: F401

#: Rows and bytes of one Arrow batch, so that a task holds few long texts at once.
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20
#: Bytes hashed at a time.
SLICE = 1 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(0, 1 << 64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def small_batches(spark: SparkSession) -> None:
    """Bound what Arrow hands to Python at once; a single longer row comes alone.

    Also lets Python workers find this package where the driver found it.
    """
    find_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null is the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row bounds; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("", pa.string()).cast(column.type))
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bounds = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + len(column) + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def sections(rows: np.ndarray, size: int = 2 << 20):
    """Ranges of rows with about ``size`` bytes; a longer row is alone."""
    a = 0
    while a < len(rows) - 1:
        b = max(a + 1, int(np.searchsorted(rows, rows[a] + size, "right")) - 1)
        yield a, b
        a = b


def word_bounds(data: np.ndarray, rows: np.ndarray, gap: np.ndarray = SPACE
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each row (with the end)."""
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, SLICE)
            inverse = pow(_BASE, -1, 1 << 64)
            steps = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
            for step in steps:
                step[0] = 1
                np.multiply.accumulate(step, out=step)
            cls.up, cls.down = steps
        return cls.up, cls.down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; starts ascending, equal bytes hash alike."""
    found = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(starts, base + SLICE)))
        end = int(ends[first:last].max())
        up, down = _Powers.to(end - base)
        sums = np.zeros(end - base + 1, np.uint64)
        np.cumsum(_BYTE[data[base:end]] * up[:end - base], out=sums[1:])
        begin, stop = starts[first:last] - base, ends[first:last] - base
        found[first:last] = (sums[stop] - sums[begin]) * down[begin]
        first = last
    return mixed(found ^ (ends - starts).astype(np.uint64))


def prefix_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """``span_hashes`` of the ``size`` bytes from each place on."""
    found = np.empty(max(len(data) - size + 1, 0), np.uint64)
    for a in range(0, len(found), SLICE):
        held, part = found[a:a + SLICE], data[a:a + SLICE + size - 1]
        up, down = _Powers.to(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * up[:len(part)], out=sums[1:])
        np.subtract(sums[size:], sums[:-size], out=held)
        held *= down[:len(held)]
    found ^= np.uint64(size)
    return mixed(found)


def pair_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of each two neighbouring words."""
    return mixed(words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:])


def packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed; neighbours share their high bytes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return _ZIP.compress(planes.tobytes())


def unpacked(held: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(_UNZIP.decompress(held, max_output_size=1 << 31), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
