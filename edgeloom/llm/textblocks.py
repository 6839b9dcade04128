"""Texts of an Arrow batch as byte arrays, cut into words and hashed with numpy.

A batch is worked on in blocks of whole rows, so memory follows the block size
or the longest single text, never the batch.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

BLOCK_BYTES = 2**18
# Bytes of the batches in which Spark hands rows to Python, by default 64 MB.
BATCH_BYTES = 2**22
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Inverse of the base modulo 2**64; multiplying by it undoes one power.
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def give_back() -> None:
    """Return freed memory to the system: a worker stays when its task ends, beside those of others."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run):
    """A map over Arrow batches that gives freed memory back now and then, and at its end."""

    @functools.wraps(run)
    def wrapped(batches):
        for n, batch in enumerate(run(batches), 1):
            yield batch
            if n % 8 == 0:
                give_back()
        give_back()

    return wrapped


def short_batches(spark: SparkSession) -> None:
    """From now on Python tasks of the session get batches of ``BATCH_BYTES``, or of one longer row.

    Executor and worker hold several batches of each task. A size that the session sets stays.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    z = values ^ (values >> np.uint64(30))
    z = z * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _byte_values() -> np.ndarray:
    """One 64-bit value per byte; A-Z have those of a-z."""
    byte = np.arange(256, dtype=np.uint64)
    upper = (byte >= 65) & (byte <= 90)
    return mix((np.where(upper, byte + np.uint64(32), byte) + np.uint64(1)) * _BASE)


BYTE_VALUES = _byte_values()
_powers = {}


def _power(kind: str, base: np.uint64, n: int) -> np.ndarray:
    known = _powers.get(kind)
    if known is None or len(known) < n:
        size = 1 << max(n, BLOCK_BYTES + 2).bit_length()
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = _powers[kind] = np.multiply.accumulate(known)
    return known[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values one after the other, and len + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``most`` bytes, or one longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(rows, max(first + 1, end))
        yield first, last
        first = last


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of True; no run crosses a row's end."""
    n = len(inside)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes, A-Z and a-z alike."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _power("up", _BASE, len(data)), out=sums[1:])
    moved = (sums[ends] - sums[starts]) * _power("down", _INVERSE, len(data) + 1)[starts]
    return mix(moved ^ (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ``size`` consecutive words of one row, and the first word's index."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.full(n, size, np.uint64)
    factor = _BASE
    with np.errstate(over="ignore"):
        for k in range(size):
            total += hashes[k : k + n] * factor
            factor = factor * _BASE
    first = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mix(total[first]), first
