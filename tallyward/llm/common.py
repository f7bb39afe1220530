"""What the text operators share: flat byte buffers, word hashes, bounded broadcasts."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but these six bytes.
SPACES = b" \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Text bytes that a task works on at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 21
#: Rows of ids that may be broadcast (8 bytes each); above it the join shuffles.
BROADCAST_ROWS = 2_000_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
_powers: dict[int, np.ndarray] = {}


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_broadcast(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a frame of thin rows whose counted size is within the bound."""
    return F.broadcast(df) if rows <= bound else df


def text_batches(spark, rows: int = 2000) -> None:
    """Arrow batches of at most ``rows`` rows in this session: the default of 10,000 texts is too much for a task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def _release() -> None:
    """Hand freed memory back to the system: an idle worker counts against its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: nothing to trim
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The batch function, giving memory back after every few results and at its end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, out in enumerate(run(batches)):
            yield out
            if k % 8 == 7:
                _release()
        _release()

    return wrapped


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit of 64-bit integers."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per process and grown by doubling."""
    have = _powers.get(base, np.ones(1, np.uint64))
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    if len(have) <= 4 * SLICE_BYTES:
        _powers[base] = have
    return have[:n]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row starts) of a binary Arrow column; null is empty."""
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    offsets = offsets.astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def words(data: np.ndarray, starts: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the rows in order, and the first word of each row (n + 1 entries)."""
    rows = len(starts) - 1
    sizes = np.diff(starts)
    text = np.full(len(data) + rows + 1, 32, np.uint8)
    text[np.arange(1, len(data) + 1) + np.repeat(np.arange(rows), sizes)] = _LOWER[data] if lower else data
    space = _SPACE[text]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    begin, end = edge[0::2], edge[1::2]
    total = np.empty(len(text) + 1, np.uint64)
    total[0] = 0
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * powers(len(text), _BASE), out=total[1:])
    h = (total[end] - total[begin]) * powers(len(text), _INVERSE)[begin]
    h = mix(h + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first = np.searchsorted(begin, starts + np.arange(rows + 1) + 1)
    return h, first


def shingles(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``width`` words of each row and the row limits.

    A row with fewer words has one shingle of all its words, a row without words none.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    limits = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n, out=limits[1:])
    at = np.repeat(first[:-1] - limits[:-1], n) + np.arange(limits[-1])
    padded = np.concatenate([h, np.zeros(width, np.uint64)])
    out = np.zeros(limits[-1], np.uint64)
    left = np.repeat(np.minimum(counts, width), n)
    for k in range(width):
        part = padded[at + k]
        part[left <= k] = 0
        out = mix(out * np.uint64(0x9DDFEA08EB382D69) + part)
    return mix(out + left.astype(np.uint64)), limits


def distinct_sorted(values: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row and the new row limits."""
    parts = [np.unique(values[a:b]) for a, b in zip(limits[:-1], limits[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), out
