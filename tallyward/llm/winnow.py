"""Content-anchored positions of byte texts, as vector work on Arrow batches.

Every window of ``length`` bytes holds at least one anchor, and equal windows
hold theirs at the same place: the anchor is the smallest hashed ``GRAM``-byte
gram of the window (all of them in a tie), which depends on the window alone.
"""

from __future__ import annotations

import numpy as np

GRAM = 24
SLICE = 1 << 20
_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xC2B2AE3D27D4EB4F)
_M3 = np.uint64(0x165667B19E3779F9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= _M2
    h ^= h >> np.uint64(32)
    return h


def _words(buf: bytes | memoryview, n: int) -> np.ndarray:
    """The eight bytes from each position on, as one integer each."""
    return np.ndarray((n,), "<u8", buf, strides=(1,))


def gram_hashes(buf: bytes, n: int) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` bytes from each of the first ``n`` positions."""
    w = _words(buf, n + GRAM - 8)
    h = w[:n] * _M1
    h ^= h >> np.uint64(31)
    h += w[8 : n + 8]
    h *= _M2
    h ^= h >> np.uint64(30)
    h += w[16 : n + 16]
    h *= _M3
    h ^= h >> np.uint64(32)
    return h


def _sliding(op: np.ufunc, x: np.ndarray, width: int, fill) -> np.ndarray:
    """op over x[i : i + width] for every full window, two accumulations per block."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, fill, dtype=x.dtype)
    padded[:n] = x
    grid = padded.reshape(blocks, width)
    ahead = op.accumulate(grid, axis=1).reshape(-1)
    behind = op.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return op(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(buf: bytes, n: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions and gram hashes of ``buf[:n]``; 8 spare bytes must follow."""
    grams = n - GRAM + 1
    width = length - GRAM + 1
    if n < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    h = gram_hashes(buf, grams)
    least = _sliding(np.minimum, h, width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    padded[width - 1 : width - 1 + len(least)] = least
    at = np.flatnonzero(_sliding(np.maximum, padded, width, np.uint64(0)) == h)
    return at, h[at]


def span_hashes(buf: bytes, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of buf[start:end] for each pair; 8 spare bytes must follow the text."""
    words = _words(buf, len(buf) - 7)
    size = ends - starts
    h = (size.astype(np.uint64) + np.uint64(seed)) * _M1
    for k in range(0, int(size.max(initial=0)), 8):
        left = np.clip(size - k, 0, 8).astype(np.uint64)
        live = left > 0
        at = np.where(live, starts + k, 0)
        w = words[at]
        short = left < 8
        w[short] &= (np.uint64(1) << (left[short] * np.uint64(8))) - np.uint64(1)
        h = np.where(live, _mixed((h ^ w) * _M3 + np.uint64(k)), h)
    return _mixed(h)
