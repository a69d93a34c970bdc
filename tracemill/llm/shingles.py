"""Distinct word shingles of a text as 64-bit numbers, with numpy.

Words are runs of anything but the blanks 0x20 and 0x09-0x0D, with A-Z in lower
case. A shingle is five consecutive words; a text with fewer words is one
shingle of all of them. Numbers are a rolling polynomial over the bytes, so two
different shingles get the same number with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np

WIDTH = 5
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20260101).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) >= n:
            return
        size = max(n, 2 * len(cls.up), 1 << 14)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            setattr(cls, name, np.multiply.accumulate(steps))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _HALF)) * _MIX
    x = (x ^ (x >> _HALF)) * _MIX
    return x ^ (x >> _HALF)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle numbers (int64 order) of a whole text; none for null or blank texts."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.int64)
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    _Powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _Powers.up[: len(data)], out=sums[1:])
    ends = np.flatnonzero(data == 32)
    starts = np.empty_like(ends)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    span = min(width, len(words))
    first, last = starts[: len(starts) - span + 1], ends[span - 1:]
    # The length goes in too: a shorter run of words never equals a longer one.
    numbers = mix((sums[last] - sums[first]) * _Powers.down[first] + (last - first).astype(np.uint64))
    return np.unique(numbers.view(np.int64))


def set_key(numbers: np.ndarray) -> int:
    """One number for a whole set: equal sets, equal keys."""
    length = np.full(1, len(numbers), np.uint64)
    total = mix(numbers.view(np.uint64) + length).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + length * _MIX).view(np.int64)[0])
