"""Words and their 64-bit hashes, a text at a time in numpy.

A word is a run of bytes other than ASCII white space. Hashes are polynomials modulo 2**64
over the bytes of a word (or over the hashes of several words), taken from prefix sums, so a
text costs a few passes over its bytes and no Python code per word.
"""

from __future__ import annotations

import functools

import numpy as np

BLOCK = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit numbers; one to one."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE) | np.uint64(1)


@functools.lru_cache(maxsize=2)
def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(
            np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b))])
            for b in (_BASE, inverse)
        )


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _power_table(1 << max(16, (n + 1).bit_length()))
    return up[: n + 1], down[: n + 1]


def bounds(data: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~space[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each word; a word longer than a block is hashed from pieces."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, low + BLOCK, side="right")))
        part = data[low : int(ends[to - 1])]
        if len(part) > BLOCK:
            pieces = [_spans(p, np.zeros(1, int), np.full(1, len(p))) for p in
                      (part[i : i + BLOCK] for i in range(0, len(part), BLOCK))]
            joined = np.concatenate(pieces)
            out[at] = grams(joined, len(joined))[0]
        else:
            out[at:to] = _spans(part, starts[at:to] - low, ends[at:to] - low)
        at = to
    return out


def _spans(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(part))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUES[part] * up[: len(part)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts])


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n consecutive words; empty if there are fewer."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    up, down = _powers(len(words))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        return mix((sums[n:] - sums[:-n]) * down[: len(words) - n + 1])


def as_bytes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", np.uint8)


def covered(starts: np.ndarray, length: int | np.ndarray, size: int) -> np.ndarray:
    """Marks what lies in [start, start + length) of any start."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + length, -1)
    return np.cumsum(steps[:-1]) > 0


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
