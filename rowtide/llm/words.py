"""Hashed word shingles of whole texts, computed for a batch of texts at once."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP, _ROOT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


# A random number per byte; letters A-Z share those of a-z.
_LETTER = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_LETTER[65:91] = _LETTER[97:123]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the root and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_ROOT), -1, 1 << 64))
    up, down = np.full(n + 1, _ROOT), np.full(n + 1, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(1 << 16)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of each word, its 64-bit hash) in a buffer of bytes; spaces part words."""
    global _UP, _DOWN
    if len(_UP) <= len(raw) + 1:
        _UP, _DOWN = _powers(2 * len(raw) + 1)
    space = _SPACE[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    run = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_LETTER[raw] * _UP[: len(raw)], out=run[1:])
    return starts, mixed((run[ends] - run[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes: (all hashes, n per text).

    A text of fewer than ``size`` words has its whole sequence as one shingle, a text
    without words none. Letters A-Z count as a-z.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    begins = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=begins[1:])
    starts, words = word_hashes(joined)
    first = np.searchsorted(starts, begins)  # first word of each text
    out, counts = [], np.zeros(len(raw), np.int64)
    n = len(words)
    rolled = words.copy()
    for step in range(1, size if n >= size else 1):
        rolled[: n - step] = mixed(rolled[: n - step] * _STEP + words[step:])
    for i in range(len(raw)):
        a, b = first[i], first[i + 1]
        if b - a >= size:
            own = np.unique(rolled[a : b - size + 1])
        elif b > a:
            value = words[a : a + 1]
            for w in words[a + 1 : b]:
                value = mixed(value * _STEP + w)
            own = value + np.uint64(b - a)  # a sequence shorter than a shingle is like no shingle
        else:
            own = words[:0]
        out.append(own)
        counts[i] = len(own)
    return (np.concatenate(out) if out else words[:0]), counts
