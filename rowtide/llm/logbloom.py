"""Log-frequency Bloom filter: quantised counts of 64-bit keys, read back by repeated probes.

A count is quantised to a level; level j starts at ``floors(base)[j]``, which grows by the
factor ``base`` and, at the low end, by one, so small counts are exact. A key of level q
enters the filter as the q events (key, 1) .. (key, q). A key's level is read by
probing (key, 1), (key, 2), .. until an event is missing: it is never too low, and too
high by one step with the filter's error rate, by two with its square, and so on.

An event sets its bits within one word of 64, so a probe reads one word. The filter comes in shards
by the first bits of the key, each with its own words, sized by its events; within a shard, 32 further
bits tell keys apart.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from rowtide.llm.words import mixed

_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_PART = 1 << 19  # events that are hashed at a time


def floors(base: float) -> np.ndarray:
    """Least count of each level; level 0 is a count of 0."""
    out = [0, 1]
    while out[-1] < 1 << 62:
        out.append(max(out[-1] + 1, int(out[-1] * base)))
    return np.array(out[: 1 << 8], np.int64)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def within_shard(keys: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits that follow those of the shard."""
    return ((keys << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _event(rest: np.ndarray, level: int) -> np.ndarray:
    return mixed(rest.astype(np.uint64) + np.array([level], np.uint64) * _STEP)


def _word(h: np.ndarray, words: np.ndarray | int) -> np.ndarray:
    """The word of each event, out of so many."""
    return (((h & _LOW) * np.asarray(words, np.uint64)) >> np.uint64(32)).astype(np.int64)


def _bits(h: np.ndarray, hashes: int):
    """The bits of each event in its word, one array for each hash function."""
    for i in range(hashes):
        if i and i % 5 == 0:
            h = mixed(h + _STEP)
        yield (h >> np.uint64(34 + 6 * (i % 5))) & np.uint64(63)


def filled(rest: np.ndarray, counts: np.ndarray, base: float, bits_per_event: int, hashes: int) -> bytes:
    """The words of one shard, from its keys (32 bits each) and their counts."""
    level = np.searchsorted(floors(base), counts, side="right") - 1
    words = max(1, -(-int(level.sum()) * bits_per_event // 64))
    if words >= 1 << 32:
        raise ValueError("a shard holds too many events; use more shards")
    table = np.zeros(64 * words, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        rest, level = rest[level >= j], level[level >= j]
        for start in range(0, len(rest), _PART):
            h = _event(rest[start : start + _PART], j)
            first = _word(h, words) << 6
            for bit in _bits(h, hashes):
                table[first + bit.astype(np.int64)] = True
    return np.packbits(table, bitorder="little").tobytes()


@dataclass
class Filter:
    """Shards side by side: all words, and where each shard's begin (one more than shards)."""

    words: np.ndarray
    begins: np.ndarray
    shard_bits: int
    hashes: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each 64-bit key."""
        shard = shard_of(keys, self.shard_bits)
        return self.levels_in(within_shard(keys, self.shard_bits), shard)

    def levels_in(self, rest: np.ndarray, shard: np.ndarray | int) -> np.ndarray:
        """Levels of keys of 32 bits in their shards, or all in one."""
        out = np.zeros(len(rest), np.uint8)
        alone = not isinstance(shard, np.ndarray)
        for start in range(0, len(rest), _PART):
            part = slice(start, start + _PART)
            at = shard if alone else shard[part]
            out[part] = self._probed(rest[part], self.begins[at], self.begins[at + 1] - self.begins[at])
        return out

    def _probed(self, rest: np.ndarray, begin: np.ndarray | int, size: np.ndarray | int) -> np.ndarray:
        """``begin`` and ``size`` (words) of each key's shard, or of the one of all."""
        out = np.zeros(len(rest), np.uint8)
        alive = np.flatnonzero(np.broadcast_to(size > 0, rest.shape))
        for j in range(1, 256):
            if not len(alive):
                break
            h = _event(rest[alive], j)
            own, at = (size, begin) if np.ndim(size) == 0 else (size[alive], begin[alive])
            mask = np.zeros(len(alive), np.uint64)
            for bit in _bits(h, self.hashes):
                mask |= np.uint64(1) << bit
            alive = alive[self.words[at + _word(h, own)] & mask == mask]
            out[alive] = j
        return out


def joined(shards: list[tuple[int, bytes]], shard_bits: int, hashes: int) -> Filter:
    """One filter from (shard, words); a shard that is missing holds nothing."""
    sizes = np.zeros((1 << shard_bits) + 1, np.int64)
    for shard, words in shards:
        sizes[shard + 1] = len(words) // 8
    words = b"".join(words for _, words in sorted(shards))
    return Filter(np.frombuffer(words, "<u8"), np.cumsum(sizes), shard_bits, hashes)
