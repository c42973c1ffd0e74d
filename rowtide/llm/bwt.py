"""Repeated strings of a collection by merging Burrows-Wheeler transforms of its shards.

A shard's transform lists, for its suffixes in sorted order, the bytes before each.
Shards are merged by refining their interleave, the sequence that says which shard
each place of the merged order comes from: sorted by the bytes before, stably, an
interleave that is right for the first h bytes of all suffixes becomes right for h + g
bytes, g being the bytes that one symbol of the transform holds. So suffixes of
different shards are never compared or sorted again. Places whose suffixes begin to
differ in a step part their interval there; what still shares an interval when ``depth`` is
reached has a common prefix of ``depth`` bytes or more, which is a repeated interval.

Shards are read as circles, so every suffix has bytes before it; callers ignore what
runs over the end of a text.
"""

from __future__ import annotations

import numpy as np


def _dense(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, rank of each key)."""
    order = np.argsort(keys)
    ahead = keys[order]
    step = np.zeros(len(keys), np.int64)
    step[1:] = ahead[1:] != ahead[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(step)
    return order, rank


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the circular suffixes, sorted by their first ``depth`` bytes (8 or more)."""
    n = len(text)
    keys = np.zeros(n, np.uint64)
    for i in range(8):
        keys = (keys << np.uint64(8)) | np.roll(text, -i)
    order = np.argsort(keys)
    rank, parted = _heads(order, keys[order], n)
    have = 8
    while have < depth:
        places = np.flatnonzero(~parted)  # of suffixes that still share a rank; the others stay where they are
        if not len(places):
            break
        step = min(have, depth - have)
        own = order[places]
        keys = rank[own] * n + rank[(own + step) % n]
        by = np.argsort(keys)
        own, keys = own[by], keys[by]
        order[places] = own
        new = np.ones(len(own), bool)
        np.not_equal(keys[1:], keys[:-1], out=new[1:])
        rank[own] = np.maximum.accumulate(np.where(new, places, 0))
        parted[places] = new & np.append(new[1:], True)
        have += step
    return order


def _heads(order: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(the rank of each suffix, which is the first place of its key; places whose key has no other); ``keys`` are sorted."""
    new = np.ones(n, bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return rank, new & np.append(new[1:], True)


_WIDE = {8: np.uint64, 4: np.uint32, 2: np.uint16}


def _before(shards: list[np.ndarray], orders: list[np.ndarray], held: int) -> np.ndarray:
    """The transforms end to end, a symbol being the ``held`` bytes before a suffix."""
    parts = []
    for text, order in zip(shards, orders, strict=True):
        before = np.zeros(len(text), _WIDE[held])
        for i in range(held, 0, -1):
            before = (before << _WIDE[held](8)) | np.roll(text, i)
        parts.append(before[order])
    return np.concatenate(parts)


def _steps(shards: list[np.ndarray], orders: list[np.ndarray], depth: int) -> list[np.ndarray]:
    """Transforms whose symbols add up to ``depth`` bytes, as few as fit into 16 bits.

    Symbols are numbered in the order of their bytes; up to 2**16 different ones fit.
    Two bytes fit as they are.
    """
    for held in (8, 4):
        rank = _dense(_before(shards, orders, held))[1]
        if rank.max(initial=0) < 1 << 16:
            rest = [_before(shards, orders, 2)] * (depth % held // 2)
            return [rank.astype(np.uint16)] * (depth // held) + rest
    return [_before(shards, orders, 2)] * (depth // 2)


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, start, interval) of all suffixes in the merged order.

    Suffixes have the same interval if and only if their first ``depth`` bytes are
    equal. ``depth`` is even.
    """
    shards = [s for s in shards if len(s)]
    orders = [suffix_order(s, depth) for s in shards]
    steps = _steps(shards, orders, depth)
    sizes = [len(s) for s in shards]
    base = np.concatenate([[0], np.cumsum(sizes)])
    shard = np.repeat(np.arange(len(shards), dtype=np.uint8 if len(shards) < 256 else np.int32), sizes)
    place = np.arange(base[-1], dtype=np.int32)  # of the merged order's entries in the transforms
    interval = np.zeros(base[-1], np.int32)
    entries = np.arange(base[-1], dtype=np.int32)
    for symbols in steps:
        now = symbols[place]
        order = np.argsort(now, kind="stable")
        now, interval, shard = now[order], interval[order], shard[order]
        new = np.zeros(len(now), bool)
        np.not_equal(now[1:], now[:-1], out=new[1:])
        new[1:] |= interval[1:] != interval[:-1]
        interval = np.cumsum(new, dtype=np.int32)
        place[np.argsort(shard, kind="stable")] = entries  # each shard's entries keep its own order
    return shard, np.concatenate(orders)[place], interval
