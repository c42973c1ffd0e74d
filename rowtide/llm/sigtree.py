"""Signature trees over shingle sets, and the dual traversal that joins them.

A tree's leaves are sets; its nodes hold the OR of their children's token bitmaps,
the range of their sizes, and the least number of tokens that share a bit with
another token of the set (``spare``). Of two sets with bitmaps a and b, at most
popcount(a & b) + min(spare) tokens are common. The same formula over two nodes bounds
every pair below them, so a pair of nodes goes on only if that bound reaches the
overlap that their least sizes need, and if their size ranges can meet.

Links are wanted as components: a pair whose sets are already connected is passed
over, so a group of near copies costs about one verified pair per set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 8
_TURN = 2048  # node pairs that are taken down a level at once
_WORDS = 1 << 18  # of bitmaps that are compared at once


def _at_once(words: np.ndarray) -> int:
    """How many pairs of such bitmaps to compare at once."""
    return max(1, min(4096, _WORDS // words.shape[1]))


class Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.root[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        root = self.root
        while True:
            up = root[root]
            if (up == root).all():
                return root
            root = self.root = up


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether den * |a & b| >= num * |a | b| for sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or den * len(a) < num * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return den * common >= num * (len(a) + len(b) - common)


def bitmap(tokens: np.ndarray, bits: int) -> np.ndarray:
    """Words of a token bitmap; ``bits`` is a power of two of 64 or more."""
    has = np.zeros(bits, bool)
    has[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(has, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap at a smaller width: bits that fall together are combined."""
    while len(words) * 64 > bits:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    return np.stack([bitmap(s, bits) for s in sets])


def width(largest: int) -> int:
    """Bits for sets of up to ``largest`` tokens: sparse enough to tell unlike sets apart."""
    return 1 << max(6, int(4 * max(1, largest) - 1).bit_length())


class Tree:
    """Levels from leaves (0) to the root; node i of a level has children FAN*i .. FAN*i + FAN - 1 below."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        spare = sizes - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        self.levels = [(words, sizes, sizes, spare)]
        while len(self.levels[-1][0]) > 1:
            words, low, high, spare = self.levels[-1]
            cuts = np.arange(0, len(words), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(words, cuts),
                    np.minimum.reduceat(low, cuts),
                    np.maximum.reduceat(high, cuts),
                    np.maximum.reduceat(spare, cuts),
                )
            )


def _possible(one, two, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which node pairs may hold a link, by size ranges and greatest possible overlap."""
    keep = (den * one[2][a] >= num * two[1][b]) & (den * two[2][b] >= num * one[1][a])
    a, b = a[keep], b[keep]
    ok = np.zeros(len(a), bool)
    step = _at_once(one[0])
    for at in range(0, len(a), step):
        x, y = a[at : at + step], b[at : at + step]
        most = np.bitwise_count(one[0][x] & two[0][y]).sum(axis=1, dtype=np.int64) + np.minimum(one[3][x], two[3][y])
        # common >= num / (num + den) * (sum of sizes)
        ok[at : at + step] = (num + den) * most >= num * (one[1][x] + two[1][y])
    out = np.zeros(len(keep), bool)
    out[np.flatnonzero(keep)[ok]] = True
    return out


def pairs_in_turns(
    tree: Tree, num: int, den: int, groups: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs (a < b) that the dual traversal of a tree with itself does not prune, a bounded number at a time.

    ``groups``: leaves of one group are known to be connected; node pairs that lie in
    one group are pruned too.
    """
    tops = [(groups, groups)] if groups is not None else []
    for _ in tree.levels[1:] if tops else []:
        low, high = tops[-1]
        cuts = np.arange(0, len(low), FAN)
        tops.append((np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)))
    kids = np.arange(FAN)
    waiting = [(len(tree.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while waiting:  # depth first, so that few pairs wait whatever the number of leaves
        level, a, b = waiting.pop()
        nodes = tree.levels[level]
        keep = _possible(nodes, nodes, a, b, num, den)
        if tops:
            low, high = tops[level]
            keep &= np.minimum(low[a], low[b]) != np.maximum(high[a], high[b])
        a, b = a[keep], b[keep]
        if level == 0:
            apart = a < b
            yield a[apart], b[apart]
            continue
        below = len(tree.levels[level - 1][0])
        a2 = np.repeat((a[:, None] * FAN + kids).reshape(-1), FAN)
        b2 = np.tile((b[:, None] * FAN + kids), (1, FAN)).reshape(-1)
        inside = (a2 < below) & (b2 < below) & (a2 <= b2)
        a2, b2 = a2[inside], b2[inside]
        waiting += [(level - 1, a2[at : at + _TURN], b2[at : at + _TURN]) for at in range(0, len(a2), _TURN)]


def candidate_pairs(tree: Tree, num: int, den: int, groups: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ``pairs_in_turns``."""
    none = np.zeros(0, np.int64)
    a, b = (np.concatenate(x) for x in zip((none, none), *pairs_in_turns(tree, num, den, groups), strict=True))
    order = np.lexsort((b, a))
    return a[order], b[order]


def undecided(words: np.ndarray, sizes: np.ndarray, labels: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which sets may be linked with one of another component, by their bitmaps (of one width) alone.

    Beside the bound of the traversal, a set has at least as many tokens that the other
    lacks as it has bits that the other lacks.
    """
    order = np.lexsort((labels, sizes))
    w, n = words[order], sizes[order]
    keep = np.zeros(len(n), bool)
    step = _at_once(w)
    for a, b in pairs_in_turns(Tree(w, n), num, den, labels[order]):
        open_ = ~(keep[a] & keep[b])  # the others have nothing to tell
        a, b = a[open_], b[open_]
        for at in range(0, len(a), step):
            x, y = a[at : at + step], b[at : at + step]
            apart = labels[order[x]] != labels[order[y]]
            x, y = x[apart], y[apart]
            most = np.minimum(
                n[x] - np.bitwise_count(w[x] & ~w[y]).sum(axis=1, dtype=np.int64),
                n[y] - np.bitwise_count(w[y] & ~w[x]).sum(axis=1, dtype=np.int64),
            )
            ok = (num + den) * most >= num * (n[x] + n[y])
            keep[x[ok]] = keep[y[ok]] = True
    out = np.zeros(len(n), bool)
    out[order] = keep
    return out


def join(sets: list[np.ndarray], num: int, den: int, union: Union | None = None) -> list[tuple[int, int]]:
    """Links that connect the components of the sets: every linked pair ends up connected.

    ``union`` carries what is connected already.
    """
    n = len(sets)
    union = union or Union(n)
    links = []
    if n < 2:
        return links
    tested = set()
    order = np.array(sorted(range(n), key=lambda i: (len(sets[i]), sets[i][0] if len(sets[i]) else 0)))

    def verify(i: int, j: int) -> None:
        if (i, j) not in tested and union.find(i) != union.find(j):
            tested.update(((i, j), (j, i)))
            if linked(sets[i], sets[j], num, den):
                union.join(i, j)
                links.append((i, j))

    for i, j in zip(order, order[1:], strict=False):  # neighbours first: near copies connect before the traversal
        verify(int(i), int(j))
    groups = union.roots()
    if n == 2 or (groups == groups[0]).all():
        return links
    ordered = [sets[i] for i in order]
    tree = Tree(bitmaps(ordered, width(max(map(len, sets)))), np.array([len(s) for s in ordered], np.int64))
    a, b = candidate_pairs(tree, num, den, groups[order])
    a, b = order[a], order[b]
    while len(a):
        roots = union.roots()
        apart = roots[a] != roots[b]
        a, b = a[apart], b[apart]
        if not len(a):
            break
        _, once = np.unique(a, return_index=True)
        for i, j in zip(a[once].tolist(), b[once].tolist(), strict=True):
            verify(i, j)
        rest = np.ones(len(a), bool)
        rest[once] = False
        a, b = a[rest], b[rest]
    return links
