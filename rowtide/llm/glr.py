"""Generalised LR repair of a sequence of roles against a grammar.

The LR(0) automaton of the grammar is built from its productions. Stacks share their lower parts: a
stack is a node (state, node below), made once. All stacks that are possible after some rows are followed side
by side, each with the least (cost, audit) that leads to it; equal tops are merged by that minimum. In this grammar a top
state has one stack below it, so equal tops are equal stacks. A row may be kept (shift its
role), reroled (shift another), or deleted; a role may be inserted anywhere.

Two audits of equal cost that lead to one stack after the same rows are never prefix of each other (they
would differ by insertions, which cost), so the lesser of them stays the lesser whatever follows.

A stack is dropped once it costs more than ``SLACK`` above the cheapest: from any stack, what follows
any other one can be had for at most that much more. What is followed is then a
small set of costs relative to the cheapest, and of audits after their common prefix; the
step from such a set by a row is looked up if it was made before.
"""

from __future__ import annotations

import os
from functools import cache

GRAMMAR = (
    ("conversation", ()),
    ("conversation", ("body",)),
    ("body", ("half", "a")),
    ("half", ("lead", "u")),
    ("half", ("body", "u")),
    ("lead", ()),
    ("lead", ("s",)),
)
TERMINALS = ("s", "u", "a")
INSERTED = ("u", "a")  # roles that may be inserted, or set by a rerole
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# Two insertions make a body of a lead, one moves between half and body, and a kept system row
# that only the empty stack can take is deleted instead.
SLACK = 2 * INSERT + DELETE
REMEMBERED = 1 << 16  # steps that are looked up

Weight = tuple[int, str]
Live = tuple[tuple[int, int, str], ...]  # (stack, cost above the cheapest, audit after the common prefix)


@cache
def automaton() -> tuple[list[frozenset], dict[tuple[int, str], int]]:
    """States (sets of (production, dot)) and the transitions by any symbol."""

    def closed(items):
        items, todo = set(items), list(items)
        while todo:
            rule, dot = todo.pop()
            right = GRAMMAR[rule][1]
            if dot < len(right):
                more = [(i, 0) for i, (left, _) in enumerate(GRAMMAR) if left == right[dot] and (i, 0) not in items]
                items.update(more)
                todo += more
        return frozenset(items)

    states = [closed({(i, 0) for i, (left, _) in enumerate(GRAMMAR) if left == "conversation"})]
    moves = {}
    for at, state in enumerate(states):  # grows while it is read
        for symbol in sorted({GRAMMAR[r][1][d] for r, d in state if d < len(GRAMMAR[r][1])}):
            target = closed({(r, d + 1) for r, d in state if d < len(GRAMMAR[r][1]) and GRAMMAR[r][1][d] == symbol})
            if target not in states:
                states.append(target)
            moves[at, symbol] = states.index(target)
    return states, moves


class Repair:
    """The stacks of the grammar and the steps between sets of them."""

    def __init__(self) -> None:
        self.states, self.moves = automaton()
        self.nodes: list[tuple[int, int]] = [(0, -1)]  # (state, node below)
        self.place = {(0, -1): 0}
        self.remembered: dict[tuple[Live, str], tuple[int, str, Live]] = {}
        self.entries = self._entries()

    def _node(self, symbol: str, below: int) -> int | None:
        state = self.moves.get((self.nodes[below][0], symbol))
        if state is None:
            return None
        if (state, below) not in self.place:
            self.place[state, below] = len(self.nodes)
            self.nodes.append((state, below))
        return self.place[state, below]

    def _reduced(self, node: int) -> list[int]:
        """Stacks that one reduction makes of ``node``."""
        out = []
        for rule, dot in self.states[self.nodes[node][0]]:
            left, right = GRAMMAR[rule]
            if dot == len(right) and left != "conversation":
                base = node
                for _ in right:
                    base = self.nodes[base][1]
                out.append(self._node(left, base))
        return out

    def _closed(self, live: dict[int, Weight], insert: bool) -> dict[int, Weight]:
        """With every stack that reductions (and insertions) lead to."""
        live, todo = dict(live), list(live)
        while todo:
            node = todo.pop()
            cost, audit = live[node]
            steps = [(n, (cost, audit)) for n in self._reduced(node)]
            if insert:
                steps += [(self._node(t, node), (cost + INSERT, audit + "I")) for t in INSERTED]
            for n, weight in steps:
                if n is not None and (n not in live or weight < live[n]):
                    live[n] = weight
                    todo.append(n)
        return live

    def _shifts(self, node: int) -> bool:
        return any((self.nodes[node][0], t) in self.moves for t in TERMINALS)

    def _entries(self) -> list[int]:
        """Stacks that may be there between two rows."""
        found = {0}
        while True:
            more = self._closed(dict.fromkeys(found, (0, "")), insert=False)
            more |= {n: (0, "") for f in list(more) for t in TERMINALS if (n := self._node(t, f)) is not None}
            more = {n for n in self._closed(more, insert=False) if self._shifts(n)}
            if more <= found:
                return sorted(found)
            found |= more

    def begin(self, entry: int = 0) -> Live:
        return ((entry, 0, ""),)

    def step(self, live: Live, symbol: str) -> tuple[int, str, Live]:
        """(cost, audit) that all stacks share after a row, and the stacks beyond that.

        ``symbol``: the role's initial, in upper case if the row is truncated, ``-`` if it must go.
        """
        known = self.remembered.get((live, symbol))
        if known is None:
            known = self._step(live, symbol)
            if len(self.remembered) >= REMEMBERED:
                self.remembered.clear()
            self.remembered[live, symbol] = known
        return known

    def _step(self, live: Live, symbol: str) -> tuple[int, str, Live]:
        out: dict[int, Weight] = {}

        def offer(node: int | None, weight: Weight) -> None:
            if node is not None and (node not in out or weight < out[node]):
                out[node] = weight

        role, extra = symbol.lower(), TRUNCATED * symbol.isupper()
        for node, (cost, audit) in self._closed({n: (c, a) for n, c, a in live}, insert=True).items():
            offer(node, (cost + DELETE, audit + "D"))
            if symbol != "-":
                if role in TERMINALS:
                    offer(self._node(role, node), (cost + KEEP + extra, audit + "K"))
                for t in INSERTED:
                    offer(self._node(t, node), (cost + REROLE + extra, audit + "R"))
        out = {n: w for n, w in self._closed(out, insert=False).items() if self._shifts(n)}
        least = min(c for c, _ in out.values())
        out = {n: w for n, w in out.items() if w[0] <= least + SLACK}
        shared = os.path.commonprefix([a for _, a in out.values()])
        return least, shared, tuple(sorted((n, c - least, a[len(shared) :]) for n, (c, a) in out.items()))

    def finished(self, live: Live) -> Weight:
        """The least (cost, audit) with which the stacks can be accepted."""
        done = [(c, a) for n, (c, a) in self._closed({n: (c, a) for n, c, a in live}, insert=True).items() if self._accepts(n)]
        return min(done)

    def _accepts(self, node: int) -> bool:
        """Whether the stack may be reduced to a conversation."""
        return any(
            GRAMMAR[r][0] == "conversation" and d == len(GRAMMAR[r][1]) for r, d in self.states[self.nodes[node][0]]
        )


class Run:
    """A sequence of rows followed from one stack."""

    def __init__(self, repair: Repair, entry: int = 0) -> None:
        self.repair, self.live, self.cost, self.shared = repair, repair.begin(entry), 0, []

    def feed(self, symbol: str) -> None:
        cost, audit, self.live = self.repair.step(self.live, symbol)
        self.cost += cost
        if audit:
            self.shared.append(audit)

    def exits(self) -> dict[int, Weight]:
        shared = "".join(self.shared)
        return {n: (self.cost + c, shared + a) for n, c, a in self.live}

    def finished(self) -> Weight:
        cost, audit = self.repair.finished(self.live)
        return self.cost + cost, "".join(self.shared) + audit

