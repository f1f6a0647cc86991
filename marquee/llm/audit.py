"""The cheapest edits that make a conversation well formed, by a program over persistent chains of edits."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

#: States while reading: nothing yet, after system, after user, after assistant; the first and last may end.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (EMPTY, ASSISTANT)
#: Where a user and an assistant row lead to.
_TO_USER = {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}
_TO_ASSISTANT = {USER: ASSISTANT}
_BY_INITIAL = {"s": {EMPTY: SYSTEM}, "u": _TO_USER, "a": _TO_ASSISTANT}
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Costs(NamedTuple):
    """Of the edits, and of a truncated row that is not deleted.  An insertion costs something, or chains could grow freely."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Row(NamedTuple):
    """A row to edit: the initial of its role, whether it must go, whether it is truncated, and how often in a row."""

    initial: str
    must_go: bool
    truncated: bool
    times: int = 1


class Chains:
    """Chains of edits that share their beginnings; a chain is the number of its last edit, 0 the empty one.

    An edit knows the edit before it and those 2, 4, 8 ... before, and a rolling hash of all edits so far.  Two chains
    are compared where their common beginning ends, found by the hashes.  That beginning is usually one and the same chain; if
    it is not, the edits are looked at, so a hash that deceives does no harm.
    """

    def __init__(self) -> None:
        self.edit: list[tuple[str, int]] = [("", 0)]
        self.before: list[list[int]] = [[]]
        self.depth, self.hash = [0], [0]

    def grown(self, chain: int, letter: str, times: int = 1) -> int:
        """The chain with an edit more, ``times`` in a row as one."""
        above, up = chain, [chain]
        while len(self.before[above]) >= len(up):
            above = self.before[above][len(up) - 1]
            up.append(above)
        self.edit.append((letter, times))
        self.before.append(up)
        self.depth.append(self.depth[chain] + 1)
        self.hash.append((self.hash[chain] * _BASE + ord(letter) + 131 * times) % _PRIME)
        return len(self.edit) - 1

    def _at_depth(self, chain: int, depth: int) -> int:
        while self.depth[chain] > depth:
            step = (self.depth[chain] - depth).bit_length() - 1
            chain = self.before[chain][step]
        return chain

    def less(self, one: int, two: int) -> bool:
        """Whether the edits of one chain come before the other's in ASCII order."""
        depth = min(self.depth[one], self.depth[two])
        a, b = self._at_depth(one, depth), self._at_depth(two, depth)
        if self.hash[a] != self.hash[b]:
            for step in reversed(range(len(self.before[a]))):
                if step < len(self.before[a]):
                    c, d = self.before[a][step], self.before[b][step]
                    if self.hash[c] != self.hash[d]:
                        a, b = c, d
            c, d = self.before[a][0], self.before[b][0]
            (x, n), (y, m) = self.edit[a], self.edit[b]
            if self._same(c, d) and x != y:
                return x < y
        elif a == b:
            return self.depth[one] < self.depth[two]
        # Equal hashes of different edits, or edits that go on alike: letter by letter.
        return self.letters(one) < self.letters(two)

    def _same(self, one: int, two: int) -> bool:
        """Whether chains of equal hashes are equal; they mostly are one chain."""
        while one != two:
            if self.edit[one] != self.edit[two]:
                return False
            one, two = self.before[one][0], self.before[two][0]
        return True

    def letters(self, chain: int) -> str:
        parts = []
        while chain:
            letter, times = self.edit[chain]
            parts.append(letter * times)
            chain = self.before[chain][0]
        return "".join(reversed(parts))


Best = dict[int, tuple[int, int]]


def cheapest(rows: Iterable[Row], begin: int = EMPTY, costs: Costs = Costs()) -> dict[int, tuple[int, str]]:
    """By state at the end, the least cost of the edits of ``rows`` that lead there from ``begin``, and of those the first in ASCII order.

    Rows may be none.  The edits are K(eep), R(erole), D(elete) and I(nsert), each in the row's place.
    """
    chains = Chains()

    def offer(best: Best, state: int, cost: int, chain: int, letter: str, times: int = 1) -> None:
        known = best.get(state)
        if known is None or cost <= known[0]:
            made = chains.grown(chain, letter, times)
            if known is None or cost < known[0] or chains.less(made, known[1]):
                best[state] = (cost, made)

    def with_insertions(best: Best) -> Best:
        # From any state, two insertions lead to each state that can be inserted to.
        for _ in range(2):
            for state, (cost, chain) in sorted(best.items()):
                for leads in (_TO_USER, _TO_ASSISTANT):
                    if state in leads:
                        offer(best, leads[state], cost + costs.insert, chain, "I")
        return best

    best: Best = with_insertions({begin: (0, 0)})
    for row in rows:
        after: Best = {}
        more = costs.truncated if row.truncated else 0
        for state, (cost, chain) in sorted(best.items()):
            offer(after, state, cost + costs.delete * row.times, chain, "D", row.times)
            if row.must_go:
                continue
            kept = _BY_INITIAL.get(row.initial, {})
            if state in kept:
                offer(after, kept[state], cost + more, chain, "K")
            for leads in (_TO_USER, _TO_ASSISTANT):
                if state in leads:
                    offer(after, leads[state], cost + costs.rerole + more, chain, "R")
        best = with_insertions(after)
    return {state: (cost, chains.letters(chain)) for state, (cost, chain) in best.items()}


def repaired(rows: Sequence[tuple[str, str, int]], edits: str, state: int = EMPTY) -> Iterator[str]:
    """The lines ``role:text`` that the edits leave of rows of role, text and how often in a row, beginning in ``state``."""
    expanded = (row for row in rows for _ in range(row[2]))
    for edit in edits:
        role, text, _ = ("", "", 0) if edit == "I" else next(expanded)
        if edit == "D":
            continue
        if edit == "K":
            state = _BY_INITIAL[role[:1]][state]
        else:
            state, role = (ASSISTANT, "assistant") if state == USER else (USER, "user")
        yield f"{role}:{text}"


def best_path(parts: Sequence[dict[int, dict[int, tuple[int, str]]]]) -> list[int]:
    """The states between consecutive parts, from the start to the end, on the cheapest way through them.

    ``parts`` has per state at its beginning what :func:`cheapest` gives.  Ties go to the first edits in ASCII order.
    """
    best: dict[int, tuple[int, tuple]] = {EMPTY: (0, ())}

    def less(one: tuple, two: tuple) -> bool:
        # Ways are linked backwards; what they share is not looked at.
        a, b = [], []
        while one is not two and one and two:
            a.append(one[1])
            b.append(two[1])
            one, two = one[0], two[0]
        return "".join(reversed(a)) < "".join(reversed(b))

    for part in parts:
        after: dict[int, tuple[int, tuple]] = {}
        for state, (cost, way) in sorted(best.items()):
            for end, (more, edits) in part[state].items():
                made = (way, edits, end)
                known = after.get(end)
                if known is None or cost + more < known[0] or (cost + more == known[0] and less(made, known[1])):
                    after[end] = (cost + more, made)
        best = after
    ends = [best[state] for state in ENDS if state in best]
    cost = min(c for c, _ in ends)
    ways = [way for c, way in ends if c == cost]
    way = ways[0] if len(ways) == 1 or less(ways[0], ways[1]) else ways[1]
    states = []
    while way:
        states.append(way[2])
        way = way[0]
    return [EMPTY, *reversed(states)]
