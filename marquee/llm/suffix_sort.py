"""Deep-shallow sorting of strings: multikey quicksort down to a shallow depth, blind tries below it."""

from __future__ import annotations

#: Bytes that quicksort looks at; what agrees so far goes into a blind trie.
SHALLOW = 64
_WORD = 8
_ENDED = -1


def common_prefix(a: bytes, b: bytes) -> int:
    """Bytes that two strings share at their beginning."""
    size = min(len(a), len(b))
    differ = int.from_bytes(a[:size], "big") ^ int.from_bytes(b[:size], "big")
    return size - (differ.bit_length() + 7) // 8


def sort_strings(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """The order of the strings, equal ones by place, and for each in that order the bytes shared with the one before.

    A string that another one begins with goes first.  Empty strings and an empty list are fine.
    """
    order: list[int] = []
    pending = [(list(range(len(strings))), 0)]
    while pending:
        group, depth = pending.pop()
        if len(group) < 2 or depth == _ENDED:
            order.extend(group)
            continue
        if depth >= shallow:
            order.extend(BlindTrie(strings, group).ordered())
            continue
        # A word of several letters at a time; three ways by a median of three.
        words = [strings[k][depth : depth + _WORD] for k in group]
        pivot = sorted((words[0], words[len(words) // 2], words[-1]))[1]
        below, equal, above = [], [], []
        for k, word in zip(group, words, strict=True):
            (equal if word == pivot else below if word < pivot else above).append(k)
        # Strings with a shorter word end there, so they are equal.
        deeper = depth + _WORD if len(pivot) == _WORD else _ENDED
        pending += [(above, depth), (equal, deeper), (below, depth)]
    shared = [0] * len(order)
    for at in range(1, len(order)):
        shared[at] = common_prefix(strings[order[at - 1]], strings[order[at]])
    return order, shared


class _Leaf:
    """Places of equal strings."""

    __slots__ = ("places",)

    def __init__(self, place: int) -> None:
        self.places = [place]


class _Fork:
    """The depth at which strings part, and what follows by letter; an ended string has letter -1."""

    __slots__ = ("below", "depth")

    def __init__(self, depth: int) -> None:
        self.depth = depth
        self.below: dict[int, _Fork | _Leaf] = {}


class BlindTrie:
    """A trie of the depths at which its strings part, filled one string after the other.

    A string goes down by its letters at those depths alone, blind to the letters between them; one
    comparison with a string found there tells where it really leaves the path.
    """

    def __init__(self, strings: list[bytes], group: list[int]) -> None:
        self.strings = strings
        self.root: _Fork | _Leaf = _Leaf(group[0])
        for place in group[1:]:
            self._add(place)

    def _add(self, place: int) -> None:
        text = self.strings[place]
        path = [self.root]
        while isinstance(path[-1], _Fork):
            below, depth = path[-1].below, path[-1].depth
            letter = text[depth] if depth < len(text) else _ENDED
            path.append(below[letter] if letter in below else next(iter(below.values())))
        other = self.strings[path[-1].places[0]]
        if other == text:
            path[-1].places.append(place)
            return
        leaves = common_prefix(text, other)
        at = next(k for k, node in enumerate(path) if isinstance(node, _Leaf) or node.depth >= leaves)
        node = path[at]
        if isinstance(node, _Leaf) or node.depth > leaves:
            fork = _Fork(leaves)
            fork.below[other[leaves] if leaves < len(other) else _ENDED] = node
            if at:
                above = path[at - 1]
                above.below[other[above.depth] if above.depth < len(other) else _ENDED] = fork
            else:
                self.root = fork
            node = fork
        node.below[text[leaves] if leaves < len(text) else _ENDED] = _Leaf(place)

    def ordered(self) -> list[int]:
        """The places of the strings in order, equal ones by place."""
        found: list[int] = []
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if isinstance(node, _Leaf):
                found.extend(sorted(node.places))
            else:
                waiting.extend(node.below[letter] for letter in sorted(node.below, reverse=True))
        return found
