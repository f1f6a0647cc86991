"""Words of many texts found and hashed at once, straight from their UTF-8 bytes.

Every separator is an ASCII byte, and no byte of a longer UTF-8 sequence is one, so
bytes may be looked at one by one.
"""

from __future__ import annotations

import numpy as np

WORD_BASE = np.uint64(0x9E3779B97F4A7C55)
_STEPS = np.random.default_rng(20240229).integers(1, 1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_VALUES = np.random.default_rng(7919).integers(1, 1 << 63, size=256, dtype=np.uint64)


def fold_table() -> np.ndarray:
    """Byte to byte: A-Z to a-z, all else as it is."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def space_words() -> np.ndarray:
    """Which bytes belong to words ``[^\\x20\\x09-\\x0D]+``."""
    table = np.ones(256, dtype=bool)
    table[[0x20, *range(0x09, 0x0E)]] = False
    return table


def letter_digit_words() -> np.ndarray:
    """Which bytes, once folded, belong to words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were ever needed."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, 1 << 16)
            inverse = np.uint64(pow(int(WORD_BASE), -1, 1 << 64))
            made = []
            for factor in (WORD_BASE, inverse):
                line = np.full(size, factor, dtype=np.uint64)
                line[0] = 1
                made.append(np.multiply.accumulate(line))
            self.up, self.down = made
        return self.up[:count], self.down[:count]


POWERS = Powers()


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; spreads every input bit over the result."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_spans(raw: np.ndarray, starts: np.ndarray, belongs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of every word; no word goes beyond its text."""
    inside = belongs[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first = starts[:-1][np.diff(starts) > 0]
    begins[first] |= inside[first]
    ends[first[first > 0] - 1] |= inside[first[first > 0] - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, with A-Z taken as a-z."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    up, down = POWERS.upto(len(raw))
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUES[fold_table()][raw] * up, out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * down[begins])


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on; the last ``width - 1`` places have none."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        total += words[k : k + count] * _STEPS[k]
    return mixed(total)


def words_per_text(begins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the words of each text begin in the list of all words (one more entry than texts)."""
    return np.searchsorted(begins, starts)
