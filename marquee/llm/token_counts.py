"""Exact token counts of every prefix of a text, by dynamic programming over its prefixes.

For byte-pair encodings a sequence of tokens is the encoding of its text exactly if
every two neighbours are the encoding of their own text.  So the encoding of a prefix
is that of a shorter prefix and one last token, and only one token fits.  Going
from prefix to prefix gives the count of all of them, and with them the answer to
any question on truncation or budgets, without encoding anything again.

No piece of the model goes on from another character to the mark of a space, so
words with the spaces before them are encoded apart; their counts are kept per task.  Words of a batch advance
together; one longer than ``KEPT_LENGTH``, such as a line without spaces, goes by itself.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.batches import slices
from marquee.llm.shipping import in_tasks
from marquee.llm.wordhash import POWERS, mixed

SPACE = "▁"
#: Words kept with their counts in a task, and the longest of them.
KEPT_WORDS, KEPT_LENGTH = 600_000, 64
#: Slots for checked pairs of tokens; a newer pair takes the slot of an older one.
PAIR_SLOTS = 1 << 22
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceTable:
    """Numbers of pieces by the hash of their characters, for many substrings at once."""

    BITS = 20

    def __init__(self, pieces: list[str]) -> None:
        keys = np.array([self.sums(piece)[0][-1] for piece in pieces], dtype=np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have the same hash")
        # Most substrings are no piece; a small table tells so at once.
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[keys >> np.uint64(64 - self.BITS)] = True
        self.levels = []
        left = np.arange(len(pieces))
        while len(left):  # pieces that meet in a slot go on to the next, nearly empty level
            shift = np.uint64(64 - self.BITS - 3 * len(self.levels))
            slots = (keys[left] >> shift) & np.uint64((1 << self.BITS) - 1)
            _, first = np.unique(slots, return_index=True)
            key, number = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
            key[slots[first]], number[slots[first]] = keys[left[first]], left[first]
            self.levels.append((shift, key, number))
            left = np.delete(left, first)

    @staticmethod
    def sums(text: str) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of the characters' values, and what turns a difference into a hash."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        up, down = POWERS.upto(len(codes) + 1)
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mixed(codes + np.uint64(1)) * up[:-1], out=total[1:])
        return total, down

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The piece of each key, or -1."""
        all_found = np.full(len(keys), -1, np.int32)
        likely = np.flatnonzero(self.maybe[keys >> np.uint64(64 - self.BITS)])
        keys = keys[likely]
        found = all_found[likely]
        for shift, key, number in self.levels:
            slot = (keys >> shift) & np.uint64((1 << self.BITS) - 1)
            found = np.where(key[slot] == keys, number[slot], found)
        all_found[likely] = found
        return all_found


class PrefixCounter(dict):
    """Counts for every prefix of a word; as a mapping, of words without the one space before them.

    The values are bytes, one count for each of the space and the characters.
    """

    def __init__(self, model: str) -> None:
        super().__init__()
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        plain = [
            i
            for i in range(library.get_piece_size())
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        ]
        self.score = {library.id_to_piece(i): library.get_score(i) for i in plain}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.score):
            raise ValueError("a piece of this model holds a space after another character")
        self.pieces = list(self.score)
        self.longest = max(map(len, self.pieces))
        self.table = PieceTable(self.pieces)
        self.number = {piece: k for k, piece in enumerate(self.pieces)}
        self.pairs: dict[int, bool] = {}
        # Two more numbers: a character that the model lacks, and the begin of a word.
        self.lacking, self.begin = len(self.pieces), len(self.pieces) + 1
        self.pair_keys, self.pair_fits = np.zeros(PAIR_SLOTS, np.uint64), np.zeros(PAIR_SLOTS, bool)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the best pair is joined first, the leftmost of equals."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                value = score.get(parts[k] + parts[k + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _checked(self, pair: int) -> bool:
        before, piece = self._named(pair >> 32), self._named((pair & 0xFFFFFFFF) - 1)
        if not piece:
            return True
        return self.merged(before + piece) == ([before, piece] if before else [piece])

    def _named(self, number: int) -> str:
        return self.pieces[number] if number < self.lacking else ""

    def fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each piece can follow the token before it; each pair is checked once."""
        pairs = (before.astype(np.uint64) << np.uint64(32)) | (piece.astype(np.uint64) + np.uint64(1))
        slots = mixed(pairs) & np.uint64(PAIR_SLOTS - 1)
        known = self.pair_keys[slots] == pairs
        good = self.pair_fits[slots]
        if not known.all():
            new, back = np.unique(pairs[~known], return_inverse=True)
            answers = np.fromiter(map(self._checked, map(int, new)), bool, len(new))
            good[~known] = answers[back]
            at = mixed(new) & np.uint64(PAIR_SLOTS - 1)
            self.pair_keys[at], self.pair_fits[at] = new, answers
        return good

    def counts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of every prefix of every word, the words on end; and where each word begins.

        All words advance together: at each length the longest piece that can follow the
        tokens of the prefix before it is the last token, and no other piece could be.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        text = "".join(words)
        total, down = self.table.sums(text)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        # A character that the model lacks is written as its bytes.
        cost = (1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)).astype(np.int64)
        single = self.table.numbers((total[1:] - total[:-1]) * down[:-1]) if len(text) else codes[:0]
        last, tokens = np.empty(len(text), np.int32), np.zeros(len(text), np.int64)
        order = np.argsort(-lengths, kind="stable")
        shrinking = np.searchsorted(-lengths[order], -np.arange(1, (lengths.max() if len(words) else 0) + 1), side="right")
        for step, alive in enumerate(shrinking, start=1):
            first = starts[order[:alive]]
            for size in range(min(step, self.longest), 0, -1):
                if not len(first):
                    break
                end = first + step
                if size > 1:
                    piece = self.table.numbers((total[end] - total[end - size]) * down[end - size])
                    maybe = np.flatnonzero(piece >= 0)
                else:
                    piece = np.where(single[end - 1] >= 0, single[end - 1], self.lacking)
                    maybe = np.arange(len(first))
                if not len(maybe):
                    continue
                at, piece = end[maybe] - 1, piece[maybe]
                before = last[at - size] if step > size else np.full(len(maybe), self.begin, np.int32)
                good = self.fits(before, piece)
                at, piece = at[good], piece[good]
                last[at] = piece
                tokens[at] = np.where(piece == self.lacking, cost[at], 1) + (tokens[at - size] if step > size else 0)
                first = np.delete(first, maybe[good])
        return tokens, starts

    def counts_of_long(self, word: str) -> np.ndarray:
        """As :meth:`counts` for one long word, character by character: arrays of one element are slower than numbers."""
        number, pairs, longest, lacking = self.number, self.pairs, self.longest, self.lacking
        last, tokens = [self.begin] * (len(word) + 1), [0] * (len(word) + 1)
        if len(pairs) > PAIR_SLOTS >> 2:
            pairs.clear()
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - longest), end):
                piece = number.get(word[begin:end])
                if piece is None:
                    if end - begin > 1:
                        continue
                    piece = lacking
                pair = last[begin] << 32 | piece + 1
                good = pairs.get(pair)
                if good is None:
                    good = pairs[pair] = self._checked(pair)
                if good:
                    last[end] = piece
                    tokens[end] = tokens[begin] + (len(word[begin].encode()) if piece == lacking else 1)
                    break
        return np.array(tokens[1:], dtype=np.int64)

    def counts_of_any(self, words: list[str]) -> np.ndarray:
        """Tokens of every prefix of every word, the words on end."""
        short = [word for word in words if len(word) <= KEPT_LENGTH]
        inner, starts = self.counts(short)
        parts, at = [], 0
        for word in words:
            if len(word) > KEPT_LENGTH:
                parts.append(self.counts_of_long(word))
            else:
                parts.append(inner[starts[at] : starts[at + 1]])
                at += 1
        return np.concatenate(parts)

    def learn(self, words: set[str]) -> None:
        """Counts of new short words, all at once."""
        new = [word for word in words.difference(self) if 0 < len(word) <= KEPT_LENGTH]
        if len(self) + len(new) > KEPT_WORDS:
            self.clear()
            new = [word for word in words if 0 < len(word) <= KEPT_LENGTH]
        tokens, starts = self.counts([SPACE + word for word in new])
        flat, starts = tokens.astype(np.uint8).tobytes(), starts.tolist()
        self.update(zip(new, [flat[a:b] for a, b in zip(starts, starts[1:], strict=False)], strict=True))

    def of_texts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text, entry ``k``: the tokens of its first ``k`` characters, for k from 0 to the length."""
        split = [text.replace(SPACE, " ").split(" ") for text in texts]
        self.learn(set().union(*split))
        for text, words in zip(texts, split, strict=True):
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            if not text:
                yield np.zeros(1, np.int64)
                continue
            if lengths.min() > 1 and lengths.max() <= KEPT_LENGTH:
                inner = np.frombuffer(b"".join(map(self.__getitem__, words)), np.uint8)
            else:
                apart = _WORD.findall(SPACE + text.replace(" ", SPACE))
                lengths = np.fromiter(map(len, apart), np.int64, len(apart))
                inner = self.counts_of_any(apart)
            ends = np.cumsum(lengths)
            of_words = inner[ends - 1].astype(np.int64)
            counts = inner + np.repeat(np.cumsum(of_words) - of_words, lengths)
            counts[0] = 0  # the space that the library sets before a text is no text of its own
            yield counts

    def prefix_counts(self, text: str) -> np.ndarray:
        return next(self.of_texts([text]))


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model: str) -> PrefixCounter:
    """One per process and model file."""
    if model not in _COUNTERS:
        _COUNTERS[model] = PrefixCounter(model)
    return _COUNTERS[model]


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix that takes at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1]) if budget >= 0 else 0


def packed(counts: np.ndarray) -> bytes:
    """Prefix counts as bytes; neighbours differ little, so the steps deflate well."""
    return zlib.compress(np.diff(counts).astype("<i4").tobytes(), 1)


def unpacked(stored: bytes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.frombuffer(zlib.decompress(stored), "<i4"), dtype=np.int64)])


def token_counts(
    docs: DataFrame,
    model: str,
    budget: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_prefixes: bool = False,
) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_tokens`` and ``chars_in_budget``, the longest prefix within ``budget``.

    With ``keep_prefixes`` also ``prefix_counts``, the counts of all prefixes, for
    ``unpacked``.  A null text is empty: no bytes, no tokens.  Ids may be null or
    repeated; each row gives a row.  Other columns are left out, whatever their names.  ``model``
    must be a path that every executor can read.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    extra = ", prefix_counts binary" if keep_prefixes else ""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = counter(model)
        for batch in slices(batches, "text", 1 << 22):
            rows, kept = [], []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for text, counts in zip(texts, prefixes.of_texts(texts), strict=True):
                rows.append((len(text.encode()), int(counts[-1]), longest_prefix(counts, budget)))
                if keep_prefixes:
                    kept.append(packed(counts))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True))]
            names = ["id", "n_bytes", "n_tokens", "chars_in_budget"]
            if keep_prefixes:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "prefix_counts"]
            yield pa.RecordBatch.from_arrays(columns, names)

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    schema = f"id {kind}, n_bytes long, n_tokens long, chars_in_budget long{extra}"
    return in_tasks(read, count, schema).withColumnRenamed("id", id_column)
