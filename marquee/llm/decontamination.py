"""Benchmark passages in training texts, found with a generalised suffix automaton.

The automaton holds every sequence of words that stands in some test item.  Streaming a
text through it gives, at every word, the longest sequence ending there that an item holds.
Where that reaches a window's length, the window's words are hit.

Streaming word by word is only needed where several words in a row stand in an
item that way too; such places are found for a whole batch of texts at once by the hashes of
short word sequences, and words elsewhere would only reset the automaton.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.batches import buffer_of, slices
from marquee.llm.shipping import in_tasks
from marquee.llm.storage import drop, stored
from marquee.llm.wordhash import (
    fold_table,
    gram_hashes,
    letter_digit_words,
    word_hashes,
    word_spans,
    words_per_text,
)

#: So many consecutive words must stand in an item before the automaton looks at them.
SEED_WORDS = 3
#: Test items of so many bytes together share one automaton; more items take more passes.
AUTOMATON_BYTES = 8 << 20


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, A-Z taken as a-z."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    begins, ends = word_spans(raw, np.array([0, len(raw)]), letter_digit_words())
    folded = fold_table()[raw].tobytes()
    return [folded[a:b] for a, b in zip(begins, ends, strict=True)]


class Automaton:
    """A suffix automaton over the words of several items; no sequence crosses items."""

    def __init__(self, items: Sequence[tuple[object, list[bytes]]], window: int) -> None:
        self.window = window
        items = [(item, words) for item, words in items if words]
        self.items = [item for item, _ in items]
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        for _, words in items:
            last, path = 0, []
            for word in words:
                last = self._extend(last, word)
                path.append(last)
            ends.append(path)
        # By the state that a window ends in, the items that hold it; short items are windows as a whole.
        self.holds: dict[int, set[int]] = {}
        self.short: dict[int, tuple[int, set[int]]] = {}
        for number, path in enumerate(ends):
            if len(path) < window:
                self.short.setdefault(self._cut(path[-1], len(path)), (len(path), set()))[1].add(number)
            else:
                for state in path[window - 1 :]:
                    self.holds.setdefault(self._cut(state, window), set()).add(number)
        # The short items that end wherever a state is reached.
        self.ends: list[tuple[tuple[int, set[int]], ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            own = self.short.get(state)
            self.ends[state] = self.ends[self.link[state]] + ((own,) if own else ())
        self.seed = min([SEED_WORDS, window, *map(len, ends)])
        self.seeds = self._seeds([words for _, words in items])

    def _seeds(self, items: Sequence[list[bytes]]) -> np.ndarray:
        """Hashes of all sequences of ``seed`` words that items hold."""
        found = [np.zeros(0, np.uint64)]
        for words in items:
            raw = np.frombuffer(b" ".join(words), np.uint8)
            begins, ends = word_spans(raw, np.array([0, len(raw)]), letter_digit_words())
            found.append(gram_hashes(word_hashes(raw, begins, ends), self.seed))
        return np.unique(np.concatenate(found))

    def _cut(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` has read."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _clone(self, state: int, word: bytes, target: int) -> int:
        copy = len(self.link)
        self.next.append(dict(self.next[target]))
        self.link.append(self.link[target])
        self.length.append(self.length[state] + 1)
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        new = len(self.link)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[last] + 1)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            straight = self.length[target] == self.length[state] + 1
            self.link[new] = target if straight else self._clone(state, word, target)
        return new

    def stream(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which of the words are hit, and the items whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        state = length = 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            state = self.next[state].get(word, 0)
            length = length + 1 if state else 0
            if length >= self.window:
                hit[place + 1 - self.window : place + 1] = True
                items |= self.holds.get(self._cut(state, self.window), set())
            for whole, numbers in self.ends[state]:
                if whole <= length:
                    hit[place + 1 - whole : place + 1] = True
                    items |= numbers
        return hit, items


class Found(NamedTuple):
    """What a text holds of the items: which words are hit, where the words are in its bytes, which items."""

    hit: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    items: set


def scan(automaton: Automaton, texts: pa.Array) -> Iterator[Found]:
    """One result per text."""
    raw, starts = buffer_of(texts)
    begins, ends = word_spans(raw, starts, letter_digit_words())
    bounds = words_per_text(begins, starts)
    grams = gram_hashes(word_hashes(raw, begins, ends), automaton.seed)
    marked = np.zeros(0, np.int64)
    if len(automaton.seeds):
        place = np.minimum(np.searchsorted(automaton.seeds, grams), len(automaton.seeds) - 1)
        marked = np.flatnonzero(automaton.seeds[place] == grams)
    folded = fold_table()
    for k in range(len(starts) - 1):
        first, last = bounds[k], bounds[k + 1]
        here = marked[np.searchsorted(marked, first) : np.searchsorted(marked, last)]
        hit, items = np.zeros(last - first, bool), set()
        # Runs of words of which every few in a row stand in an item.
        for run in np.split(here, np.flatnonzero(np.diff(here) > 1) + 1) if len(here) else []:
            begin, end = run[0], min(run[-1] + automaton.seed, last)
            low = begins[begin]
            text = folded[raw[low : ends[end - 1]]].tobytes()
            words = [text[a - low : b - low] for a, b in zip(begins[begin:end], ends[begin:end], strict=True)]
            marks, numbers = automaton.stream(words)
            hit[begin - first : end - first] |= marks
            items |= {automaton.items[n] for n in numbers}
        yield Found(hit, begins[first:last] - starts[k], ends[first:last] - starts[k], items)


def blocks_of(benchmark: DataFrame, id_column: str, text_column: str) -> Iterator[tuple[list[tuple[object, list[bytes]]], bool]]:
    """The items in blocks of about ``AUTOMATON_BYTES``, each with whether it is the last one.

    Spark deals the items out by a hash and writes them; only one block at a time is read by the driver.
    """
    items = benchmark.select(F.col(id_column).alias("item"), F.col(text_column).cast("string").alias("words"))
    size = items.agg(F.sum(F.octet_length("words").cast("long"))).first()[0] or 0
    count = max(1, -(-size // AUTOMATON_BYTES))
    if count > 1:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(count)).cast("int"))
        items = stored(benchmark.sparkSession, dealt.repartition("block").sortWithinPartitions("block"), "benchmark")
    for block in range(count):
        rows = (items.where(F.col("block") == block) if count > 1 else items).select("item", "words").collect()
        yield [(item, words_of(text)) for item, text in rows], block == count - 1


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_hit``, ``items`` (ids as sorted strings), ``spans`` and ``sizes``.

    A word is hit if it stands in an occurrence of ``window`` consecutive words of an item, or
    of a whole item that is shorter.  ``spans`` are the stretches of hit words, as begin and end in
    the UTF-8 bytes of the text, and ``sizes`` their words.  Null texts and items have no words, and an item without
    words occurs nowhere.  With no items nothing is hit.  Rows may repeat and ids may be null;
    other columns are left out.

    The texts are streamed through one automaton of bounded size after the other, which go
    to the tasks as lists of items; they are not shuffled.  Items of over ``AUTOMATON_BYTES`` together take
    a pass over the texts for each block of them, and each pass but the last one is written.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    context = docs.sparkSession.sparkContext
    frame = read = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).cast("string").alias("text"),
        F.lit(None).cast("binary").alias("hit"),
        F.array().cast("array<string>").alias("items"),
    )
    between = f"id {kind}, text string, hit binary, items array<string>"
    final = f"id {kind}, n_words long, n_hit long, items array<string>, spans array<struct<begin:long,end:long>>, sizes array<long>"
    for block, last in blocks_of(benchmark, item_column, "text"):
        shared = context.broadcast(block)
        marked = in_tasks(frame, _marks(shared, uuid.uuid4().hex, window, last), final if last else between)
        if not last:
            # Written, so that no more than one automaton is held at a time.
            marked = stored(docs.sparkSession, marked, "marked")
            shared.destroy()
            if frame is not read:
                drop(docs.sparkSession, frame)
        frame = marked
    return frame.withColumnRenamed("id", id_column)


#: The automaton that a process built last, by the name of its pass.
_AUTOMATA: dict[str, Automaton] = {}


def _marks(shared: Broadcast, name: str, window: int, last: bool) -> Callable:
    """A pass: adds the hits and items of one automaton to those of earlier passes; the last one sums up."""
    pair = pa.struct([("begin", pa.int64()), ("end", pa.int64())])

    def spans_of(edges: np.ndarray, found: Found) -> list[dict[str, int]]:
        return [
            {"begin": int(found.begins[a]), "end": int(found.ends[b - 1])}
            for a, b in zip(edges[::2], edges[1::2], strict=True)
        ]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[name] = Automaton(shared.value, window)
        automaton = _AUTOMATA[name]
        for batch in slices(batches, "text"):
            hits, items, spans, sizes = [], [], [], []
            before = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            for found, (mask, names) in zip(scan(automaton, batch.column(1)), before, strict=True):
                hit = found.hit if mask is None else found.hit | np.frombuffer(mask, bool)
                hits.append(hit)
                items.append(sorted({*names, *map(str, found.items)}))
                if last:
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
                    spans.append(spans_of(edges, found))
                    sizes.append((edges[1::2] - edges[::2]).tolist())
            listed = pa.array(items, pa.list_(pa.string()))
            if last:
                counts = [pa.array([f(h) for h in hits], pa.int64()) for f in (len, np.count_nonzero)]
                columns = [batch.column(0), *counts, listed, pa.array(spans, pa.list_(pair)), pa.array(sizes, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_hit", "items", "spans", "sizes"])
            else:
                columns = [batch.column(0), batch.column(1), pa.array([h.tobytes() for h in hits], pa.binary()), listed]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text", "hit", "items"])

    return run


def without_spans(text: str | None, spans: Sequence[tuple[int, int]]) -> str:
    """A text with its hit stretches cut out; the words around them stay apart."""
    raw, kept, at = (text or "").encode(), [], 0
    for begin, end in spans:
        kept.append(raw[at:begin])
        at = end
    return b"".join([*kept, raw[at:]]).decode()


def long_spans(words: int, spans: str = "spans", sizes: str = "sizes") -> Column:
    """Of the hit stretches those of more than ``words`` words."""
    return F.filter(F.arrays_zip(F.col(spans), F.col(sizes)), lambda both: both[sizes] > words)[spans]


def cut_out(text: Column, spans: Column) -> Column:
    """A text without the given stretches (begins and ends in its UTF-8 bytes, in order); the words around them stay apart."""
    raw = text.cast("binary")
    begins = F.concat(F.array(F.lit(0).cast("long")), spans["end"])
    ends = F.concat(spans["begin"], F.array(F.octet_length(text).cast("long")))
    pieces = F.zip_with(begins, ends, lambda a, b: F.substr(raw, (a + 1).cast("int"), (b - a).cast("int")))
    return F.aggregate(pieces, F.lit("").cast("binary"), lambda kept, piece: F.concat(kept, piece)).cast("string")


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    longest: int = 50,
    percent: int = 5,
    window: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """Per row of :func:`matches`: the id, ``text`` as it may be trained on, ``n_hit`` and ``n_cut``, the words taken out.

    Where the hit words are ``percent`` of all or more, every hit stretch is taken out; elsewhere those of more than
    ``longest`` words.  Other texts stay as they are, null ones null.  Rows may repeat and ids may be null.
    """
    marked = docs.select(F.struct(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).alias("row"))
    read = marked.select("row", F.col("row.text").alias("text"))
    found = matches(read, benchmark, window, "row", "text", item_column)
    taken = F.filter(F.arrays_zip("spans", "sizes"), lambda both: (both["sizes"] > longest) | is_contaminated(percent))
    cut = found.withColumn("taken", taken)
    text = F.when(F.size("taken") > 0, cut_out(F.col("row.text"), F.col("taken.spans"))).otherwise(F.col("row.text"))
    removed = F.aggregate(F.col("taken.sizes"), F.lit(0).cast("long"), lambda total, n: total + n)
    return cut.select(F.col("row.id").alias(id_column), text.alias(text_column), "n_hit", removed.alias("n_cut"))


def is_contaminated(percent: int = 5) -> Column:
    """Some word is hit, and the hit words are at least ``percent`` of all."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
