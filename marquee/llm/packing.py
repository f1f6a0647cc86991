"""Best-fit packing of documents into token sequences, planned on the histogram of lengths.

Linear grouping: large lengths are split into groups of equal cardinality and rounded up
to the longest of their group.  With so few sizes the best mix of configurations (how
many of each size share a sequence) is a small linear programme, solved by column
generation.  The actual documents then take the places of the rounded ones, and small
ones fill what is left, each length into the tightest gap it fits.

The plan is made on counts per length, so its size depends on the capacity and not on the
documents; every document finds its place by its length and its number among the
documents of that length.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marquee.llm.batches import slices
from marquee.llm.numbering import numbered
from marquee.llm.shipping import in_tasks
from marquee.llm.storage import stored


#: Room that a configuration may leave if its documents are to stay together.
ROOMS = (64, 32, 16, 8, 4, 2, 0)


class Entry(NamedTuple):
    """Documents ``first`` to ``first + count - 1`` of a length, ``each`` to a sequence, from ``sequence`` on."""

    length: int
    first: int
    count: int
    each: int
    sequence: int
    offset: int


def _best_configuration(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The configuration of most value: a knapsack, one more item in each step."""
    best, steps = np.zeros(capacity + 1), []
    for _ in range(capacity // int(sizes.min())):
        grid = np.full((len(sizes), capacity + 1), -1.0)
        for k, size in enumerate(sizes):
            grid[k, size:] = best[: capacity + 1 - size] + value[k]
        chosen = grid.argmax(axis=0)
        reached = grid[chosen, np.arange(capacity + 1)]
        better = reached > best + 1e-12
        steps.append(np.where(better, chosen, -1))
        best = np.where(better, reached, best)
    count, room = np.zeros(len(sizes), np.int64), capacity
    for chosen in reversed(steps):
        if chosen[room] >= 0:
            count[chosen[room]] += 1
            room -= int(sizes[chosen[room]])
    return count, float(value @ count)


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 2000) -> list[tuple[list[int], float]]:
    """Configurations and how often to use each, so that few sequences hold the demand."""
    size, wanted = np.array(sizes), np.array(demand, dtype=float)
    base = np.diag(capacity // size).astype(float)
    used = np.linalg.solve(base, wanted)
    for _ in range(rounds):
        prices = np.linalg.solve(base.T, np.ones(len(size)))
        column, worth = _best_configuration(size, np.maximum(prices, 0), capacity)
        if worth <= 1 + 1e-7:
            break
        change = np.linalg.solve(base, column.astype(float))
        able = change > 1e-9
        ratio = np.where(able, used / np.where(able, change, 1), np.inf)
        out = int(ratio.argmin())
        base[:, out] = column
        used = np.maximum(np.linalg.solve(base, wanted), 0)
    return [([int(c) for c in base[:, j]], float(used[j])) for j in range(len(size))]


def _groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Groups of equal cardinality, longest first: the rounded size and its [length, first, count]."""
    total, made, filled, taken = sum(counts.values()), [], 0, 0
    ends = [total * (g + 1) // groups for g in range(groups)]
    for length in sorted(counts, reverse=True):
        left, first = counts[length], 0
        while left:
            while filled >= ends[taken]:
                taken += 1
            part = min(left, ends[taken] - filled)
            if made and made[-1][2] == taken:
                made[-1][1].append([length, first, part])
            else:
                made.append((length, [[length, first, part]], taken))
            filled, first, left = filled + part, first + part, left - part
    merged: list[tuple[int, list[list[int]]]] = []
    for size, parts, _ in made:  # a frequent length can fill several groups
        if merged and merged[-1][0] == size:
            merged[-1][1].extend(parts)
        else:
            merged.append((size, parts))
    return merged


def _take(parts: list[list[int]], count: int) -> list[tuple[int, int, int]]:
    """The next ``count`` documents of a group, as (length, first, count); fewer if it has fewer."""
    taken = []
    while count and parts:
        length, first, here = parts[0]
        now = min(count, here)
        taken.append((length, first, now))
        count -= now
        if now == here:
            parts.pop(0)
        else:
            parts[0] = [length, first + now, here - now]
    return taken


def plan(counts: dict[int, int], capacity: int, groups: int = 128, small: int | None = None) -> tuple[list[Entry], int]:
    """Places for all documents of a histogram of lengths, and the number of sequences.

    Lengths above ``small`` (a quarter of the capacity by default) go through linear grouping.  A
    configuration is made for rounded lengths; where the actual documents leave more than some room in
    it, they are taken out again and best-fit with the small ones.  How much room that is, is
    tried out, from any to none.
    """
    if any(not 0 < length <= capacity for length in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    small = capacity // 4 if small is None else small
    # Sequences alike: how many, and per length the first document, how many in each.
    alike: list[tuple[int, list[tuple[int, int, int]]]] = []
    rest: dict[int, list[list[int]]] = defaultdict(list)
    for length, count in counts.items():
        if length == capacity:
            alike.append((count, [(length, 0, 1)]))
        elif length <= small:
            rest[length].append([length, 0, count])
    large = {x: n for x, n in counts.items() if small < x < capacity and n}
    grouped = _groups(large, min(groups, sum(large.values()))) if large else []
    if grouped:
        sizes = [size for size, _ in grouped]
        mix = configurations(sizes, [sum(p[2] for p in parts) for _, parts in grouped], capacity)
        for column, often in mix:
            bins = int(often + 1e-9)
            slots = [_take(grouped[k][1], bins) for k, many in enumerate(column) for _ in range(many)]
            if bins and slots:
                cuts = sorted({0, bins, *(int(c) for s in slots for c in np.cumsum([part[2] for part in s]))})
                for begin, end in zip(cuts, cuts[1:], strict=False):
                    inside = []
                    for slot in slots:
                        at = 0
                        for length, first, count in slot:
                            if at <= begin < at + count:
                                inside.append((length, first + begin - at, 1))
                            at += count
                    if inside:
                        alike.append((end - begin, inside))
        for _, parts in grouped:
            for part in parts:
                rest[part[0]].append(part)
    tried = [_best_fit(alike, rest, capacity, room) for room in (capacity, *ROOMS, -1)]
    gaps = min(tried, key=lambda made: sum(bins for runs in made.values() for bins, _ in runs))
    entries, sequence = [], 0
    for runs in gaps.values():
        for bins, inside in runs:
            offset = 0
            for length, first, each in inside:
                entries.append(Entry(length, first, bins * each, each, sequence, offset))
                offset += length * each
            sequence += bins
    return entries, sequence


def _best_fit(alike: list, rest: dict, capacity: int, room: int) -> dict[int, list]:
    """Runs of like sequences by the room left in them; of ``alike``, those stay that leave at most ``room``."""
    gaps: dict[int, list[tuple[int, list[tuple[int, int, int]]]]] = defaultdict(list)
    left = defaultdict(list, {length: list(parts) for length, parts in rest.items()})
    for bins, inside in alike:
        gap = capacity - sum(length * each for length, _, each in inside)
        if gap <= room or gap == 0:
            gaps[gap].append((bins, inside))
        else:
            for length, first, each in inside:
                left[length].append([length, first, bins * each])
    for length in sorted(left, reverse=True):
        for _, first, count in left[length]:
            _fill(gaps, capacity, length, first, count)
    return gaps


def _fill(gaps: dict, capacity: int, length: int, first: int, count: int) -> None:
    """Best fit of ``count`` documents of a length; ``gaps`` has runs of like sequences by the room left."""
    for room in sorted(r for r in gaps if r >= length):
        each = room // length
        waiting = gaps.pop(room)
        while waiting and count:
            bins, inside = waiting.pop()
            full = min(bins, count // each)
            for now, many in ((full, each), (min(1, bins - full) if count > full * each else 0, count - full * each)):
                many = min(many, each)
                if now and many and count:
                    gaps[room - many * length].append((now, [*inside, (length, first, many)]))
                    inside = [(x, f + now * e, e) for x, f, e in inside]
                    first, count, bins = first + now * many, count - now * many, bins - now
            if bins:
                waiting.append((bins, inside))
        if waiting:
            gaps[room] = waiting
        if not count:
            return
    each = capacity // length
    for bins, many in ((count // each, each), (1, count % each)):
        if bins and many:
            gaps[capacity - many * length].append((bins, [(length, first, many)]))
            first += bins * many


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers.

    The ranks are the vocabulary of the tokenizer file.  A text that holds an added token of the
    tokenizer is left to the tokenizer itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str) -> None:
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.asarray(self.plain.encode_to_numpy(text), "<u4").tobytes()


_ENCODERS: dict[tuple[str, str, str], Encoder] = {}


def encoder(tokenizer: str, ranks: str, pattern: str) -> Encoder:
    """One per process and vocabulary."""
    key = (tokenizer, ranks, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def cut(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    capacity: int,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    Every document ends in ``end_id``; a null or empty text is that id alone.  If a
    document is longer than the capacity, its first piece is the shorter one.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, ranks, pattern).ids
        end = np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text", 1 << 22):
            rows, of = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                count, start, piece = len(ids) // 4, 0, 0
                while start < count:
                    length = (count - start - 1) % capacity + 1
                    part = ids[4 * start : 4 * (start + length)]
                    rows.append((piece, start, length, zlib.crc32(part)))
                    of.append(k)
                    start, piece = start + length, piece + 1
            columns = [batch.column(0).take(pa.array(of))]
            columns += [
                pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.int64()] * 3), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids_crc32"])

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return in_tasks(read, pieces, f"id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int, groups: int = 128) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces that have ``length``; offsets have no gaps.

    Of the data, only the histogram of lengths (at most ``capacity`` rows) reaches the driver.
    Equal rows are packed one by one; an empty table gives an empty one.
    """
    order = [c for c in pieces.columns if c != "length"]
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    entries, _ = plan(histogram, capacity, groups)
    table = np.array(sorted(entries), dtype=np.int64).reshape(-1, 6)
    # Its rows follow from the capacity and the groups, not from the number of pieces.
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    ranked = numbered(pieces, "length", order, "_rank")
    at = [ranked.columns.index(c) for c in ("length", "_rank")]
    kept = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = shared.value
        keys = (entry[:, 0] << 48) + entry[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (np.asarray(batch.column(k)).astype(np.int64) for k in at)
            found = entry[np.searchsorted(keys, (length << 48) + rank, side="right") - 1]
            behind = rank - found[:, 1]
            sequence = found[:, 4] + behind // found[:, 3]
            offset = found[:, 5] + behind % found[:, 3] * length
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in kept)
    return in_tasks(ranked, place, schema + ", sequence_id long, offset long")


def pack_documents(
    spark: SparkSession,
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    capacity: int = 1024,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens; one row per piece.

    The texts are encoded once: the pieces, without their ids, are written to the shared folder.  A null or empty text is a
    piece of the end token alone.  Ids may be null or repeated: every row is packed.  Texts of any length are cut into pieces
    of ``capacity`` tokens, of which the first may be shorter.  No documents give no rows, and other columns are left out.
    """
    made = cut(docs, tokenizer, ranks, pattern, capacity, end_id, id_column, text_column)
    pieces = stored(spark, made, "pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_column)
