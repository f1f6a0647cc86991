"""Language of a text by Bloom filters of n-grams whose slots hold one bit per language.

An n-gram is four bytes of the folded text, where everything but letters is one space.  Each
language's n-grams are put into a Bloom filter; the filters of all languages lie side by side, so
that one look-up returns the set of languages that have an n-gram.  Per language the text's
n-grams found are counted, the share that a filter reports by chance is taken off, and the
highest count decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.batches import buffer_of, slices
from marquee.llm.shipping import in_tasks
from marquee.llm.storage import stored

UNKNOWN = "und"
WIDTH = 4
#: Fixed odd multipliers, one for each hash function of the filters.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B)


def folded(text: Column) -> Column:
    """Lower case between spaces; null is empty."""
    return F.concat(F.lit(" "), F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(" "))


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of folded texts on end, and where those of each text begin (one more entry than texts)."""
    raw, starts = buffer_of(texts)
    letter = np.zeros(256, bool)
    letter[97:123] = letter[128:] = True
    space = ~letter[raw]
    kept = ~space
    kept[1:] |= ~space[:-1]  # of spaces in a row, the first
    first = starts[:-1][np.diff(starts) > 0]
    kept[first] = True
    line = np.where(space, np.uint8(32), raw)[kept].astype(np.uint32)
    bounds = np.concatenate([[0], np.cumsum(kept)])[starts]
    if len(line) < WIDTH:
        return np.zeros(0, np.uint32), np.zeros(len(starts), np.int64)
    every = line[:-3] | line[1:-2] << np.uint32(8) | line[2:-1] << np.uint32(16) | line[3:] << np.uint32(24)
    whole = np.ones(len(line), bool)
    for back in range(1, WIDTH):  # those that would reach into the next text
        whole[np.maximum(bounds[1:] - back, bounds[:-1])[np.diff(bounds) > 0]] = False
        whole[len(line) - back] = False
    for k in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < WIDTH)):
        whole[bounds[k] : bounds[k + 1]] = False
    return every[whole[: len(every)]], np.concatenate([[0], np.cumsum(whole)])[bounds]


@dataclass(frozen=True)
class Filters:
    """The filters of all languages: one table per 64 of them, and their false-positive rates."""

    languages: list[str]
    bits: int
    tables: list[np.ndarray]
    false_rate: np.ndarray

    def slots(self, grams: np.ndarray) -> Iterator[np.ndarray]:
        for factor in MULTIPLIERS:
            yield (grams * np.uint32(factor)) >> np.uint32(32 - self.bits)

    def counts(self, grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Per text and language the n-grams found, less those expected by chance."""
        total = np.diff(bounds).astype(float)
        found = np.zeros((len(total), len(self.languages)))
        some = np.flatnonzero(total)
        for number, table in enumerate(self.tables):
            sets = None
            for slot in self.slots(grams):
                sets = table[slot] if sets is None else sets & table[slot]
            for bit in range(min(64, len(self.languages) - 64 * number)):
                member = (sets >> sets.dtype.type(bit)) & sets.dtype.type(1)
                if len(some):
                    found[some, 64 * number + bit] = np.add.reduceat(member.astype(np.int64), bounds[some])
        return np.maximum(0, (found - total[:, None] * self.false_rate) / (1 - self.false_rate))


def gram_counts(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``lang``, ``gram`` and ``n`` over all rows with a language; a task sends each n-gram once per language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            gram, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return gram, np.bincount(back, np.concatenate([n for _, n in parts])).astype(np.int64)

        for batch in slices(batches, "text"):
            grams, bounds = grams_of(batch.column(1))
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            of = np.repeat(langs, np.diff(bounds))
            for lang in set(langs):
                gram, n = np.unique(grams[of == lang], return_counts=True)
                parts = held.setdefault(lang, [])
                parts.append((gram, n))
                if len(parts) > 30:
                    held[lang] = [joined(parts)]
        for lang, parts in held.items():
            gram, n = joined(parts)
            columns = [pa.array([lang] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    read = docs.where(F.col(lang_column).isNotNull()).select(
        F.col(lang_column).cast("string").alias("lang"), folded(F.col(text_column)).alias("text")
    )
    return in_tasks(read, count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def least_counts(counts: DataFrame, most: int) -> DataFrame:
    """Per language the ``total`` of its counts and the ``least`` count that its ``most`` most frequent n-grams have.

    Of equally frequent n-grams all or none are among them; ``least`` is null if already the first ones are too many.
    N-grams are counted per count, those per band of counts, and only the band in which the limit lies is put in order.
    """
    band = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int").alias("band")
    levels = counts.groupBy("lang", "n").agg(F.count("*").alias("grams")).select("lang", "n", "grams", band)
    bands = levels.groupBy("lang", "band").agg(F.sum("grams").alias("grams"))
    falling = Window.partitionBy("lang").orderBy(F.desc("band"))
    reached = bands.withColumn("reached", F.sum("grams").over(falling)).where(F.col("reached") > most)
    # One row per language on the right.
    edge = reached.groupBy("lang").agg(F.max(F.struct(F.col("band").alias("edge"), (F.col("reached") - F.col("grams")).alias("before"))).alias("e"))
    known = levels.join(F.broadcast(edge.select("lang", "e.*")), "lang", "left")
    above = F.min(F.when(F.col("edge").isNull() | (F.col("band") > F.col("edge")), F.col("n"))).alias("above")
    whole = known.groupBy("lang").agg(F.sum(F.col("n") * F.col("grams")).alias("total"), above)
    inside = Window.partitionBy("lang").orderBy(F.desc("n"))
    fine = known.where("band = edge").withColumn("reached", F.col("before") + F.sum("grams").over(inside))
    last = fine.where(F.col("reached") <= most).groupBy("lang").agg(F.min("n").alias("last"))
    return whole.join(F.broadcast(last), "lang", "left").select("lang", "total", F.coalesce("last", "above").alias("least"))


def fit(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    most: int = 32_768,
    share: float = 0.1,
    bits: int = 20,
) -> Filters:
    """Filters learned from all rows that have a language.

    A language's filter takes its ``most`` most frequent n-grams, or fewer, since of equally frequent ones
    all or none are taken, and of these the ones that are not rarer in it than ``share`` of their frequency
    where they are most frequent.  ``most`` bounds what reaches the driver, ``bits`` the size of a filter.
    Without any labelled row there are no languages.
    """
    counts = stored(docs.sparkSession, gram_counts(docs, text_column, lang_column), "gram-counts")
    cuts = least_counts(counts, most)
    best = counts.join(F.broadcast(cuts), "lang").where(F.col("n") >= F.col("least"))
    rows = best.select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    table = rows.toArrow()
    names = table["lang"].to_pylist()
    languages = sorted(set(names))
    gram, back = np.unique(np.asarray(table["gram"]).astype(np.uint32), return_inverse=True)
    number = np.searchsorted(np.array(languages, dtype=object), np.array(names, dtype=object)) if languages else []
    rate = np.zeros((len(gram), len(languages)))
    if languages:
        rate[back, number] = np.asarray(table["share"])
    member = (rate > 0) & (rate >= share * rate.max(axis=1, initial=0)[:, None])
    made = Filters(languages, bits, [], np.zeros(len(languages)))
    filled = np.zeros(len(languages))
    for begin in range(0, len(languages), 64):
        here = min(64, len(languages) - begin)
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if here <= 8 * np.dtype(t).itemsize)
        slots = np.zeros(1 << bits, kind)
        for bit in range(here):
            own = gram[member[:, begin + bit]]
            for slot in made.slots(own):
                slots[slot] |= kind(1 << bit)
            filled[begin + bit] = np.count_nonzero(slots & kind(1 << bit)) / len(slots)
        made.tables.append(slots)
    # By chance an n-gram has all its slots set.
    return Filters(languages, bits, made.tables, filled ** len(MULTIPLIERS))


def predict(docs: DataFrame, filters: Filters, text_column: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (from 0 to 1) after them.

    A null text, or one without letters, is ``und`` with score 0, as is any text if no language was
    learned.  A text of which no language has an n-gram gets the first language, with score 0; equal counts
    go to the first by name.  The score is the share of the text's n-grams that the language has,
    less what chance gives.  Columns of those two names are replaced.
    """
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    names = [f"c{k}" for k in range(len(columns))]

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = shared.value
        for batch in slices(batches, "_folded"):
            place = batch.schema.get_field_index("_folded")
            grams, bounds = grams_of(batch.column(place))
            counts = filters.counts(grams, bounds)
            letters = np.asarray(batch.column(place + 1).to_pylist(), dtype=bool)
            if filters.languages:
                best = counts.argmax(axis=1)
                score = counts[np.arange(len(best)), best] / np.maximum(1, np.diff(bounds))
                named = [filters.languages[b] if good else UNKNOWN for b, good in zip(best, letters, strict=True)]
                score = np.where(letters, np.minimum(1.0, score), 0.0)
            else:
                named, score = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            kept = [batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(named, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    text = F.col(text_column).cast("string")
    read = docs.select(
        *(docs[c].alias(n) for c, n in zip(columns, names, strict=True)),
        folded(text).alias("_folded"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_letters"),
    )
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(columns, names, strict=True))
    made = in_tasks(read, decide, f"{schema + ', ' if schema else ''}lang_pred string, score double")
    return made.toDF(*columns, "lang_pred", "score")
