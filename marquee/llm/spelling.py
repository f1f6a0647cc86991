"""Words that are spelling variants of each other, found by asymmetric q-chunks.

Two words are near if one letter is put in, left out or replaced.  Of two near words the shorter one (of equally long
ones each) gives two chunks that do not overlap, its halves, and the other one its positional grams of that
length.  One edit can spoil one chunk only, so the other one is among the grams, at its own place or, if a letter was put in
before it, one further.  Words meet on a chunk, its place and the shorter word's length; what meets is verified.  Of the grams
within a shift of one only those are written that can lead to something new: the first chunk moved by one means
that the second is there too, and the second one unmoved that the first is.

A chunk that very many words hold is not compared word by word: the half that is not settled is cut into two chunks again, one of which
must be there, too, and so on down to a single letter, where only as many words meet as there are letters.

Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.storage import drop, stored
from marquee.operators.skew import spread_join

#: Words that are compared with each other on one chunk; chunks that more words hold are made longer.
GROUP = 400
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame, shortest: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id`` (text, a null one is empty) and ``run``: every maximal run of letters of at least ``shortest``, A to Z in lower case."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(f"([{LETTERS}]{{{shortest},}})"), 1)
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id")
    return docs.select(name, F.explode(found).alias("run")).withColumn("run", F.translate("run", _UPPER, _LOWER))


def with_slips(found: DataFrame, every: int) -> Column:
    """The run, without one of its letters where ``every`` divides the checksum of ``id:run``."""
    checksum = F.crc32(F.concat_ws(":", found["id"], found["run"]).cast("binary"))
    at = (checksum % F.char_length(found["run"])).cast("int")
    left = F.substring(found["run"], F.lit(1), at)
    return F.when(checksum % every == 0, F.concat(left, F.substr(found["run"], at + 2))).otherwise(found["run"])


def vocabulary(words: DataFrame, shortest: int, fewest: int) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``shortest`` code points that occur ``fewest`` times or more."""
    counted = words.where(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= fewest)


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the key: what of the word lies outside the unsettled letters ``low`` to ``high`` of the shorter word.

    ``more`` is 1 where the word is the longer one, which has a letter more there.
    """
    left = F.substring("word", F.lit(1), F.col("low"))
    right = F.substr("word", F.col("high") + F.col("more") + 1)
    return rows.withColumn("key", F.xxhash64("length", "low", "high", left, right))


def chunks(words: DataFrame) -> DataFrame:
    """For every word its chunks as the shorter or equally long one (``more`` 0) and its grams as the longer one (``more`` 1)."""
    size = F.char_length("word")

    def halves(length: Column, more: int) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        named = [F.lit(more).alias("more"), length.cast("int").alias("length")]
        first = F.struct(*named, half.alias("low"), length.cast("int").alias("high"))
        return [first, F.struct(*named, F.lit(0).alias("low"), half.alias("high"))]

    return _keyed(words.select("word", "n", F.inline(F.array(*halves(size, 0), *halves(size - 1, 1)))))


def longer_chunks(rows: DataFrame) -> DataFrame:
    """Rows of chunks that too many words hold, with one of two more chunks each."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    parts = F.array(F.struct(middle.alias("low"), F.col("high").alias("high")), F.struct(F.col("low").alias("low"), middle.alias("high")))
    return _keyed(rows.withColumn("part", F.explode(parts)).select("word", "n", "more", "length", "part.low", "part.high"))


#: Words of more letters are verified by where they first differ, as an edit distance takes the square of their length.
DISTANCE_LETTERS = 64


def one_edit(a: Column, b: Column, length: Column, more: Column) -> Column:
    """Whether ``a`` of that length becomes ``b`` (longer by ``more``, 0 or 1) by one edit."""

    def halved(state: Column, step: Column) -> Column:  # noqa: ARG001
        middle = F.floor((state["low"] + state["high"] + 1) / 2).cast("int")
        alike = F.substring(a, F.lit(1), middle) == F.substring(b, F.lit(1), middle)
        return F.when(alike, F.struct(middle.alias("low"), state["high"].alias("high"))).otherwise(
            F.struct(state["low"].alias("low"), F.greatest(state["low"], middle - 1).alias("high"))
        )

    # The letters that both begin with, by halving.
    begun = F.struct(F.lit(0).alias("low"), length.cast("int").alias("high"))
    same = F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(length.cast("double") + 1)).cast("int")), begun, halved, lambda s: s["low"])
    rest = F.substr(a, same + F.when(more == 1, 1).otherwise(2)) == F.substr(b, same + 2)
    return F.when(length <= DISTANCE_LETTERS, F.levenshtein(a, b, 1) == 1).otherwise(rest)


def near_words(spark: SparkSession, words: DataFrame, group: int = GROUP) -> DataFrame:
    """``a, n_a, b, n_b`` for any two near words, once; ``words`` has distinct ``word`` and ``n``.

    Words of one letter and empty ones are taken, too; null words are not.
    """
    level = chunks(words.where("word IS NOT NULL"))
    found = None
    while True:
        sizes = level.groupBy("key").agg(F.count("*").alias("size"))
        level = stored(spark, spread_join(level, sizes, "key", ["word"]), "chunks")
        # A single unsettled letter: only true neighbours meet, as many as there are letters.
        small = (F.col("size") <= group) | (F.col("high") - F.col("low") <= 1)
        some = level.where(small)
        shorter = some.where("more = 0").select("key", "length", F.col("word").alias("a"), F.col("n").alias("n_a"))
        other = some.select("key", "more", F.col("word").alias("b"), F.col("n").alias("n_b"))
        near = (F.col("more") == 1) | (F.col("a") < F.col("b"))
        # Keys are hashes, so lengths are compared, too.
        fits = F.char_length("b") == F.col("length") + F.col("more")
        verified = one_edit(F.col("a"), F.col("b"), F.col("length"), F.col("more"))
        pairs = shorter.join(other, "key").where(near & fits & verified).select("a", "n_a", "b", "n_b")
        found = pairs if found is None else found.unionByName(pairs)
        large = level.where(~small)
        if large.isEmpty():
            return found.distinct()
        level = longer_chunks(large)


def variants(spark: SparkSession, words: DataFrame, times: int = 5, group: int = GROUP) -> DataFrame:
    """Per word: ``form, root, n, n_near, form_n``.

    ``words`` has distinct ``word`` and its ``n``.  A word's form is its most frequent near word (of equally frequent ones the first in
    code-point order) if that occurs at least ``times`` as often, ``root`` where the chain of forms ends; ``times`` is at least 2,
    so that a form is more frequent and no chain is a circle.  Without a form, ``form`` and ``form_n`` are null and the
    root is the word itself.  An empty table gives no rows.
    """
    pairs = near_words(spark, words, group)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    # A word has no more near words than its length and the letters allow.
    best = both.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word"))).alias("best")
    )
    enough = -F.col("best.less") >= times * F.col("n")
    formed = words.where("word IS NOT NULL").join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.word")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(spark, formed, "forms")
    steps = stored(spark, formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "steps")
    # Each round doubles how far a word looks along its chain, whose counts grow ``times``-fold at each step.
    while not steps.where("moved").isEmpty():
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        far = stored(spark, far, "steps")
        drop(spark, steps)
        steps = far
    return formed.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    spark: SparkSession,
    docs: DataFrame,
    shortest: int = 6,
    fewest: int = 5,
    times: int = 5,
    slips: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    group: int = GROUP,
) -> DataFrame:
    """Per word of at least ``shortest`` letters that occurs ``fewest`` times in all texts: see :func:`variants`.

    Words are maximal runs of Latin letters, A to Z in lower case.  With ``slips``, about one run in so many loses
    a letter, chosen by a checksum of document id and run; a null id reads as an empty one.  A null or empty text has
    no words; texts may be of any length, and rows that repeat count again.  Other columns are left out.
    """
    found = runs(docs, shortest, id_column, text_column)
    words = found.select((with_slips(found, slips) if slips else F.col("run")).alias("word"))
    return variants(spark, stored(spark, vocabulary(words, shortest, fewest), "vocabulary"), times, group)
