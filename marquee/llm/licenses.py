"""Licence notices in texts, by a trained classifier of paragraphs that templates confirm.

A paragraph's words and pairs of words are hashed into a sparse vector; a logistic regression tells
the licence family, or that it is none.  What it must be sure of is calibrated on paragraphs kept out of
training: no more than a small share of those without a licence may pass.  A family is only reported if the
paragraph also holds enough of the word pairs of one of its templates.

A paragraph is a line.  A notice may be wrapped over lines or stand in a long one, so the stretches of a template's
length around its telling word pairs are classified as well, across the lines between two blank ones.

Everything is DataFrame functions and Spark's own transformers; no Python runs on rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable
from functools import reduce
from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.sampling import hashed_sample
from marquee.llm.storage import stored

NONE = "none"
#: Well-known notices by family.
TEMPLATES = {
    "agpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license",
        "licensed under the gnu affero general public license version 3",
        "spdx license identifier agpl 3 0 or later",
    ],
    "apache": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
        "spdx license identifier apache 2 0",
    ],
    "bsd": [
        "released under the bsd license",
        "licensed under the bsd 3 clause license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products",
        "spdx license identifier bsd 3 clause",
    ],
    "cc-by": [
        "licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ],
    "cc-by-nc": [
        "licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "cc0": [
        "released under cc0 1 0 universal public domain dedication",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    ],
    "gpl": [
        "this work is licensed under the gnu general public license version 3",
        "released under the gnu general public license version 2",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "spdx license identifier gpl 3 0 or later",
    ],
    "isc": [
        "released under the isc license",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "lgpl": [
        "licensed under the gnu lesser general public license version 3",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license",
    ],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        "spdx license identifier mit",
    ],
    "mpl": [
        "licensed under the mozilla public license version 2 0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ],
    "proprietary": [
        "copyright all rights reserved",
        "all rights reserved no part of this work may be reproduced without the prior written permission of the copyright holder",
        "proprietary and confidential unauthorized copying of this file is strictly prohibited",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
}
#: Hashed features, copies of each template to train on, and paragraphs without a licence to train on.
FEATURES, COPIES, NEGATIVES = 1 << 12, 60, 4000


_LETTER = r"[\p{L}\p{N}]"


def words_of(text: Column) -> Column:
    """The words of a paragraph in lower case: letters and digits of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{_LETTER}+"), 0)


def pairs_of(words: Column) -> Column:
    """Distinct pairs of consecutive words."""
    later = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    sized = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_distinct(F.zip_with(sized, later, lambda a, b: F.concat_ws(" ", a, b)))


def paragraphs(docs: DataFrame) -> DataFrame:
    """Every paragraph (a line that holds a word) of ``text`` with its ``place`` from 0 and its ``words``."""
    kept = [c for c in docs.columns if c != "text"]
    lines = docs.select(*kept, F.posexplode(F.split("text", r"\R")).alias("place", "line"))
    return lines.where(F.col("line").rlike(_LETTER)).withColumn("words", words_of(F.col("line")))


#: Words that say little about a notice.
_COMMON = frozenset("a an and any as at be by for from in is it no not of on or that the this to under with you".split())
#: Two line breaks with no word between them.
_GAP = r"(?>\R)[^\p{L}\p{N}\x{0A}-\x{0D}\x{85}\x{2028}\x{2029}]*+(?>\R)"


def telling_pairs(share: float) -> dict[str, list[tuple[str, int, int]]]:
    """Word pairs, each with the family, its place and the number of words of the templates it tells of.

    So many per template that none is without one if ``share`` of its distinct pairs are there.
    """
    notices = [(family, notice.split()) for family in sorted(TEMPLATES) for notice in TEMPLATES[family]]
    paired = [(family, words, list(zip(words, words[1:], strict=False))) for family, words in notices]
    often = Counter(pair for _, _, pairs in paired for pair in set(pairs))
    told: dict[str, list[tuple[str, int, int]]] = {}
    for family, words, pairs in paired:
        ranked = sorted(set(pairs), key=lambda p: (sum(w in _COMMON for w in p), often[p], p))
        for pair in ranked[: len(ranked) - ceil(share * len(ranked) - 1e-9) + 1]:
            told.setdefault(" ".join(pair), []).extend((family, k, len(words)) for k, p in enumerate(pairs) if p == pair)
    return told


def _any_of(pairs: Iterable[str]) -> str:
    """A pattern of the given word pairs that tells them apart letter by letter, so that few are tried at a place."""
    tree: dict[str, dict] = {}
    for pair in pairs:
        node = tree
        for letter in pair:
            node = node.setdefault(letter, {})
        node[""] = {}

    def written(node: dict[str, dict]) -> str:
        if "" in node:
            return ""
        branches = [(r"[^\p{L}\p{N}]++" if letter == " " else letter) + written(below) for letter, below in sorted(node.items())]
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"

    return written(tree)


def _placed(parts: DataFrame, share: float) -> DataFrame:
    """Adds ``all``, the words of ``part``, and ``placed``, the same with their ``line``, if a telling word pair is there; else both are null."""
    told = F.lower("part").rlike(r"(?<![\p{L}\p{N}])" + _any_of(telling_pairs(share)))
    lines = F.transform(F.split("part", r"\R"), lambda line, at: F.transform(words_of(line), lambda w: F.struct(at.alias("line"), w.alias("word"))))
    return parts.withColumn("placed", F.when(told, F.flatten(lines))).withColumn("all", F.col("placed.word"))


def _lines() -> Column:
    """The lines of a part, as structs of what :func:`_stretches` has."""
    return F.transform(
        F.split("part", r"\R"),
        lambda line, at: F.struct(
            F.lit(None).cast("string").alias("asked"), at.alias("first"), at.alias("last"), line.alias("piece"), F.lit(1).alias("line")
        ),
    )


def _stretches(placed: DataFrame, share: float) -> DataFrame:
    """Adds ``cuts``: the stretches that a template may fill, with its family as ``asked``, their ``first`` and ``last`` line and their
    words as ``piece``, with some more on both sides: a quarter of the template's words, since words may have been put in."""
    told = telling_pairs(share)
    # The functions of elements below read nothing but these: what they read of the row is made anew for each.
    later = F.slice("all", 2, F.size("all") - 1)
    paired = F.transform(
        F.zip_with(F.slice("all", 1, F.size("all") - 1), later, lambda a, b: F.concat_ws(" ", a, b)),
        lambda p, k: F.struct(p.alias("pair"), k.alias("at")),
    )
    templates = F.create_map(
        *(
            x
            for name, found in sorted(told.items())
            for x in (F.lit(name), F.array(*(F.struct(F.lit(f).alias("family"), F.lit(k).alias("k"), F.lit(n).alias("n")) for f, k, n in found)))
        )
    )

    def around(hit: Column) -> Column:
        return F.transform(
            F.element_at(templates, hit["pair"]),
            lambda t: F.struct(t["family"].alias("family"), (hit["at"] - t["k"]).alias("begin"), t["n"].alias("n")),
        )

    def cut(found: Column) -> Column:
        more = F.floor(found["n"] / 4).cast("int")
        begin = F.greatest(F.lit(0), found["begin"] - more)
        return F.struct(
            found["family"].alias("asked"),
            F.get("placed", F.greatest(F.lit(0), found["begin"]))["line"].alias("first"),
            F.get("placed", F.least(F.size("all"), found["begin"] + found["n"]) - 1)["line"].alias("last"),
            F.array_join(F.slice("all", begin + 1, found["begin"] + found["n"] + more - begin), " ").alias("piece"),
            F.lit(0).alias("line"),
        )

    hits = F.when(F.size("all") > 1, F.filter(paired, lambda p: p["pair"].isin(sorted(told))))
    found = placed.withColumn("found", F.array_distinct(F.flatten(F.transform(hits, around))))
    return found.withColumn("cuts", F.coalesce(F.transform("found", cut), F.array()))


def _examples(spark: SparkSession, plain: DataFrame) -> DataFrame:
    """``family`` and ``words`` to train on: templates with words lost and others around them, and plain paragraphs."""
    rows = [(family, notice) for family, notices in sorted(TEMPLATES.items()) for notice in notices]
    notices = F.array(*(F.struct(F.lit(f).alias("family"), F.lit(n).alias("notice")) for f, n in rows))
    listed = spark.range(0, 1, 1, 1).select(F.inline(notices))
    numbered = plain.withColumn("number", F.pmod(F.xxhash64("words"), F.lit(len(rows) * COPIES)))
    around = numbered.groupBy("number").agg(F.min("words").alias("other"))
    copies = listed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    copies = copies.withColumn("number", F.pmod(F.xxhash64("notice", "copy"), F.lit(len(rows) * COPIES)))
    whole = F.split("notice", " ")
    lost = 12  # of a hundred words
    told = F.filter(whole, lambda w, at: (F.col("copy") == 0) | (F.pmod(F.xxhash64("notice", "copy", w, at), F.lit(100)) >= lost))
    other = F.coalesce("other", F.array().cast("array<string>"))
    side = F.pmod(F.col("copy"), F.lit(4))
    noisy = (
        F.when(side == 1, F.concat(F.slice(other, 1, 6), told))
        .when(side == 2, F.concat(told, F.slice(other, 1, 10)))
        .when(side == 3, F.concat(F.slice(other, 1, 4), told, F.slice(other, 5, 6)))
        .otherwise(told)
    )
    positive = copies.join(around, "number", "left").select("family", noisy.alias("words"))
    # Words of notices that do not make one: every third word, in reverse.
    loose = F.reverse(F.filter(whole, lambda w, at: F.pmod(at + F.col("copy"), F.lit(3)) == 0))
    scattered = copies.where("copy % 6 = 1").join(around, "number", "left").select(
        F.lit(NONE).alias("family"), F.concat(F.slice(other, 1, 8), loose, F.slice(other, 9, 8)).alias("words")
    )
    return positive.unionByName(scattered).unionByName(plain.select(F.lit(NONE).alias("family"), "words"))


class LicenceModel:
    """A fitted classifier, the probability that a family must reach, and the templates' word pairs."""

    def __init__(self, stages: PipelineModel, families: list[str], least: float, share: float) -> None:
        self.stages, self.families, self.least, self.share = stages, families, least, share

    def predict(self, frame: DataFrame) -> DataFrame:
        """Adds ``guess`` and ``probability`` to rows that have ``words``."""
        scored = self.stages.transform(frame).withColumn("_odds", vector_to_array("probability")).drop("probability")
        best = F.array_max("_odds")
        names = F.array(*map(F.lit, self.families))
        guess = F.get(names, (F.array_position("_odds", best) - 1).cast("int"))
        return scored.select(*frame.columns, guess.alias("guess"), best.alias("probability"))

    def confirmed(self, frame: DataFrame) -> DataFrame:
        """Adds ``family``: the guess where it is sure enough and a template of it is there, else ``none``."""
        def held(notice: str) -> Column:
            own = sorted({f"{a} {b}" for a, b in zip(notice.split(), notice.split()[1:], strict=False)})
            return F.size(F.array_intersect("_pairs", F.array(*map(F.lit, own)))) / F.lit(float(len(own)))

        matched = reduce(
            lambda so_far, family: so_far.when(F.col("guess") == family, F.greatest(F.lit(0.0), *map(held, TEMPLATES[family]))),
            sorted(TEMPLATES),
            F.when(F.col("guess") == NONE, F.lit(0.0)),
        )
        sure = (F.col("probability") >= self.least) & (F.col("matched") >= self.share)
        # Pairs of what is none are not made.
        paired = frame.withColumn("_pairs", F.when(F.col("guess") != NONE, pairs_of(F.col("words"))))
        return paired.withColumn("matched", matched).drop("_pairs").withColumn("family", F.when(sure, F.col("guess")).otherwise(NONE))


def fit(spark: SparkSession, docs: DataFrame, passing: float = 0.005, share: float = 0.6) -> LicenceModel:
    """A classifier trained on notices, with at most ``NEGATIVES`` paragraphs of ``docs`` as what is none.

    Those are paragraphs of as many documents, chosen by a hash, and hold no three words of a template in a row.
    A fifth of all examples is kept out to calibrate: at most ``passing`` of those that are none may reach the probability
    that is asked for.  ``share`` is how many of a template's word pairs a notice must hold.
    """
    families = [NONE, *sorted(TEMPLATES)]
    threes = sorted({" ".join(w[k : k + 3]) for ns in TEMPLATES.values() for n in ns for w in [n.split()] for k in range(len(w) - 2)})
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    quiet = ~spaced.rlike(" (?:" + "|".join(threes) + ") ")
    some = paragraphs(hashed_sample(docs, docs.columns, NEGATIVES)).select("words", F.xxhash64("words").alias("order"))
    plain = some.orderBy("order", "words").limit(NEGATIVES)
    plain = stored(spark, plain.where(quiet).select("words"), "plain")
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    examples = _examples(spark, plain).withColumn("label", label.cast("double"))
    examples = examples.withColumn("kept_out", F.pmod(F.xxhash64("words", "family"), F.lit(5)) == 0)
    # A few thousand rows, read in each step of the training.
    examples = stored(spark, examples.coalesce(2), "examples")
    stages = Pipeline(
        stages=[
            NGram(n=2, inputCol="words", outputCol="_pairs"),
            HashingTF(numFeatures=FEATURES, binary=True, inputCol="words", outputCol="_one"),
            HashingTF(numFeatures=FEATURES, binary=True, inputCol="_pairs", outputCol="_two"),
            VectorAssembler(inputCols=["_one", "_two"], outputCol="_features"),
            LogisticRegression(featuresCol="_features", maxIter=40, regParam=1e-4, standardization=False, family="multinomial"),
        ]
    )
    model = LicenceModel(stages.fit(examples.where("NOT kept_out")), families, 0.5, share)
    none = model.predict(examples.where("kept_out AND family = 'none'").select("words"))
    wrong = F.when(F.col("guess") == NONE, 1 - F.col("probability")).otherwise(F.col("probability"))
    asked = none.agg(F.percentile(wrong, 1 - passing).alias("p")).first()["p"]
    model.least = max(0.5, asked or 0.0)
    return model


def find_licences(
    spark: SparkSession, docs: DataFrame, model: LicenceModel | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: the id, ``n_paragraphs``, ``n_notices``, ``licences`` and ``best_probability``.

    Paragraphs are lines that hold a word.  A notice is a line, or one wrapped over lines or held in a long one.
    ``licences`` are the families found, sorted and joined by commas; without any it is empty and the
    probability 0.  A null, empty or blank text has no paragraphs.  Rows may repeat and ids may be null: each row
    gives a row.  Other columns are left out.  Every paragraph is classified, whatever its length.
    """
    read = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    model = model or fit(spark, read)
    # Rows alike in id and text get the same answer; they are counted and given back.  A row's first part is a null one, to count it.
    marked = read.withColumn("mark", F.xxhash64("text"))
    kept = F.concat(F.array(F.lit(None).cast("string")), F.split("text", _GAP))
    parts = marked.select("id", "mark", F.posexplode(kept).alias("at", "part"))
    cut = _stretches(_placed(parts, model.share), model.share)
    # Lines and stretches in one scan; a line without a word is no paragraph.
    items = cut.select("id", "mark", "at", F.inline_outer(F.concat(_lines(), "cuts")))
    items = items.where((F.col("at") == 0) | F.col("piece").rlike(_LETTER))
    found = model.confirmed(model.predict(items.withColumn("words", words_of(F.coalesce("piece", F.lit("")))).drop("piece")))
    notice = (F.col("at") > 0) & (F.col("family") != NONE) & F.coalesce(F.col("family") == F.col("asked"), F.lit(True))
    each = found.select(
        "id", "mark", (F.col("at") == 0).cast("int").alias("row"), F.coalesce("line", F.lit(0)).alias("paragraph"),
        F.when(notice, F.struct("family", F.col("at").alias("part"), "first", "last", "line")).alias("notice"),
        F.when(notice, F.col("probability")).alias("probability"),
    ).where("row = 1 OR paragraph = 1 OR notice IS NOT NULL")
    # The notices of one document, which its own length bounds; repeated rows have the same.
    summed = each.groupBy("id", "mark").agg(
        F.sum("row").alias("rows"),
        F.sum("paragraph").alias("paragraphs"),
        F.array_sort(F.collect_set("notice")).alias("notices"),
        F.coalesce(F.max("probability"), F.lit(0.0)).alias("best_probability"),
    )
    return summed.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).select(
        F.col("id").alias(id_column),
        (F.col("paragraphs") / F.col("rows")).cast("long").alias("n_paragraphs"),
        _apart(F.col("notices")).alias("n_notices"),
        F.array_join(F.array_distinct(F.col("notices.family")), ",").alias("licences"),
        "best_probability",
    )


def _apart(notices: Column) -> Column:
    """How many notices there are: lines that are one, and runs of meeting stretches of a family without such a line."""

    def state(count: Column, notice: Column, reach: Column, lines: Column) -> Column:
        return F.struct(
            count.cast("long").alias("count"), notice["family"].alias("family"), notice["part"].alias("part"),
            reach.cast("int").alias("reach"), lines.cast("int").alias("lines"),
        )

    def step(so_far: Column, notice: Column) -> Column:
        meets = (so_far["family"] == notice["family"]) & (so_far["part"] == notice["part"]) & (notice["first"] <= so_far["reach"])
        return F.when(
            F.coalesce(meets, F.lit(False)),
            state(so_far["count"], notice, F.greatest(so_far["reach"], notice["last"]), so_far["lines"] + notice["line"]),
        ).otherwise(state(so_far["count"] + F.greatest(so_far["lines"], F.lit(1)), notice, notice["last"], notice["line"]))

    none = F.struct(F.lit(None).cast("string").alias("family"), F.lit(None).cast("int").alias("part"))
    # The start is counted as a run of its own.
    begun = state(F.lit(-1), none, F.lit(-1), F.lit(0))
    return F.aggregate(notices, begun, step, lambda s: s["count"] + F.greatest(s["lines"], F.lit(1)))
