"""Sharding, language and licences recomputed in plain Python, and texts of megabytes."""

import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marquee.llm import decontamination, jaccard_join, language_id, licenses, pii, sharding


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


# Sharding


def winner(key, weights):
    """The shard whose clock for the key rings first."""

    def waits(shard, weight):
        seed = 42 if key is None else xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
        value = xxhash.xxh64_intdigest(shard.to_bytes(4, "little", signed=True), seed)
        return -math.log(((value >> 12) + 0.5) / 2**52) / weight

    return min((waits(s, w), s) for s, w in weights.items())[1]


def test_every_key_goes_to_its_winner(spark):
    weights = {0: 1.0, 1: 2.5, 2: 0.5, 7: 1.0}
    grown = {**weights, 8: 1.5}
    keys = [*range(400), -5, 2**62, None, None]
    found = sharding.assign_shards(frame(spark, [(k, "x") for k in keys]), weights, grown).collect()
    wanted = Counter((k, winner(k, weights), winner(k, grown)) for k in keys)
    assert Counter((r.doc_id, r.shard, r.grown_shard) for r in found) == wanted


# Language


def grams(text):
    """Every four bytes of the folded text, all but letters as one space."""
    line = []
    for byte in f" {(text or '').lower()} ".encode():
        letter = 97 <= byte < 123 or byte >= 128
        if letter or not line or line[-1] != 32:
            line.append(byte if letter else 32)
    return [int.from_bytes(bytes(line[k : k + 4]), "little") for k in range(len(line) - 3)]


@pytest.fixture(scope="module")
def talk():
    draw = random.Random(3)
    sounds = {"xx": ["tha", "ing", "sho", "ere"], "yy": ["oua", "eau", "éli", "ment"], "zz": ["sch", "ung", "kei", "ber"]}
    rows = []
    for k in range(150):
        lang = "xyz"[k % 3] * 2
        words = ["".join(draw.choices(sounds[lang] + ["a", "é1", "-"], k=3)) for _ in range(draw.randint(0, 20))]
        rows.append((k, draw.choice([" ", ", ", "\n\n"]).join(words).title() if k % 17 else None, lang if k % 11 else None))
    return rows


def test_gram_counts_equal_plain_counting(spark, talk):
    docs = spark.createDataFrame(talk, "doc_id long, text string, lang string")
    found = {(r.lang, r.gram): r.n for r in language_id.gram_counts(docs).collect()}
    assert found == Counter((lang, g) for _, text, lang in talk if lang for g in grams(text))


def test_languages_equal_plain_popcounts(spark, talk):
    docs = spark.createDataFrame(talk, "doc_id long, text string, lang string")
    filters = language_id.fit(docs, most=60)
    assert filters.languages == ["xx", "yy", "zz"]
    (table,) = filters.tables

    def holders(gram):
        """The languages whose filter has all slots of the n-gram."""
        slots = [(gram * m % 2**32) >> (32 - filters.bits) for m in language_id.MULTIPLIERS]
        return [k for k in range(3) if all(table[s] >> k & 1 for s in slots)]

    # What was put in is there, by counts of counts.
    for k, lang in enumerate(filters.languages):
        counts = Counter(g for _, text, own in talk if own == lang for g in grams(text))
        levels = sorted(set(counts.values()), reverse=True)
        least = min(n for n in levels if sum(c >= n for c in counts.values()) <= 60)
        shares = {other: Counter(g for _, text, own in talk if own == other for g in grams(text)) for other in filters.languages}
        totals = {other: sum(c.values()) for other, c in shares.items()}
        cut = {other: min(n for n in set(c.values()) if sum(x >= n for x in c.values()) <= 60) for other, c in shares.items()}
        for gram, n in counts.items():
            rates = [c[gram] / totals[o] for o, c in shares.items() if c[gram] >= cut[o]]
            if n >= least and n / totals[lang] >= 0.1 * max(rates):
                assert k in holders(gram)
    for row in language_id.predict(docs, filters).collect():
        own = grams(row.text)
        if not any(c.isalpha() for c in row.text or ""):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        found = Counter(k for g in own for k in holders(g))
        rate = filters.false_rate
        counts = [max(0.0, (found[k] - len(own) * rate[k]) / (1 - rate[k])) for k in range(3)]
        best = max(range(3), key=lambda k: (counts[k], -k))
        assert row.lang_pred == filters.languages[best]
        assert row.score == pytest.approx(min(1.0, counts[best] / len(own)))


# Licences


def test_licences_equal_plain_scores(spark):
    draw = random.Random(2)
    words = "the house river stone water light forest morning under when made of license software".split()
    rows = [(k, "\n".join(" ".join(draw.choices(words, k=draw.randint(3, 25))) for _ in range(3))) for k in range(300)]
    notices = [n for ns in licenses.TEMPLATES.values() for n in ns]
    lines = [draw.choice(notices) for _ in range(60)]
    # Some words lost, some put in.
    lines = [" ".join(w for w in n.split() if draw.random() > 0.15) + draw.choice(["", " more words"]) for n in lines]
    model = licenses.fit(spark, spark.createDataFrame([(t,) for _, t in rows], "text string"))
    split = spark.createDataFrame([(k, n.split()) for k, n in enumerate(lines + [t.split("\n")[0] for _, t in rows[:60]])], "k int, words array<string>")
    logistic = model.stages.stages[-1]
    matrix, intercept = logistic.coefficientMatrix.toArray(), logistic.interceptVector.toArray()
    told = model.stages.transform(split).select("k", vector_to_array("_features").alias("x"))
    odds = {r.k: matrix @ np.array(r.x) + intercept for r in told.collect()}

    def held(own, notice):
        pairs = set(zip(notice.split(), notice.split()[1:], strict=False))
        return len(pairs & set(zip(own, own[1:], strict=False))) / len(pairs)

    seen = set()
    for row in model.confirmed(model.predict(split)).collect():
        chances = np.exp(odds[row.k] - odds[row.k].max())
        chances /= chances.sum()
        assert row.guess == model.families[int(chances.argmax())]
        assert row.probability == pytest.approx(chances.max())
        matched = 0.0 if row.guess == "none" else max(held(row.words, n) for n in licenses.TEMPLATES[row.guess])
        assert row.matched == pytest.approx(matched)
        sure = row.probability >= model.least and matched >= model.share
        assert row.family == (row.guess if sure else "none")
        seen.add(row.family != "none")
    assert seen == {True, False}


def test_addresses_with_very_many_zeros():
    long = "0" * 6000
    assert pii.base_spans(f"x {long}1.{long}.0.255 y {long}256.1.1.1") == [("ip", 2, 12010)]


# Texts of megabytes


def test_long_texts_are_worked_on_whole(spark):
    draw = random.Random(6)
    vocabulary = ["".join(draw.choices("abcdefgh", k=6)) for _ in range(5000)]
    words = draw.choices(vocabulary, k=400_000)
    text = " ".join(words)
    other = " ".join(words[:200_000] + ["changed"] + words[200_001:])
    rows = [(1, text), (2, other), (3, " ".join(draw.choices(vocabulary, k=300_000)))]
    near = {r.doc_id: r for r in jaccard_join.near_duplicates(spark, frame(spark, rows)).collect()}
    assert (near[1].component_id, near[2].component_id, near[3].component_id) == (1, 1, 3)
    assert near[1].n_shingles == len({tuple(words[k : k + 5]) for k in range(len(words) - 4)})
    items = spark.createDataFrame([(7, " ".join(words[-40:])), (8, " ".join(words[1000:1013]))], "item_id long, text string")
    found = {r.doc_id: r for r in decontamination.matches(frame(spark, rows), items).collect()}
    assert (found[1].n_words, found[1].n_hit, found[1]["items"], found[3].n_hit) == (400_000, 53, ["7", "8"], 0)
    mail = f"{'x' * 2_000_000} a@b.cd {text} e@f.gh"
    (got,) = pii.find_pii(spark, frame(spark, [(1, mail)])).collect()
    begin = 2_000_001
    assert got.base == f"email:{begin}:{begin + 6},email:{len(mail) - 6}:{len(mail)}"
    docs = spark.createDataFrame([(1, text, "xx"), (2, "ñandú ñoño " * 200_000, "yy")], "doc_id long, text string, lang string")
    told = language_id.predict(docs, language_id.fit(docs)).collect()
    assert all(r.lang_pred == r.lang and r.score > 0.9 for r in told)
