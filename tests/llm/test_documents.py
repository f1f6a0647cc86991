"""Operators on documents against plain versions and on odd rows."""

import random
import re
import time
from collections import Counter
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import brute
from brute import contamination, fixed_forms, near_duplicates
from pyspark.sql import functions as F

from marquee.llm import components, decontamination, jaccard_join, language_id, licenses, numbering, pii, sharding
from marquee.llm.storage import stored

ODD = [(0, None), (1, ""), (2, " \n "), (3, "a"), (4, "a"), (5, "a b"), (6, "A  b"), (7, "word" * 5000), (8, "b c " * 4000)]


def frame(spark, rows):
    """Rows with columns beside them whose names the operators use themselves."""
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"node": F.lit("x"), "n": F.lit(1), "score": F.lit("y"), "spans": F.lit(2), "row": F.lit(3)}
    )


# Near duplicates


@pytest.fixture(scope="module")
def alike():
    draw = random.Random(1)
    base = [[draw.choice("abcdefghijklmnop") + draw.choice("xyz") for _ in range(draw.randint(1, 120))] for _ in range(12)]
    rows = list(ODD)
    for k in range(9, 400):
        made = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 1, 2, 4])):
            made[draw.randrange(len(made))] = draw.choice("qwertyu") * 2
        rows.append((k, " ".join(made)))
    return rows


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_near_duplicates_equal_all_pairs(spark, alike, width, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 32)  # so that clusters take several blocks
    found = jaccard_join.near_duplicates(spark, frame(spark, alike), width, percent / 100).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_duplicates(alike, width, percent)


def test_near_duplicates_without_known_long_lists(spark, alike, monkeypatch):
    monkeypatch.setattr(jaccard_join, "KNOWN_LONG", 3)
    found = jaccard_join.near_duplicates(spark, frame(spark, alike), 3, 0.9).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_duplicates(alike, 3, 90)


def test_all_long_lists_are_marked(spark):
    often = [f"a{k} b{k} c{k}" for k in range(3000)]
    rows = [(k, " x y ".join(often[k % 2 :: 2])) for k in range(60)]
    marks, bits = jaccard_join.long_lists(frame(spark, rows).selectExpr("doc_id AS id", "text"), 3, 16)

    def share(texts):
        head = np.concatenate([s for s in jaccard_join.shingle_sets(pa.array(texts), 3)]) >> np.uint64(32)
        return jaccard_join.is_set(marks, ((head * np.uint64(bits)) >> np.uint64(32)).astype(np.int64)).mean()

    assert share([text for _, text in rows]) == 1
    assert share([f"p{k} q{k} r{k}" for k in range(3000)]) < 0.05


def test_near_duplicates_of_large_clusters_meet_in_rounds(spark, alike, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "KNOWN_LONG", 3)
    moved, compare = [], jaccard_join.compare

    def counted(blocks, pairs, sets, threshold):
        moved.append(pairs.agg(F.sum("moved")).first()[0] / blocks.agg(F.sum("n")).first()[0])
        return compare(blocks, pairs, sets, threshold)

    monkeypatch.setattr(jaccard_join, "compare", counted)
    found = jaccard_join.near_duplicates(spark, frame(spark, alike), 3, 0.9).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_duplicates(alike, 3, 90)
    assert len(moved) > 1
    assert max(moved) <= 4


def test_candidates_move_numbers_instead_of_ids(spark, alike, monkeypatch):
    """Ids may be hashes; what meets in lists are numbers that repeat their upper bytes."""
    held, candidates = [], jaccard_join.candidates

    def watched(classes, threshold):
        held.extend(r.node for r in classes.select("node").collect())
        return candidates(classes, threshold)

    monkeypatch.setattr(jaccard_join, "candidates", watched)
    ids = {crc32(b"%d" % k) << 31: k for k, _ in alike}
    rows = [(new, text) for new, (_, text) in zip(ids, alike, strict=True)]
    found = jaccard_join.near_duplicates(spark, frame(spark, rows), 5, 0.8).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == near_duplicates(rows, 5, 80)
    assert held and len(set(held)) == len(held) and not set(held) & set(ids) - {0}


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "a b c d")]
    found = jaccard_join.near_duplicates(spark, frame(spark, rows), 3, 0.9).collect()
    assert Counter(map(tuple, found)) == Counter({(None, 2, None): 1, (5, 2, 5): 2, (9, 2, 5): 1})
    assert jaccard_join.near_duplicates(spark, frame(spark, rows).limit(0)).count() == 0


def test_search_finds_all_that_reach_the_overlap():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 60, draw.integers(1, 50))).astype(np.uint64) for _ in range(80)]
    block = jaccard_join.Block(sets)
    for query in sets:
        wanted = [k for k, s in enumerate(sets) if 10 * len(np.intersect1d(s, query)) >= 7 * len(np.union1d(s, query))]
        assert block.search(query, np.ones(80, bool), 0.7).tolist() == wanted


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(60)]
    pairs += [(5, 5), (7, 8), (7, 8)]
    found = {r.node: r.root for r in components.components(spark, spark.createDataFrame(pairs, "a long, b long")).collect()}
    parent = {x: x for p in pairs for x in p}
    for _ in range(400):
        for a, b in pairs:
            parent[a] = parent[b] = min(parent[a], parent[b])
    alone = {a for a, b in pairs if a == b and not any(a in p and p[0] != p[1] for p in pairs)}
    assert found == {x: r for x, r in parent.items() if x not in alone}
    assert components.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# Decontamination


def test_matches_equal_all_windows(spark):
    draw = random.Random(5)
    items = [(k, " ".join(draw.choice("abcd") for _ in range(draw.randint(0, 9)))) for k in range(8)] + [(99, None)]
    rows = ODD + [(10 + k, " ".join(draw.choice("abcdZ") for _ in range(draw.randint(0, 60)))) for k in range(60)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.matches(frame(spark, rows), benchmark, window=4).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == contamination(rows, items, 4)


def test_matches_over_several_automata(spark, monkeypatch):
    items = [(1, "one two three four five"), (2, "three four five six"), (3, "six")]
    rows = [(1, "zero one two three four five six seven"), (2, "nothing here"), (3, "Six, SIX! é")]
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", 5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in decontamination.matches(frame(spark, rows), benchmark, window=4).collect()}
    assert {d: (r.n_words, r.n_hit, r["items"]) for d, r in found.items()} == contamination(rows, items, 4)
    spans = [(s.begin, s.end) for s in found[1].spans]
    assert decontamination.without_spans(rows[0][1], spans) == "zero  seven"


@pytest.mark.parametrize("block", [1 << 23, 300])
def test_passages_are_removed(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "AUTOMATON_BYTES", block)
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgé", k=5))
    items = [(k, " ".join(word() for _ in range(draw.choice([3, 14, 30, 80])))) for k in range(12)]
    rows = list(ODD)
    for k in range(60):
        parts = [" ".join(word() for _ in range(draw.choice([0, 20, 900]))) for _ in range(3)]
        parts.insert(1, draw.choice(items)[1].title() + draw.choice(["", "!", "\n "]))
        rows.append((100 + k, ", ".join(parts)))
    docs = frame(spark, rows).withColumn("row", F.lit(1)).withColumn("spans", F.lit(2))
    found = decontamination.remove_passages(docs, spark.createDataFrame(items, "item_id long, text string"), longest=20)
    assert found.columns == ["doc_id", "text", "n_hit", "n_cut"]
    known = contamination(rows, items, 13)
    wanted = []
    for doc, text in rows:
        words, hit, _ = known[doc]
        whole, at, spans = text or "", 0, []
        places = [m.span() for m in brute.LETTERS_DIGITS.finditer(whole.translate(brute.FOLD))]
        marks = brute.hit_words(whole, items, 13)
        while at < len(marks):
            end = at
            while end < len(marks) and marks[end]:
                end += 1
            if end > at and (end - at > 20 or 20 * hit >= words):
                spans.append((at, end))
            at = max(end, at + 1)
        kept, last = [], 0
        for begin, end in spans:
            kept.append(whole[last : places[begin][0]])
            last = places[end - 1][1]
        kept = "".join([*kept, whole[last:]])
        wanted.append((doc, None if text is None else kept, hit, sum(b - a for a, b in spans)))
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    assert len({w[3] > 0 for w in wanted}) == 2


def test_matches_without_items(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    found = decontamination.matches(frame(spark, ODD), benchmark).collect()
    assert all(r.n_hit == 0 and r["items"] == [] for r in found) and len(found) == len(ODD)


# Personal data

FORMS = [
    "a@b.c@d.e.f x..@y.z 1.2.3.4.5.6.7.8 256.1.1.1 +1 (487) 555-7209 4111 1111 1111 1111 é@é.com",
    "@@a.b a@b 1.1.1.1@x.yy __x@a.b é.a@b.c٣@q.r", "4111-1111-1111-1111 49927398716 1.2.3", "+12 345 678 9012x 12" * 50, "1" * 3000,
    "a." * 500 + "@" * 500 + ".b", "",
]


@pytest.mark.parametrize("text", FORMS)
def test_fixed_forms(text):
    assert pii.written(pii.base_spans(text)) == fixed_forms(text)


def test_contexts_find_unseen_numbers(spark):
    rows = [(k, f"please phone +1 (20{k}) 555-01{k:02d} or else") for k in range(8)]
    rows += [(20, "please phone 203 555 9876 or else"), (21, "room 203 555 9876 is"), (22, None), (23, "")]
    found = {r.doc_id: r for r in pii.find_pii(spark, frame(spark, rows)).collect()}
    assert found[20].spans.split(",")[0].startswith("phone:13:") and found[20].base == "" and found[20].n_phone == 0
    assert found[3].base == found[3].spans == fixed_forms(rows[3][1]) and found[3].n_phone == 1
    assert found[22].spans == found[23].spans == "" and len(found) == len(rows)
    assert pii.masked(rows[8][1], found[20].spans) == "please phone <PHONE> or else"


def test_found_numbers_teach_further_contexts(spark):
    rows = [(k, f"please phone +1 (20{k}) 555-01{k:02d} or else") for k in range(8)]
    # Five loose numbers in the seeds' context, the same in one of their own, and one that stands only there.
    loose = [f"203 555 98{k}0" for k in range(5)]
    rows += [(20 + k, f"please phone {n} or else") for k, n in enumerate(loose)]
    rows += [(30 + k, f"desk lamp {n} is") for k, n in enumerate(loose)] + [(40, "desk lamp 204 777 1234 is"), (41, "far room 205 888 4321 is")]
    found = {r.doc_id: r for r in pii.find_pii(spark, frame(spark, rows)).collect()}
    assert all(found[20 + k].spans == "phone:13:25" and found[30 + k].spans == "phone:10:22" for k in range(5))
    assert found[40].spans == "phone:10:22" and found[41].spans == ""


def test_a_number_of_two_kinds_occurs_once(spark):
    rows = [(k, f"please phone +1 (20{k}) 555-01{k:02d} or else") for k in range(8)]
    rows += [(20 + k, f"please phone 4420 3555 98{k:02d} or else") for k in range(8)]
    found = {r.doc_id: r for r in pii.find_pii(spark, frame(spark, rows)).collect()}
    assert all(found[20 + k].spans == "phone:13:27" for k in range(8))


def test_no_context_no_additions(spark):
    rows = [(k, f"w{'abcdefgh'[k % 8]} 55{k}-123-45{k}7 and") for k in range(10)] + [(None, "m@a.bc"), (1, "m@a.bc")]
    found = pii.find_pii(spark, frame(spark, rows)).collect()
    assert len(found) == 12 and all(r.base == r.spans for r in found)
    assert pii.find_pii(spark, frame(spark, rows).limit(0)).count() == 0


def test_masking():
    assert pii.masked("ab cd ef", "email:0:2,ip:1:4,card:6:8") == "<EMAIL>d <CARD>"
    assert pii.masked(None, "") == ""


def test_masking_by_columns_equals_the_plain_one(spark):
    draw = random.Random(3)
    rows = [(1, "ab cd ef", "email:0:2,ip:1:4,card:6:8"), (2, "abc", ""), (3, None, ""), (4, "é😀x", "phone:1:2"), (5, "abc", "ip:0:3")]
    for k in range(200):
        text = "".join(draw.choices("ab é😀", k=draw.randint(5, 40)))
        edges = sorted((draw.choice(pii.KINDS), *sorted(draw.sample(range(len(text) + 1), 2))) for _ in range(draw.randint(1, 6)))
        rows.append((10 + k, text, pii.written(sorted(edges, key=lambda s: (s[1], pii.KINDS.index(s[0]))))))
    frame = spark.createDataFrame(rows, "k int, text string, spans string")
    found = {r.k: r.m for r in frame.select("k", pii.mask_column(F.col("text"), F.col("spans")).alias("m")).collect()}
    assert found == {k: None if text is None else pii.masked(text, spans) for k, text, spans in rows}


# Sharding


def test_rendezvous(spark):
    rows = [(k, "x" * (k % 50)) for k in range(3000)] + [(None, None), (5, "x" * 5)]
    even = {k: 1.0 for k in range(10)}
    found = sharding.assign_shards(frame(spark, rows), even, {**even, 10: 1.0}).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (k, len(t or "") + 16, crc32((t or "").encode())) for k, t in rows
    )
    assert all(r.grown_shard in (r.shard, 10) for r in found)
    assert 150 < sum(r.grown_shard == 10 for r in found) < 420
    for shard in range(10):
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots))) and 220 < len(slots) < 390
    heavy = sharding.assign_shards(frame(spark, rows), {0: 1.0, 1: 3.0}).collect()
    assert 0.7 < sum(r.shard for r in heavy) / len(rows) < 0.8


def test_numbers_have_no_gaps(spark):
    rows = spark.range(500).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("g"), "id")
    found = numbering.numbered(rows, "g", ["id"], "k").collect()
    for group in ("hot", "cold"):
        places = sorted(r.k for r in found if r.g == group)
        assert places == list(range(len(places)))


# Language


def test_language(spark):
    draw = random.Random(3)
    sounds = {"xx": ["tha", "ing", "sho", "ere"], "yy": ["oua", "eau", "éli", "ment"], "zz": ["sch", "ung", "kei", "ber"]}
    rows = []
    for k in range(300):
        lang = "xyz"[k % 3] * 2
        rows.append((k, " ".join("".join(draw.choices(sounds[lang], k=3)) for _ in range(draw.randint(3, 30))), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language_id.fit(docs.where("doc_id < 200"))
    predicted = language_id.predict(docs.withColumn("score", F.lit("own")), filters).collect()
    held = [r for r in predicted if r.doc_id >= 200]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in predicted)
    odd = language_id.predict(spark.createDataFrame([*ODD, (9, "12 !?"), (10, "中文")], "doc_id long, text string"), filters)
    found = {r.doc_id: (r.lang_pred, r.score) for r in odd.collect()}
    assert [found[k] for k in (0, 1, 2, 9)] == [("und", 0.0)] * 4
    assert found[10] == ("xx", 0.0) and found[3][0] in sounds


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "abc def", None)], "doc_id long, text string, lang string")
    filters = language_id.fit(docs)
    assert [(r.lang_pred, r.score) for r in language_id.predict(docs, filters).collect()] == [("und", 0.0)]


@pytest.mark.parametrize(("most", "kept"), [(4, 4), (3, 2), (2, 2)])
def test_equally_frequent_n_grams_stay_together(spark, most, kept):
    import pyarrow as pa

    filters = language_id.fit(spark.createDataFrame([("abc abc", "x")], "text string, lang string"), most=most)
    grams, _ = language_id.grams_of(pa.array([" abc abc "], pa.string()))
    every = np.unique(grams)
    assert len(every) == 4
    assert round(filters.counts(every, np.array([0, 4]))[0, 0]) == kept


def test_n_grams_stay_in_their_text():
    import pyarrow as pa

    texts = [" ab cd ", " ", "", " a ", " ééé ", None]
    grams, bounds = language_id.grams_of(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        line = re.sub(rb"[^a-z\x80-\xff]+", b" ", (text or "").encode())
        wanted = [int.from_bytes(line[i : i + 4], "little") for i in range(len(line) - 3)]
        assert grams[bounds[k] : bounds[k + 1]].tolist() == wanted


# Licences


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(8)
    some = ["the", "license", "a", "work", "free", "ontha", "this", "reth", "public", "under", "copy", "notice", "is"]
    text = [(" ".join(draw.choices(some, k=draw.randint(1, 20))),) for _ in range(600)]
    return licenses.fit(spark, spark.createDataFrame(text, "text string"))


def test_licences(spark, model):
    rows = [
        (1, "some words\nLicensed under the Apache License, Version 2.0.\nmore"),
        (2, "He has a driving license for the public road."),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        (4, None), (5, ""), (6, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."), (6, "Released under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (None, "This work is licensed under the GNU General Public License, version 3."), (8, "é " * 5000),
    ]
    found = licenses.find_licences(spark, frame(spark, rows), model).collect()
    got = Counter((r.doc_id, r.n_paragraphs, r.n_notices, r.licences) for r in found)
    assert got == Counter(
        {(1, 3, 1, "apache"): 1, (2, 1, 0, ""): 1, (3, 1, 1, "mit"): 1, (4, 0, 0, ""): 1, (5, 0, 0, ""): 1,
         (6, 2, 2, "cc-by-nc,mit"): 2, (None, 1, 1, "gpl"): 1, (8, 1, 0, ""): 1}
    )
    assert licenses.find_licences(spark, frame(spark, rows).limit(0), model).count() == 0


WRAPPED = {
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "gpl": """ * This program is free software: you can
 * redistribute it and/or modify it under
 * the terms of the GNU General Public
 * License as published by the Free Software
 * Foundation, either version 3 of the License, or""",
}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_licences_wrapped_over_lines(spark, model, end):
    rows = [(k, WRAPPED[k].replace("\n", end)) for k in sorted(WRAPPED)]
    rows += [("long", "ontha reth " * 150 + WRAPPED["isc"].replace("\n", " ") + " reth ontha" * 150)]
    rows += [("parted", "Released under" + end + end + "the MIT" + end + end + "License")]
    # Next to a line that is one already, and twice the same row.
    rows += [("mit", "ontha\nReleased under the MIT License.\nLicensed under the\nApache License, Version 2.0")] * 2
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = Counter((r.doc_id, r.n_notices, r.licences) for r in licenses.find_licences(spark, docs, model).collect())
    assert found == Counter(
        {("bsd", 3, "bsd"): 1, ("isc", 1, "isc"): 1, ("gpl", 1, "gpl"): 1, ("long", 1, "isc"): 1, ("parted", 0, ""): 1, ("mit", 2, "apache,mit"): 2}
    )


def test_planes_hold_the_numbers():
    some = np.unique(np.random.default_rng(2).integers(0, 1 << 32, 5000, dtype=np.uint32))
    for value in (some, some[:1], some[:0]):
        assert jaccard_join.from_planes(jaccard_join.planes(value)).tolist() == value.tolist()


def test_shuffles_go_when_a_table_is_written(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    local = [Path(str(f)) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    files = lambda: {f for top in local for f in top.rglob("shuffle_*")}
    there = files()
    kept = stored(spark, spark.range(50_000).groupBy((F.col("id") % 999).alias("k")).count(), "swept")
    # Files are deleted beside the session.
    for _ in range(100):
        if not files() - there:
            break
        time.sleep(0.1)
    assert not files() - there
    assert kept.count() == 999 and spark.conf.get(setting) == before
