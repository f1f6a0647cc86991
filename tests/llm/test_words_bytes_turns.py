"""Spelling variants, repeated bytes and repaired conversations against plain versions."""

import random
from hashlib import sha256

import brute
import pytest
from pyspark.sql import functions as F

from marquee.llm import audit, conversation_repair, spelling, suffix_dedup, suffix_sort


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


# Repeated bytes


@pytest.mark.parametrize("shallow", [0, 8, 64])
def test_strings_are_sorted(shallow):
    rng = random.Random(shallow)
    for _ in range(300):
        stem = bytes(rng.choices(b"ab", k=rng.randint(0, 90)))
        strings = [stem[: rng.randint(0, len(stem))] + bytes(rng.choices(b"ab\0\xff", k=rng.randint(0, 6))) for _ in range(rng.randint(0, 14))]
        order, shared = suffix_sort.sort_strings(strings, shallow)
        assert order == sorted(range(len(strings)), key=lambda k: (strings[k], k))
        for at in range(1, len(order)):
            a, b = strings[order[at - 1]], strings[order[at]]
            n = shared[at]
            assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def repeating_texts(seed, length):
    rng = random.Random(seed)
    passages = ["".join(rng.choices("abcdé ", k=rng.randint(length // 2, 3 * length))) for _ in range(6)]
    rows = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.random()
            if kind < 0.4:
                parts.append(rng.choice(passages))
            elif kind < 0.5:
                parts.append(rng.choice("ab ") * rng.randint(0, 3 * length))
            elif kind < 0.6:
                parts.append("ab" * rng.randint(0, 3 * length))
            else:
                parts.append("".join(rng.choices("abcdefghij", k=rng.randint(0, 2 * length))))
        rows.append((rng.choice([k, k, None, 3]), "".join(parts) if rng.random() < 0.9 else None))
    return rows + rows[:10]


@pytest.mark.parametrize(("seed", "length", "group"), [(0, 40, 2), (1, 8, 3), (2, 20, 1024), (3, 5, 1024), (4, 1, 1024)])
def test_repeats_equal_brute_force(spark, seed, length, group):
    rows = repeating_texts(seed, length)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    # Names that the operator uses itself.
    clashing = frame.select("doc_id", "text", F.lit("x").alias("mark"), F.lit(1).alias("n_bytes"), F.lit(2).alias("key"), F.lit(3).alias("id"))
    got = suffix_dedup.remove_repeats(spark, clashing, length, group=group)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert got.columns == [*names, "spans"]
    assert ordered(got.select(*names).collect()) == ordered(brute.repeats(rows, length))


def test_kept_text_is_what_the_checksum_says(spark):
    rows = [(k, text) for k, (_, text) in enumerate(repeating_texts(5, 12))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.remove_repeats(spark, frame, 12).join(frame, "doc_id")
    kept = suffix_dedup.kept_text(F.col("text"), F.col("spans"))
    assert found.where(F.sha2(kept, 256) != F.col("kept_sha256")).count() == 0


def test_repeats_in_texts_of_megabytes(spark):
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefgh", k=1_200_000))
    other = "".join(rng.choices("abcdefgh", k=1_000_000))
    rows = [(1, long + other + long[300_000:700_000]), (2, "z" * 700_000), (3, other[:399] + "!" + other[500:899])]
    got = suffix_dedup.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"), 400)
    found = {r.doc_id: r for r in got.collect()}
    assert (found[1].n_removed, found[1].n_spans) == (800_000, 2)
    assert found[1].kept_sha256 == sha256((long[:300_000] + long[700_000:] + other).encode()).hexdigest()
    assert (found[2].n_removed, found[2].n_spans) == (700_000, 1)
    assert (found[3].n_removed, found[3].spans) == (0, [])


def test_halved_groups_are_right_and_leave_no_work_to_the_last_plan(spark):
    rng = random.Random(9)
    sides = [bytes(rng.choices(b"ab", k=30)) for _ in range(6)]
    contents = sorted({rng.choice(sides)[: (cut := rng.randint(0, 30))] + rng.choice(sides)[cut:] + b"0123456789" + rng.choice(sides) for _ in range(60)})
    whole = suffix_dedup.repeated_windows([(1, 0, 30, c) for c in contents], 40)
    rows = [(7, k, 1, 0, 30, len(contents), bytearray(c)) for k, c in enumerate(contents)]
    items = spark.createDataFrame(rows, "key long, context long, n long, low int, high int, size long, content binary")
    found = suffix_dedup.windows_of(spark, items, 40, 2)
    # Every round is written, so the plan that reads them does not grow by the work of each.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan
    assert "Join" not in plan
    distances = {k: set() for k in range(len(contents))}
    for row in found.collect():
        assert row.key == 7
        for low, high in zip(row.ranges[::2], row.ranges[1::2], strict=True):
            distances[row.context] |= set(range(low, high + 1))
    assert list(distances.values()) == [{d for low, high in zip(r[::2], r[1::2], strict=True) for d in range(low, high + 1)} for r in whole]
    assert any(whole)


def test_repeats_of_nothing(spark):
    for rows in ([], [(None, None)], [(1, ""), (1, "")]):
        got = suffix_dedup.remove_repeats(spark, spark.createDataFrame(rows, "doc_id long, text string"))
        assert [(r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()] == [(0, 0, sha256(b"").hexdigest())] * len(rows)


# Spelling variants


@pytest.mark.parametrize(("seed", "group"), [(0, 4), (1, 1), (2, 400)])
def test_variants_equal_brute_force(spark, seed, group):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abé", k=rng.randint(5, 8))) for _ in range(40)] + ["x" * 40]
    weights = [1 / (k + 1) ** 2 for k in range(len(base))]
    rows = [(rng.choice([k, None]), " ".join(rng.choices(base, weights, k=150)).upper() if k % 5 else None) for k in range(120)]
    rows += rows[:3]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("w").alias("word"), F.lit("k").alias("key"), F.lit("r").alias("run"))
    got = spelling.spelling_variants(spark, frame, 6, 2, 2, 7, group=group)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = brute.variants(brute.slipped_words(rows, 7), 6, 2, 2)
    assert len(wanted) > 20 and ordered(got.collect()) == ordered(wanted)


def test_every_edit_is_found_once(spark):
    letters = "abcx"
    word = "aabbca"
    others = {word[:k] + c + word[k:] for k in range(7) for c in letters} | {word[:k] + word[k + 1 :] for k in range(6)}
    others |= {word[:k] + c + word[k + 1 :] for k in range(6) for c in letters} | {"", "a", "b", "ab", "\U0001f600", "\U0001f600a"}
    words = sorted(others | {word})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    wanted = [(a, b) for a in words for b in words if a < b and brute.one_edit_apart(a, b)]
    for group in (1, 400):
        got = [tuple(sorted((r.a, r.b))) for r in spelling.near_words(spark, frame, group).collect()]
        assert sorted(got) == wanted


def test_roots_follow_long_chains(spark):
    words = [("a" * 10 + "b" * k, 5**k) for k in range(9)]
    got = spelling.variants(spark, spark.createDataFrame(words, "word string, n long"))
    assert {r.root for r in got.collect()} == {"a" * 10 + "b" * 8}
    assert [r.form_n for r in got.orderBy("n").collect()] == [5**k for k in range(1, 9)] + [None]


def test_variants_of_nothing_and_of_a_long_run(spark):
    schema = "doc_id long, text string"
    assert spelling.spelling_variants(spark, spark.createDataFrame([], schema)).count() == 0
    assert spelling.spelling_variants(spark, spark.createDataFrame([(1, None), (2, "short of it")], schema)).count() == 0
    long = "y" * 300_000
    got = spelling.spelling_variants(spark, spark.createDataFrame([(1, f"{long} {long}z")], schema), fewest=1, slips=None)
    assert sorted((len(r.word), r.n_near) for r in got.collect()) == [(300_000, 1), (300_001, 1)]


# Conversations


def talk(seed):
    rng = random.Random(seed)
    texts = ["a.", "b!", "c", "", "  ", "d?", "é.", "x. \n", None, "y", "z.", "long one.", " "]
    rows = []
    for conv in [*range(40), None]:
        for k in range(rng.choice([0, 1, 3, 8, 30])):
            turn = rng.choice([k, k, k, k + 3, None]) if seed % 2 else k
            role = rng.choice(["user", "assistant"] * 8 + ["system", "tool", "", None])
            rows.append((conv, turn, role, rng.choice(texts + [f"q{rng.randint(0, 99)}." for _ in range(12)])))
    rows += rows[:5]
    # One conversation that goes over many parts.
    for k in range(400):
        rows.append((77, k % 350, rng.choice(["user", "assistant", "system"]), rng.choice([f"q{k}.", f"q{k}", "same.", ""])))
    return rows


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_repair_equals_search(spark, seed):
    rows = talk(seed)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    clashing = frame.select("*", F.lit(1).alias("conv"), F.lit("p").alias("part"), F.lit(2).alias("place"), F.lit(3).alias("times"))
    got = conversation_repair.repair(spark, conversation_repair.damaged(clashing), clashing)
    assert got.columns == RESULT
    assert ordered(got.collect()) == ordered(brute.repair(rows))


def test_long_conversations_are_solved_in_parts(spark):
    """Rows of one conversation, many of them alike, over all parts."""
    rng = random.Random(4)
    rows = [(1, k // 2, rng.choice(["user", "assistant"]), rng.choice([f"{rng.randint(0, 300)}.", "no end", "same."])) for k in range(3000)]
    rows += [(1, 7, "user", "hot.")] * 500
    frame = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    got = conversation_repair.repair(spark, conversation_repair.damaged(frame), frame)
    assert ordered(got.collect()) == ordered(brute.repair(rows))


def test_repair_of_nothing(spark):
    schema = "conv_id string, turn long, role string, text string"
    none = spark.createDataFrame([], schema)
    assert conversation_repair.repair(spark, none).count() == 0
    asked = spark.createDataFrame([("a",), (None,)], "conv_id string")
    got = conversation_repair.repair(spark, none, asked)
    assert ordered(got.collect()) == ordered([(k, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest()) for k in ("a", None)])
    odd = spark.createDataFrame([("a", None, None, None), ("a", 2, "user", "x" * 3_000_000 + ".")], schema)
    (row,) = conversation_repair.repair(spark, odd).collect()
    assert (row.blank, row.audit, row.cost, row.illegal, row.gaps) == (1, "DD", 4, 1, 0)


def test_chains_compare_as_their_letters(monkeypatch):
    """Also when all hashes deceive."""
    for prime in (audit._PRIME, 3):
        monkeypatch.setattr(audit, "_PRIME", prime)
        rng = random.Random(prime)
        chains = audit.Chains()
        made = [0]
        for _ in range(400):
            made.append(chains.grown(rng.choice(made[-12:] + made[:3]), rng.choice("DIKR"), rng.choice([1, 1, 1, 2])))
        for _ in range(2000):
            one, two = rng.choice(made), rng.choice(made)
            if chains.letters(one) != chains.letters(two):
                assert chains.less(one, two) == (chains.letters(one) < chains.letters(two))


def test_dear_edits_change_the_choice():
    rows = [audit.Row("a", False, False), audit.Row("u", False, False), audit.Row("a", False, False)]
    assert min(audit.cheapest(rows)[s] for s in audit.ENDS if s in audit.cheapest(rows)) == (2, "DKK")
    cheap = audit.cheapest(rows, costs=audit.Costs(insert=1, delete=9, rerole=9))
    assert cheap[audit.ASSISTANT] == (1, "IKKK")
