"""Token counts and packing against the tokenizers themselves."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import packing, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
NAMES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)
ODD = [
    None, "", " ", "  ", "a", "  a  b \n c ", "ﬁ ＡＢ é x\x00y", "▁▁a ▁", "<s>a</s>", "x<|endoftext|>y", "\n\n\n  x",
    "日本語 テキスト 😀😀 \t\t x", "a" * 500 + " b" * 5, " " * 70 + "q", "abc" * 300, "it's  a \n  b", "a\xa0 b\t c",
]


def test_every_prefix_has_the_library_s_count():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counter = token_counts.counter(MODEL)
    draw = random.Random(4)
    made = ["".join(draw.choice("thein  gaé.,\n") for _ in range(60)) for _ in range(40)]
    for text in [t or "" for t in ODD] + made:
        counts = counter.prefix_counts(text)
        assert len(counts) == len(text) + 1
        for end in range(len(text) + 1) if len(text) < 80 else (len(text) // 2, len(text)):
            assert counts[end] == len(library.encode(text[:end])), (text, end)
        assert (token_counts.unpacked(token_counts.packed(counts)) == counts).all()


@pytest.mark.parametrize("kind", ["cjk", "known", "line", "spaces", "letters", "mixed"])
def test_very_long_words_are_counted_in_seconds(kind):
    draw = random.Random(7)
    text = {
        "cjk": lambda: "".join(chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(100_000)),
        "known": lambda: "".join(draw.choices("的是我不了人在a1{};", k=100_000)),
        "line": lambda: "".join(draw.choices(["function", "{", "}", "return", "x=", "0", "foo", "(", ")", ";"], k=330_000)),
        "spaces": lambda: " " * 200_000,
        "letters": lambda: "z" * 100_000 + " word " + "y" * 65,
        "mixed": lambda: " ".join("".join(draw.choices("abcé", k=draw.randint(1, 130))) for _ in range(2000)),
    }[kind]()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    begun = time.monotonic()
    counts = token_counts.counter(MODEL).prefix_counts(text)
    assert time.monotonic() - begun < 60 and len(counts) == len(text) + 1
    for end in (len(text), len(text) // 2, 70, 1000):
        assert counts[end] == len(library.encode(text[:end]))


def test_budget_is_the_longest_prefix():
    counts = token_counts.counter(MODEL).prefix_counts("then the theory there")
    for budget in range(int(counts.max()) + 2):
        end = token_counts.longest_prefix(counts, budget)
        assert counts[end] <= budget and (counts[end + 1 :] > budget).all()


def test_count_rows(spark):
    rows = [(k, t, "lost") for k, t in enumerate(ODD)] + [(None, "a b", "x"), (3, "  ", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = token_counts.token_counts(docs, MODEL, 5, keep_prefixes=True).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    wanted = [(k, len((t or "").encode()), len(library.encode(t or ""))) for k, t, _ in rows]
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in found], key=key) == sorted(wanted, key=key)
    assert token_counts.token_counts(docs.limit(0), MODEL, 5).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40), st.integers(2, 30))
def test_plan_places_all_without_gaps(counts, groups):
    entries, sequences = packing.plan(counts, 64, groups)
    placed, ranks = defaultdict(list), defaultdict(list)
    for e in entries:
        ranks[e.length] += range(e.first, e.first + e.count)
        for k in range(e.count):
            placed[e.sequence + k // e.each].append((e.offset + k % e.each * e.length, e.length))
    assert {x: sorted(r) for x, r in ranks.items()} == {x: list(range(n)) for x, n in counts.items()}
    assert len(placed) == sequences
    for inside in placed.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 64


def test_plan_is_close_to_the_least():
    draw = np.random.default_rng(2)
    counts = Counter(draw.integers(1, 1025, 20_000).tolist())
    _, sequences = packing.plan(dict(counts), 1024)
    assert sequences <= 1.004 * -(-sum(x * n for x, n in counts.items()) // 1024) + 1


@pytest.fixture(scope="module")
def packed(spark):
    draw = random.Random(9)
    texts = ODD + [" ".join(draw.choice(("the", "thinner", "été", "x1")) for _ in range(draw.randint(0, 90))) for _ in range(60)]
    rows = [(k, t, k) for k, t in enumerate(texts)] + [(None, "a b", 1), (3, "  ", 1), (3, "  ", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset long")
    return rows, packing.pack_documents(spark, docs, *NAMES, capacity=32).collect()


def test_pieces_hold_the_ids(packed):
    rows, found = packed
    library = Tokenizer.from_file(NAMES[0])
    wanted = []
    for doc, text, _ in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = sorted({0, *range(len(ids) % 32, len(ids), 32), len(ids)})
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted.append((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=key) == sorted(wanted, key=key)


def test_sequences_have_no_gaps(packed):
    sequences = defaultdict(list)
    for r in packed[1]:
        sequences[r.sequence_id].append((r.offset, r.length))
    for inside in sequences.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= 32


def test_nothing_to_pack(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(spark, docs, *NAMES).count() == 0
