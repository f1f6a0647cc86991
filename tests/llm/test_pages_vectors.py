"""Main text of pages, and nearest neighbours."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import ann, html_extraction

ARTICLE = (
    "<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Home</a></header><nav><ul><li><a href=1>A</a>"
    "<li><a href=2>B</a></ul></nav><main><article><h1>Title &amp; more</h1><p>First  <b>bold</b> text,\nwith words.<p>Second one."
    "<aside>See also</aside><div class='share-buttons'>Share</div></article><section id=comments><p>Nice post, really.</p></section></main>"
    "<form><label>Mail</label><input></form><script>var t='</p>';</script><footer>&copy; us</footer></body></html>"
)
SOUP = (
    "<body><div><a href=/>Home</a> | <a href=/a>About</a></div><div><h1>Great story</h1><p>Once upon a time, there was a long tale, told by "
    "many people, about the sea. It went on, and on, for many sentences.</p><p>Then the people, all of them, went home, had supper, and slept "
    "until the sun came up again in the morning.</p></div><div><ul><li><a href=1>More</a><li><a href=2>Stuff</a></ul></div></body>"
)


@pytest.fixture(scope="module")
def weights():
    draw = random.Random(1)
    made = []
    for _ in range(60):
        text = "".join(
            "<p>" + " ".join(draw.choices(["the", "sea,", "was", "home", "again."], k=draw.randint(12, 60))) + ".</p>" for _ in range(4)
        )
        links = "".join(f"<li><a href={k}>{draw.choice(['More', 'Home', 'About us'])}</a>" for k in range(5))
        made.append(f"<body><nav><ul>{links}</ul></nav><article><h1>A head line</h1>{text}</article><footer>&copy; me | us</footer></body>")
    return html_extraction.train(made)


def test_article(weights):
    assert html_extraction.main_text(ARTICLE, weights) == "Title & more First bold text, with words. Second one."


def test_page_that_names_nothing(weights):
    found = html_extraction.main_text(SOUP, weights)
    assert found.startswith("Great story Once upon") and found.endswith("in the morning.")


PROSE = (
    "<h1>Great story</h1><p>Once upon a time, there was a long tale, told by many people, about the sea. It went on, and on, for many "
    "sentences.</p><p>Then the people, all of them, went home, had supper, and slept until the sun came up again in the morning.</p>"
)
MENU = "<nav><ul><li><a href=1>More</a><li><a href=2>Stuff</a></ul></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form>{MENU}{PROSE}</form></body>",
        f"<body><form>{MENU}<article>{PROSE}</article></form></body>",
        f"<body><div class='layout sidebar'>{MENU}<main>{PROSE}</main></div></body>",
        f"<body>{MENU}<div class='content no-sidebar'>{PROSE}</div></body>",
        f"<body class=x>{MENU}<div class='with-sidebar'>{PROSE}</div></body>",
        f"<body>{MENU}<div class='post share'>{PROSE}</div></body>",
        f"<html><head><title>T</title><meta charset=utf-8><body>{MENU}{PROSE}</body>",
        f"<html><head><title>T</title><div>{MENU}{PROSE}</div>",
    ],
)
def test_names_and_heads_do_not_lose_the_text(weights, page):
    found = html_extraction.main_text(page, weights)
    assert found.startswith("Great story Once upon") and found.endswith("in the morning.")


PARTS = {
    "list": "<h1>Title</h1><p>P</p><ul><li><a>One thing</a></li><li><a>Two thing</a></li></ul><p>P</p>",
    "table": "<p>P</p><table><tr><th>A<th>B<tr><td>1<td>2</table><p>end</p>",
    "code": "<p>Run</p><pre>ls | wc</pre><figure><img src=x><figcaption>Fig | 1</figcaption></figure><p>©</p>",
    "links": "<p><a href=1>All of it</a></p><p><a href=2>is linked</a></p>",
    "inner": "<header><h2>Head</h2></header><div class=body><p>x</p></div><section><p>y</p></section>",
}


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<body>" + MENU + "<main><article>{}</article></main><footer><p>Imprint</p></footer></body>"])
def test_an_article_is_kept_whole(weights, part, frame):
    wanted = " ".join(re.sub("<[^>]*>", " ", PARTS[part]).split())
    assert html_extraction.main_text(frame.format(PARTS[part]), weights) == wanted


@pytest.mark.parametrize(
    "page",
    ["<div>" * 20_000 + "</section>" * 20_000 + "x", "<b>" * 20_000 + "x", "<i><div>" + "<b>" * 20_000 + "</i>" * 20_000, "<p>a <b>b" * 20_000,
     "<p>A paragraph, it is. Here.</p><li><a>menu</a></li>" * 10_000, "<div><p>x</p>" * 20_000],
)
def test_hostile_pages_take_seconds(weights, page):
    begun = time.monotonic()
    html_extraction.main_text(page, weights)
    assert time.monotonic() - begun < 20


def test_articles_of_other_pages_stay_out(weights):
    teaser = "<article><a href=5>Other tale</a></article>"
    remark = "<section id=comments><article class=comment-body><p>Nice.</article></section>"
    found = html_extraction.main_text(f"<body><main>{PROSE}</main><aside>{teaser}{teaser}</aside>{remark}</body>", weights)
    assert found.endswith("in the morning.")


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- x", "<script>x", "<a href=\"x" * 500, "<div>" * 3000, "</p></div>"])
def test_odd_pages(weights, page):
    assert html_extraction.main_text(page, weights) == ""


def test_minimum_cut_is_the_cheapest_labelling():
    draw = np.random.default_rng(4)
    for _ in range(60):
        count = int(draw.integers(1, 9))
        gain = draw.integers(-4, 5, count).astype(float)
        edges = [(int(a), int(b), float(draw.integers(1, 4))) for a, b in draw.integers(0, count, (count + 2, 2)) if a != b]

        def cost(kept, gain=gain, edges=edges):
            apart = sum(max(0, g) if not k else max(0, -g) for g, k in zip(gain, kept, strict=True))
            return apart + sum(c for a, b, c in edges if kept[a] != kept[b])

        least = min(map(cost, itertools.product([False, True], repeat=count)))
        assert cost(html_extraction.minimum_cut(gain, edges)) == pytest.approx(least)


def test_extract_rows(spark):
    rows = [(1, "u", ARTICLE), (1, "u", ARTICLE), (None, None, SOUP), (3, "v", None), (4, "w", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("own"))
    found = html_extraction.extract(spark, pages).collect()
    assert len(found) == 5 and all(r.n_chars == len(r.text) for r in found)
    assert {r.text for r in found if r.page_id == 1} == {"Title & more First bold text, with words. Second one."}
    assert [r.text for r in found if r.page_id in (3, 4)] == ["", ""]
    assert html_extraction.extract(spark, pages.limit(0)).count() == 0


def nearest(rows, count):
    """By query: the others by cosine, ties to the smaller id."""
    fine = [(k, np.array(v)) for k, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    found = {}
    for k, v in fine:
        if k % 5 == 0:
            scores = [(-float(v @ w) / (np.linalg.norm(v) * np.linalg.norm(w)), j) for j, w in fine if j != k]
            found[k] = [j for _, j in sorted((round(s, 9), j) for s, j in scores)[:count]]
    return found


def searched(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("own"))
    found = {}
    for r in ann.search(spark, frame, F.col("vec_id") % 5 == 0, **settings).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
        assert r["rank"] == len(found[r.query_id])
    return found


def test_few_vectors_are_searched_exactly(spark):
    draw = np.random.default_rng(2)
    rows = [(k, draw.normal(size=4).tolist()) for k in range(40)] + [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(40, 60)]
    rows += [(60, None), (65, [0.0] * 4), (70, [None, 1.0, 1.0, 1.0]), (75, [float("nan")] * 4), (80, [float("inf"), 1.0, 0.0, 0.0])]
    assert searched(spark, rows) == nearest(rows, 5)
    assert searched(spark, rows[:3]) == nearest(rows[:3], 5)
    assert searched(spark, rows[60:]) == {} and searched(spark, []) == {}


def test_recall_on_many_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 300)
    monkeypatch.setattr(ann, "ASKED", 50)
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + 0.6 * draw.normal(size=16)).tolist()) for k in range(2500)]
    rows += [(k, centres[0].tolist()) for k in range(2500, 3500)]
    found, wanted = searched(spark, rows, sample=1500), nearest(rows, 5)
    assert found.keys() == wanted.keys()
    assert sum(len(set(found[k]) & set(wanted[k])) for k in wanted) >= 0.9 * 5 * len(wanted)


def test_parts_are_parted_again(spark, monkeypatch):
    """More parts in a larger table, found as well, and most vectors are not looked at."""
    monkeypatch.setattr(ann, "SPLIT", 300)
    monkeypatch.setattr(ann, "PART", 100)
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(40, 12))
    points = np.array([centres[k % 40] + 0.2 * draw.normal(size=12) for k in range(4000)])
    rows = [(k, v.tolist()) for k, v in enumerate(points)]
    found, wanted = searched(spark, rows, sample=512), nearest(rows, 5)
    assert sum(len(set(found[k]) & set(wanted[k])) for k in wanted) >= 0.9 * 5 * len(wanted)
    # The same by hand: of 8 parts those of more than 300 vectors are parted again.
    router = ann.fit(points[:512], 5)
    part = router.odds(ann.unit(points)).argmax(axis=1)
    sizes = np.bincount(part, minlength=router.parts)
    assert router.parts == 8 and sizes.max() > 300
    below = {p: ann.fit_parts(ann.distinct_units(points[part == p]), 4) for p in np.flatnonzero(sizes > 300)}
    router = ann.calibrated(ann.Router(router.dimension, 1, router.layers, below), ann.unit(points[:512]), 5, 0.97)
    assert router.parts == 8 + 3 * len(below)
    odds = router.odds(ann.unit(points))
    assert np.allclose(np.exp(odds).sum(axis=1), 1)
    sizes = np.bincount(odds.argmax(axis=1), minlength=router.parts)
    share = sizes[np.argsort(-odds, axis=1)[:, : router.probes]].sum(axis=1).mean() / len(points)
    assert share < 0.4


def test_vectors_of_other_sizes_stay_out(spark):
    draw = np.random.default_rng(9)
    rows = [(k, draw.normal(size=4).tolist()) for k in range(50)]
    odd = [(55, [1.0] * 9), (60, [1.0] * 3), (65, []), (70, [1.0] * 400)]
    assert searched(spark, rows + odd) == nearest(rows, 5)
    # Repeated ids: each row asks, and no row of an id answers it.
    twice = [(5, [1.0, 0.0]), (5, [1.0, 0.1]), (6, [0.0, 1.0]), (7, [1.0, 1.0])]
    assert searched(spark, twice) == {5: [7, 7, 6, 6]}


def test_parts_are_balanced():
    draw = np.random.default_rng(7)
    points = ann.unit(draw.normal(size=(600, 8)))
    part = ann.balanced_parts(points, ann.neighbour_graph(points, 5), 8)
    assert np.bincount(part, minlength=8).max() <= np.ceil(600 / 8 * 1.1)
