"""Main text of web pages by a minimum cut between content and boilerplate.

A page is read into blocks of text.  A classifier says what it would cost to take each block for
content or for boilerplate; those costs are capacities to two terminals.  Blocks that
follow each other or are close in the page's tree are joined by edges, which cost if they are
parted.  The cheapest labelling of all blocks together is a minimum cut.

The classifier is a logistic regression on the form of blocks (length, links, punctuation, place),
trained on pages whose markup names their parts; where a page names a part, that speaks too.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.batches import slices
from marquee.llm.sampling import hashed_sample
from marquee.llm.shipping import in_tasks

#: Elements whose content is no text of the page, that do not part text, and that never close.
SILENT = frozenset("script style noscript template svg math iframe object audio video canvas select datalist head textarea button".split())
RAW = frozenset("script style textarea noscript iframe template".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What markup calls content and boilerplate.
CONTENT_TAGS = frozenset(("article", "main"))
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
CONTENT_NAMES = re.compile(r"(?:^|[\s_-])(?:article|post|entry|story|content|main|body)(?:$|[\s_-])")
BOILERPLATE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|commentlist|consent|contentinfo|cookies?|copyright|dialog|disclaimer|discussion|disqus|"
    r"footer|gdpr|header|legal|login|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|overlay|pager|pagination|popup|promo\w*|recommend\w*|related|"
    r"replies|reply|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|subscription|tags|toolbar|topbar|tracking|widgets?)(?:$|[\s_-])"
)
#: Words that make a class tell of another part of the page (``no-sidebar``).
ABOUT_OTHERS = frozenset("no not non with without has is hide show layout page".split())
#: Wrappers that hold articles of other pages, and what may stand in a head.
ASIDES = frozenset("nav footer aside menu".split())
HEAD_TAGS = frozenset("base link meta noscript script style template title".split())
#: The classifier's bound in log odds, what a name and a block all of links are worth, and what it costs to part
#: neighbours and blocks of one parent.  A name is worth less than the classifier can say against it.
FORM, NAMED, LINKED, ADJACENT, SIBLINGS = 4.0, 3.0, 3.0, 0.6, 0.6
#: An ``article`` or ``main`` element is worth more than all that can be said against a block in it: form, links and edges.
SURE = FORM + LINKED + 2 * (ADJACENT + SIBLINGS) + 1.0

# The tag's rest: text without quotes, quoted text, or a quote that never closes.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?", re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)


@dataclass(eq=False)
class Node:
    tag: str
    parent: Node | None
    named: int  # 2 surely content, 1 content, -1 boilerplate, 0 neither, as said by this element or one above
    silent: bool
    aside: bool = False  # in a wrapper that holds articles of other pages
    holder: Node | None = None  # the element itself or the next one above that parts text
    open: Counter[str] = field(default_factory=Counter)  # inline elements that are open in this holder


@dataclass
class BlockOfText:
    """A stretch of text that no block element parts."""

    node: Node
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _said(names: str, content: bool) -> int:
    """What an element's names call it: 1 content (if asked for), -1 boilerplate, 0 neither or both."""
    told = [n for n in names.split() if ABOUT_OTHERS.isdisjoint(re.split("[_-]", n))]
    bad = [bool(BOILERPLATE_NAMES.search(n)) for n in told]
    good = content and any(CONTENT_NAMES.search(n) for n, b in zip(told, bad, strict=True) if not b)
    return int(good) - any(bad)


def _element(tag: str, rest: str, parent: Node) -> Node:
    named = parent.named
    names = " ".join("".join(m) for m in _NAMES.findall(rest)).lower() if rest else ""
    if named > 0:  # an article's own header holds its title
        names = names.replace("header", "")
    said = _said(names, tag in ("div", "section")) if names and tag not in ("html", "body") else 0
    if tag in BOILERPLATE_TAGS or (tag == "header" and named <= 0):
        named = -1
    elif tag in CONTENT_TAGS:
        if named >= 0:
            named = 2
        elif said >= 0:  # a wrapper's name does not speak for an article in it
            named = 0 if parent.aside else 1
    elif said < 0:
        named = said
    elif named >= 0:
        named = max(named, said)
    hidden = re.search(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", rest, re.IGNORECASE) if rest else None
    node = Node(tag, parent, named, parent.silent or tag in SILENT or bool(hidden), parent.aside or tag in ASIDES)
    node.holder = parent.holder if tag in INLINE else node
    return node


def blocks_of(html: str) -> list[BlockOfText]:
    """The page's blocks in order; text of silent elements is left out."""
    root = Node("", None, 0, False)
    root.holder = root
    here, made, current, at = root, [], None, 0
    links = 0
    #: Open elements by tag, so that an end tag without a beginning is known at once.
    opened: Counter[str] = Counter()

    def close_until(above: Node) -> None:
        """Ends elements until ``above`` is the innermost one.  Each element is ended once."""
        nonlocal here, links
        while here is not above:
            links -= here.tag == "a"
            opened[here.tag] -= 1
            if here.tag in INLINE:
                here.holder.open[here.tag] -= 1
            here = here.parent

    def add(text: str) -> None:
        nonlocal current
        if not text or here.silent:
            return
        if current is None:
            current = BlockOfText(here.holder)
            made.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text.strip())

    while True:
        token = _TOKEN.search(html, at)
        text = html[at : token.start() if token else len(html)]
        if here.tag == "head" and text.strip():  # a head that is left open ends where the page begins
            close_until(here.parent)
        add(text)
        if token is None:
            break
        at = token.end()
        if not token[2]:
            continue
        tag = token[2].lower()
        if tag not in INLINE:
            current = None
        if here.tag == "head" and not token[1] and tag not in HEAD_TAGS:
            close_until(here.parent)
        if token[1]:
            # An inline element's end never ends the block it is in.
            if (here.holder.open if tag in INLINE else opened)[tag] > 0:
                while here.tag != tag:
                    close_until(here.parent)
                close_until(here.parent)
        elif tag not in VOID:
            # A paragraph or an item ends where the next block begins.
            if tag not in INLINE:
                above = here.holder
                if above.tag == "p" or (above.tag == tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option")):
                    close_until(above.parent)
            here = _element(tag, token[3], here)
            links += tag == "a"
            opened[tag] += 1
            if tag in INLINE:
                here.holder.open[tag] += 1
            if tag in RAW:
                end = re.compile(f"</{tag}\\b[^>]*>?", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
                close_until(here.parent)
    for block in made:
        block.text = " ".join(unescape("".join(block.parts)).split())
    return [block for block in made if block.text]


def features(blocks: list[BlockOfText]) -> np.ndarray:
    """The form of each block and of its neighbours; nothing that names a part."""
    rows = []
    for block in blocks:
        text, words = block.text, block.text.count(" ") + 1
        marks = sum(text.count(c) for c in ".,;:!?")
        tag = block.node.tag
        rows.append(
            (
                np.log1p(len(text)),
                np.log1p(words),
                min(1.0, block.linked / len(text)),
                marks / words,
                float(text[-1] in ".!?…\"'»”"),
                len(text) / words / 10,
                float(tag == "p"),
                float(tag in ("li", "td", "th", "option")),
                float(tag in ("h1", "h2", "h3", "h4", "h5", "h6")),
                float("©" in text or "|" in text or "·" in text),
            )
        )
    own = np.array(rows).reshape(len(rows), 10)
    around = np.zeros((len(rows), 4))
    if len(rows) > 1:
        around[1:, :2], around[:-1, 2:] = own[:-1, [0, 2]], own[1:, [0, 2]]
    place = np.linspace(0, 1, len(rows))[:, None] if len(rows) else np.zeros((0, 1))
    return np.concatenate([own, around, place, place**2, np.ones((len(rows), 1))], axis=1)


def train(pages: list[str], rounds: int = 300) -> np.ndarray:
    """Weights of the logistic regression, from blocks that markup names; without any, long unlinked text is content."""
    seen, label = [], []
    for page in pages:
        blocks = blocks_of(page)
        named = np.array([b.node.named for b in blocks])
        if (named > 0).any():
            seen.append(features(blocks)[named != 0])
            label.append(named[named != 0] > 0)
    weights = np.zeros(17)
    weights[[1, 2, 16]] = 1.0, -4.0, -2.0
    if not seen:
        return weights
    x, y = np.concatenate(seen), np.concatenate(label).astype(float)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    speed = np.zeros(17)
    for _ in range(rounds):
        slope = x.T @ (weight * (1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))) - y)) + 1e-3 * weights
        speed = 0.9 * speed - 0.3 * slope
        weights = weights + speed
    return weights


def minimum_cut(gain: np.ndarray, edges: list[tuple[int, int, float]]) -> np.ndarray:
    """Which nodes stay with the source: the cheapest cut if node k costs ``max(0, gain[k])`` apart from the source
    and ``max(0, -gain[k])`` apart from the sink, and each edge costs if it is cut.

    Flow is pushed from one node with capacity from the source after the other, along shortest paths.  When no more of it
    finds a way, the nodes that it reached stay with the source; nothing else flows through them later, so they
    are not looked at again, and a page of many blocks takes little longer than its blocks one by one.
    """
    count = len(gain)
    spare = gain.astype(float).tolist()  # capacity left from the source (positive) or to the sink (negative)
    edge: list[dict[int, float]] = [{} for _ in range(count)]
    for a, b, cost in edges:
        edge[a][b] = edge[a].get(b, 0.0) + cost
        edge[b][a] = edge[b].get(a, 0.0) + cost
    tiny = 1e-9
    kept = np.zeros(count, dtype=bool)
    for begin in range(count):
        while spare[begin] > tiny and not kept[begin]:
            back, waiting, end = {begin: -1}, deque((begin,)), -1
            while waiting and end < 0:
                here = waiting.popleft()
                for there, room in edge[here].items():
                    if room > tiny and there not in back and not kept[there]:
                        back[there] = here
                        if spare[there] < -tiny:
                            end = there
                            break
                        waiting.append(there)
            if end < 0:
                kept[list(back)] = True
                break
            path = [end]
            while back[path[-1]] >= 0:
                path.append(back[path[-1]])
            flow = min([spare[begin], -spare[end], *(edge[a][b] for b, a in zip(path, path[1:], strict=False))])
            spare[begin] -= flow
            spare[end] += flow
            for b, a in zip(path, path[1:], strict=False):
                edge[a][b] -= flow
                edge[b][a] += flow
    return kept


def main_text(html: str | None, weights: np.ndarray) -> str:
    """The content blocks in order, joined by spaces; empty if there are none."""
    blocks = blocks_of(html or "")
    if not blocks:
        return ""
    form = features(blocks)
    gain = np.clip(form @ weights, -FORM, FORM) - LINKED * form[:, 2]
    named = np.array([b.node.named for b in blocks])
    if (named[gain > 0] < 0).all():  # a name of all that reads as content, such as a form around the page, tells nothing apart
        named = np.array([n if n >= 0 or b.node.aside else 0 for n, b in zip(named, blocks, strict=True)])
    gain += np.where(named > 1, SURE, NAMED * named)
    edges, last = [], {}
    for k, block in enumerate(blocks):
        if k:
            edges.append((k - 1, k, ADJACENT))
        holder = block.node.parent
        if id(holder) in last:
            edges.append((last[id(holder)], k, SIBLINGS))
        last[id(holder)] = k
    # Blocks that agree with all their neighbours need no flow; the cut finds the others.
    kept = gain > 0 if (gain > 0).all() or (gain <= 0).all() else minimum_cut(gain, edges)
    return " ".join(block.text for block, keep in zip(blocks, kept, strict=True) if keep)


def extract(
    spark: SparkSession,
    pages: DataFrame,
    sample: int = 400,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Per row: the id, the url, ``text`` (empty if there is none) and ``n_chars``, its code points.

    White space within a block becomes one space, blocks are joined by one.  Null and empty pages, and pages
    that are all boilerplate, have an empty text.  The classifier is trained on ``sample`` pages, chosen by
    a hash; every page is then worked on whole.  Rows may repeat, and id
    and url may be null; other columns are left out.
    """
    html = F.col(html_column).cast("string")
    chosen = pages.where(html.isNotNull()).select(F.col(id_column).alias("id"), html.alias("html"))
    rows = hashed_sample(chosen, ["id", "html"], sample).collect()
    shared = spark.sparkContext.broadcast(train([r["html"] for r in rows]))
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_column, url_column)]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in slices(batches, "html", 1 << 22):
            texts = [main_text(page, weights) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    read = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), html.alias("html"))
    made = in_tasks(read, work, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return made.withColumnsRenamed({"id": id_column, "url": url_column})
