"""Personal data by fixed forms, and by contexts bootstrapped from what the forms find.

Seeds are strings of a fixed form: mail and network addresses, card and phone numbers.  A
candidate is a looser string of a kind that is no seed, such as a phone number without its plus.
Seeds and candidates stand in contexts: the word before them, and the two words before.  Kinds,
contexts and instances form a graph.  A context is as reliable for a kind as the share of
its instances that are believed; an instance is believed as far as its contexts are reliable;
both are computed in turns, from the seeds on.  Candidates that end up believed through
contexts with enough different seeds are added.  They then count as seeds do, and may make further
contexts reliable, until no candidate is added any more.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.batches import slices
from marquee.llm.shipping import in_tasks
from marquee.llm.storage import drop, stored

#: Kinds in the order that settles equal starts.
KINDS = ("email", "ip", "card", "phone")
#: Characters before a string in which its context words are looked for.
CONTEXT_CHARS = 64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A match can only begin where a run of digits does: inside one it would have been found before.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Candidates are looser.
_LOOSE_EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]++ ?(?:@|\(at\)|\[at\]) ?[\w-]+(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]+)+")
_LOOSE_IP = re.compile(r"(?<![\w.:])(?:[0-9]{1,3}(?:[.\-][0-9]{1,3}){3}|[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{0,4}){3,7})(?![\w:])")
_LOOSE_NUMBER = re.compile(r"(?<![\w.+])(?:\(?[0-9][0-9 ().\-]{5,24}[0-9])(?!\w)")
_WORD = re.compile(r"[^\W\d_]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Looks at the places of ``@`` only; every match has just one."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1] in "._%+-" or (text[begin - 1] < "\x7f" and text[begin - 1].isalnum())):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield "email", begin, domain.end()
            done = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """All strings of the fixed forms, by start and then kind."""
    found = list(emails(text))
    # Leading zeros may be very many.
    short = lambda m: [p.lstrip("0") or "0" for p in m[0].split(".")]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p) < 4 and int(p) < 256 for p in short(m))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def loose_spans(text: str, taken: list[Span]) -> list[Span]:
    """Candidates that meet no span of a fixed form."""
    found: list[Span] = []
    if "@" in text or "at)" in text or "at]" in text:
        found += [("email", *m.span()) for m in _LOOSE_EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in _LOOSE_IP.finditer(text)]
    for m in _LOOSE_NUMBER.finditer(text):
        count = len(_digits(m[0]))
        if 12 <= count <= 19:
            found.append(("card", *m.span()))
        if 7 <= count <= 15:
            found.append(("phone", *m.span()))
    free, place = [], 0
    edges = sorted((a, b) for _, a, b in taken)
    for span in sorted(found, key=lambda s: s[1]):
        while place < len(edges) and edges[place][1] <= span[1]:
            place += 1
        if place == len(edges) or span[2] <= edges[place][0]:
            free.append(span)
    return free


def contexts(text: str, start: int) -> list[str]:
    """The word before a place, and the two words before it, in lower case."""
    before = _WORD.findall(text[max(0, start - CONTEXT_CHARS) : start].lower())[-2:]
    return [before[-1], " ".join(before)] if len(before) == 2 else before


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def occurrences(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Per row the spans of fixed form, and all strings of either sort with their contexts."""
    kind = docs.schema[id_column].dataType.simpleString()
    item = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_()), ("first", pa.bool_()), ("instance", pa.string()), ("contexts", pa.list_(pa.string()))]
    )

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            base, graph, counts = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                own = base_spans(text)
                base.append(written(own))
                counts.append([sum(k == kind for k, _, _ in own) for kind in KINDS])
                listed = [(s, True) for s in own] + [(s, False) for s in loose_spans(text, own)]
                # A number may be of two kinds; it occurs once.
                firsts = {(a, b): n for n, ((_, a, b), _) in reversed(list(enumerate(listed)))}
                graph.append(
                    [
                        {"kind": k, "start": a, "end": b, "seed": seed, "first": firsts[a, b] == n, "instance": hashlib.md5(text[a:b].lower().encode()).hexdigest(), "contexts": contexts(text, a)}
                        for n, ((k, a, b), seed) in enumerate(listed)
                    ]
                )
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True))]
            columns += [pa.array(base, pa.string()), pa.array(graph, pa.list_(item))]
            yield pa.RecordBatch.from_arrays(columns, ["id", *(f"n_{k}" for k in KINDS), "base", "graph"])

    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    fields = "kind:string,start:long,end:long,seed:boolean,first:boolean,instance:string,contexts:array<string>"
    return in_tasks(read, find, f"id {kind}, {numbers}, base string, graph array<struct<{fields}>>")


def believed(spark: SparkSession, graph: DataFrame, rounds: int, reliable: float, seeds: int) -> DataFrame:
    """``kind`` and ``instance`` of the candidates that their contexts make believable.

    ``graph`` has ``kind``, ``instance``, ``seed``, ``first`` and ``context`` per occurrence; ``first`` is false where
    the same occurrence is listed for another kind already.  Edges carry how often an instance stands in a
    context.  A context counts if at least ``seeds`` different instances of the kind that are seeds or believed
    already stand in it; its reliability is the share of its occurrences, of any kind, that are
    believed to be of the kind.  An instance has the belief of its best context.  After ``rounds`` of these scores the
    instances of a belief of ``reliable`` are believed for good, and all is counted anew, until there are no new ones.
    """
    edges = graph.groupBy("context", "kind", "instance").agg(
        F.count("*").alias("times"), F.max("seed").alias("seed"), F.sum(F.col("first").cast("long")).alias("first")
    )
    edges = stored(spark, edges, "pii-graph")
    every = stored(spark, edges.groupBy("context").agg(F.sum("first").alias("every")), "pii-contexts")
    sure = stored(spark, edges.where("seed").select("kind", "instance").distinct().withColumn("given", F.lit(True)), "pii-sure")
    while True:
        known = edges.drop("seed", "first").join(sure, ["kind", "instance"], "left").withColumn("sure", F.col("given").isNotNull())
        support = known.where("sure").groupBy("context", "kind").agg(F.count("*").alias("support"))
        useful = support.where(F.col("support") >= seeds).join(every, "context").select("context", "kind", "every")
        # Contexts without enough of them cannot count yet.
        near = stored(spark, known.join(useful, ["context", "kind"]), "pii-near")
        new = stored(spark, _scored(near, rounds).where(~F.col("sure") & (F.col("belief") >= reliable)), "pii-new")
        drop(spark, near)
        if new.isEmpty():
            return sure.where("NOT given").select("kind", "instance")
        sure = stored(spark, sure.unionByName(new.select("kind", "instance", F.lit(False).alias("given"))), "pii-sure")


def _scored(edges: DataFrame, rounds: int) -> DataFrame:
    """``kind``, ``instance``, ``sure`` and ``belief`` after so many rounds; what is sure has a belief of 1."""
    belief = edges.groupBy("kind", "instance").agg(F.max(F.col("sure").cast("double")).alias("belief"), F.max("sure").alias("sure"))
    for _ in range(rounds):
        trusted = (
            edges.join(belief.select("kind", "instance", "belief"), ["kind", "instance"])
            .groupBy("context", "kind")
            .agg((F.sum(F.col("times") * F.col("belief")) / F.first("every")).alias("reliability"))
        )
        scored = edges.join(trusted, ["context", "kind"]).groupBy("kind", "instance")
        belief = scored.agg(F.when(F.max("sure"), F.lit(1.0)).otherwise(F.max("reliability")).alias("belief"), F.max("sure").alias("sure"))
    return belief


def find_pii(
    spark: SparkSession,
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = 3,
    reliable: float = 0.8,
    seeds: int = 5,
) -> DataFrame:
    """Per row: the id, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base`` and ``spans``.

    ``base`` are the spans of fixed form (the counts are of these), ``spans`` those and what contexts
    added; both are ``kind:start:end`` in code points, by start and then kind, joined by commas.
    A null or empty text has none.  Ids may be null or repeated: each row gives a row.  Other
    columns are left out.  The texts are read once; the few strings found go to the shared folder.

    Texts are taken whole, whatever their length.  What contexts can add has one of the loose forms of :func:`loose_spans`; a context
    is one or two words within ``CONTEXT_CHARS`` characters before a string, of a longer word its end.  The driver goes on as
    long as a round believes an instance anew, so there are at most as many rounds as instances, and mostly a few.
    """
    found = stored(spark, occurrences(docs, id_column, text_column).withColumn("row", F.monotonically_increasing_id()), "pii")
    each = found.select("row", F.inline("graph"))
    graph = each.select("kind", "instance", "seed", "first", F.explode("contexts").alias("context"))
    added = (
        each.where("NOT seed")
        .join(believed(spark, graph, rounds, reliable, seeds), ["kind", "instance"])
        .groupBy("row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    order = F.create_map(*(x for n, k in enumerate(KINDS) for x in (F.lit(k), F.lit(n))))
    # The strings of one document, which its own length bounds.
    listed = F.filter("graph", lambda s: s["seed"])
    listed = F.transform(listed, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    listed = F.concat(listed, F.coalesce("added", F.array().cast("array<struct<kind:string,start:long,end:long>>")))
    keyed = F.transform(listed, lambda s: F.struct(s["start"].alias("start"), order[s["kind"]].alias("order"), s["end"].alias("end"), s["kind"].alias("kind")))
    text = F.transform(F.array_distinct(F.array_sort(keyed)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return found.join(added, "row", "left").select(
        F.col("id").alias(id_column), *(f"n_{k}" for k in KINDS), "base", F.array_join(text, ",").alias("spans")
    )


def masked(text: str | None, spans: str) -> str:
    """A text with every span replaced by its kind in angle brackets; spans that meet become one."""
    text, kept, at = text or "", [], 0
    for span in spans.split(",") if spans else []:
        kind, start, end = span.split(":")
        start, end = int(start), int(end)
        if end <= at:
            continue
        if start >= at:
            kept += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*kept, text[at:]])


def mask_column(text: Column, spans: Column) -> Column:
    """``masked`` as a column, from functions of columns only."""
    begun = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, span: Column) -> Column:
        part = F.split(span, ":")
        kind, start, end = part[0], part[1].cast("long"), part[2].cast("long")
        between = F.substring(text, (state["at"] + 1).cast("int"), (start - state["at"]).cast("int"))
        grown = F.concat(state["kept"], between, F.lit("<"), F.upper(kind), F.lit(">"))
        return F.when(end <= state["at"], state).otherwise(
            F.struct(F.when(start >= state["at"], grown).otherwise(state["kept"]).alias("kept"), end.alias("at"))
        )

    whole = F.aggregate(F.split(spans, ","), begun, step, lambda s: F.concat(s["kept"], F.substr(text, (s["at"] + 1).cast("int"))))
    return F.when(spans == "", text).otherwise(whole)
