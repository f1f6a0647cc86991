"""Bytes of texts that lie in a string of a given length which occurs elsewhere, by sorted suffixes.

A suffix array of all places of a corpus would be many times its size.  Here the suffixes that are sorted start at
anchors: every window of ``length`` bytes has one, its piece of a quarter of that length with the smallest hash (the
leftmost of equal ones).  Equal windows have equal anchors at the same distance, so that only windows
around equal anchors need be compared, and all of them are.

1. Each text, told by its checksum, is kept once with the number of its copies, in buckets, so that its bytes travel once.
2. Tasks find the anchors.  What surrounds an anchor, up to the ends of its windows, is its context.  Anchors that
   occur once in the corpus are left.  Where all contexts of an anchor are equal, all its windows are repeated.
3. Where contexts differ, each is fetched once.  The suffixes that begin at the anchor and the reversed prefixes that end at it
   are sorted, deep-shallow: multikey quicksort, then blind tries.  For a window that begins o bytes before the anchor,
   contexts that share o bytes to the left and the rest to the right are neighbours in both orders.
4. An anchor with very many different contexts is halved: windows that begin near, and far from it.  Each half is told apart by
   the bytes that all its windows share, equal ones fall together, and so on down to single windows, so no group is too
   large for a task and nothing is left out.
5. Covered bytes of a text are joined and removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.batches import buffer_of, slices
from marquee.llm.shipping import in_tasks
from marquee.llm.storage import stored, stored_in_buckets
from marquee.llm.suffix_sort import common_prefix, sort_strings
from marquee.operators.skew import spread_join

#: Contexts of an anchor that are sorted in one group; more are halved first.
GROUP = 1024
#: Window starts looked at together, and bytes of text for a task that holds texts.
STARTS, BUCKET_BYTES = 1 << 19, 96 << 20
_LOW = np.uint64(0xFFFFFFFF)
_BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class _Rolling:
    """Polynomial hashes of any stretch of a buffer."""

    def __init__(self, raw: np.ndarray, base: np.uint64) -> None:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        powers = np.full(len(raw), base)
        powers[:1] = 1
        np.multiply.accumulate(powers, out=powers)
        self.inverse = np.full(len(raw) + 1, inverse)
        self.inverse[:1] = 1
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers, out=self.sums[1:])

    def __call__(self, begin: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def find_anchors(raw: np.ndarray, bounds: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The anchors of the windows of texts laid on end: ``text``, ``x`` (place in the text), ``low`` and ``high`` (how many
    bytes before it its windows begin), ``key`` and ``context`` (hashes) and ``run``, so many alike in a row."""
    piece = max(1, length // 4)
    lengths = np.maximum(np.diff(bounds) - length + 1, 0)
    if not lengths.sum():
        return {}
    first, second = (_Rolling(raw, base) for base in _BASES)
    grams = first(slice(0, len(raw) - piece + 1), slice(piece, len(raw) + 1))
    least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    wanted, width = length - piece + 1, 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < wanted:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    start = bounds[text] + inside
    anchor = (least[start] & _LOW).astype(np.int64)
    # Windows in a row with the same anchor.
    begins = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
    ends = np.r_[begins[1:], len(start)] - 1
    text, anchor = text[begins], anchor[begins]
    high, low = anchor - start[begins], anchor - start[ends]
    key = grams[anchor]
    context = second(start[begins], start[ends] + length)
    context = _mixed(context ^ (low * 65536 + high).astype(np.uint64) ^ key)
    x = anchor - bounds[text]
    alike = np.r_[False, (text[1:] == text[:-1]) & (context[1:] == context[:-1]) & (key[1:] == key[:-1]) & (x[1:] == x[:-1] + 1)]
    heads = np.flatnonzero(~alike)
    run = np.diff(np.r_[heads, len(x)])
    found = {"text": text, "x": x, "low": low, "high": high, "key": key.view(np.int64), "context": context.view(np.int64)}
    return {name: value[heads] for name, value in found.items()} | {"run": run}


def _pieces(raw: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The texts, and a very long one in parts that overlap by less than a window, with where the part begins."""
    if len(raw) <= STARTS + length:
        yield raw, bounds, 0
        return
    for begin in range(0, len(raw) - length + 1, STARTS):
        part = raw[begin : begin + STARTS + length - 1]
        yield part, np.array([0, len(part)]), begin


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """Anchors of the stored texts: ``mark, x, run, low, high, key, context, n``."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            mark, text, copies = (batch.column(batch.schema.get_field_index(c)) for c in ("mark", "text", "copies"))
            times = copies.to_numpy()
            raw, bounds = buffer_of(text)
            for part, cuts, begin in _pieces(raw, bounds, length):
                found = find_anchors(part, cuts, length)
                if found:
                    columns = [mark.take(pa.array(found["text"])), pa.array((found["x"] + begin).astype(np.int32))]
                    columns += [pa.array(found[c].astype(np.int32)) for c in ("run", "low", "high")]
                    columns += [pa.array(found["key"]), pa.array(found["context"]), pa.array(found["run"] * times[found["text"]])]
                    yield pa.RecordBatch.from_arrays(columns, ["mark", "x", "run", "low", "high", "key", "context", "n"])

    return in_tasks(texts, work, "mark binary, x int, run int, low int, high int, key long, context long, n long")


def repeated_windows(items: list[tuple[int, int, int, bytes]], length: int) -> list[list[int]]:
    """For each context of an anchor the first and last distance, pair after pair, of windows that occur more than once.

    A context is ``(n, low, high, bytes)``: how often it occurs, and its windows' distances to the anchor.
    """
    if len(items) == 2:
        (n, low, high, one), (m, least, most, two) = items
        right = common_prefix(one[high:], two[most:])
        left = common_prefix(one[:high][::-1], two[:most][::-1])
        begin, end = max(low, least, length - right), min(high, most, left)
        shared = [begin, end] if begin <= end else []
        return [[low, high] if n > 1 else shared, [least, most] if m > 1 else shared]
    count = len(items)
    times, low, high = (np.array([item[k] for item in items]) for k in range(3))
    distances = np.arange(low.min(), high.max() + 1)[:, None]
    together = np.zeros((len(distances), count), np.int64)
    for strings, depths in (
        ([item[3][item[2] :] for item in items], length - distances),
        ([item[3][: item[2]][::-1] for item in items], distances),
    ):
        order, shared = sort_strings(strings)
        numbers = np.cumsum(np.array(shared)[None, :] < depths, axis=1)
        together *= count + 1
        together[:, order] += numbers
    inside = (low <= distances) & (distances <= high)
    # Each window outside a context is alone.
    together[~inside] = -1 - np.flatnonzero(~inside.ravel())
    order = np.argsort(together, axis=1, kind="stable")
    ordered = np.take_along_axis(together, order, axis=1)
    same = np.zeros((len(distances), count + 1), bool)
    same[:, 1:-1] = ordered[:, 1:] == ordered[:, :-1]
    hit = np.zeros((len(distances), count), bool)
    np.put_along_axis(hit, order, same[:, 1:] | same[:, :-1], axis=1)
    hit = (hit | (times > 1)) & inside
    edges = np.diff(np.pad(hit.astype(np.int8), ((1, 1), (0, 0))), axis=0)
    result = []
    for k in range(count):
        begins, ends = np.flatnonzero(edges[:, k] == 1), np.flatnonzero(edges[:, k] == -1) - 1
        result.append((np.stack([begins, ends], axis=1) + distances[0, 0]).ravel().tolist())
    return result


def compare(items: DataFrame, length: int, tasks: int) -> DataFrame:
    """``key, context, ranges`` of the items (``key, context, n, low, high, content``) of groups that fit into a task."""
    schema = pa.schema([("key", pa.int64()), ("context", pa.int64()), ("ranges", pa.list_(pa.int32()))])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def solved() -> Iterator[pa.RecordBatch]:
            found = repeated_windows([(i["n"], i["low"], i["high"], i["content"]) for i in held], length)
            rows = [{"key": i["key"], "context": i["context"], "ranges": r} for i, r in zip(held, found, strict=True) if r]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

        # Rows come in the order of the key.
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["key"] != row["key"]:
                    yield from solved()
                    held.clear()
                held.append(row)
        if held:
            yield from solved()

    dealt = items.select("key", "context", "n", "low", "high", "content").repartition(tasks, "key").sortWithinPartitions("key", "context")
    return in_tasks(dealt, work, "key long, context long, ranges array<int>")


def _number(*parts: bytes | int) -> int:
    digest = blake2b(b"".join(p if isinstance(p, bytes) else p.to_bytes(9, "little", signed=True) for p in parts), digest_size=8)
    return int.from_bytes(digest.digest(), "little", signed=True)


def halves(items: DataFrame, length: int) -> DataFrame:
    """The two halves of each item's band of distances, as items of their own that know the anchor they come from."""
    schema = "root_key long, root long, key long, context long, n long, low int, high int, begin int, end int, content binary"
    fields = [f.split(" ") for f in schema.split(", ")]
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    arrow = pa.schema([(name, types[kind]) for name, kind in fields])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                low, high, content = row["low"], row["high"], row["content"]
                middle = (row["begin"] + row["end"]) // 2
                for begin, end in ((row["begin"], middle), (middle + 1, row["end"])):
                    near, far = max(low, begin), min(high, end)
                    if near > far:
                        continue
                    own = content[high - far : high - near + length]
                    core = content[high - begin : high - end + length]
                    made.append(
                        row | {"key": _number(core, row["key"], begin), "context": _number(own, near, far), "low": near, "high": far}
                        | {"begin": begin, "end": end, "content": own}
                    )
            yield pa.RecordBatch.from_pylist(made, arrow)

    return in_tasks(items, work, schema)


def _with_size(items: DataFrame) -> DataFrame:
    """Adds how many items there are with the same key; a frequent key is spread over many tasks."""
    return spread_join(items, items.groupBy("key").agg(F.count("*").alias("size")), "key", ["context"])


def windows_of(spark: SparkSession, items: DataFrame, length: int, group: int) -> DataFrame:
    """``key, context, ranges`` for all items, large groups by halves.  There may be several rows of an item.

    What a round finds is written before the next one, so that no plan holds several rounds: after each of its stages
    Spark plans the rest anew and reports it whole, in the driver.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    piece = max(1, length // 4)
    level = items.select("*", F.lit(0).alias("begin"), F.lit(length - piece).alias("end"))
    found = stored(spark, compare(level.where(F.col("size") <= group), length, tasks), "ranges")
    links = None
    # Each round halves the distances, so that there are as many as ``length`` has bits.
    while not level.where(F.col("size") > group).isEmpty():
        large = level.where(F.col("size") > group)
        if links is None:
            large = large.select("*", F.col("key").alias("root_key"), F.col("context").alias("root"))
        else:
            # The item may stand for several anchors' contexts.
            large = spread_join(links.withColumnRenamed("key", "_key"), large.drop("n"), "context", ["root"])
            large = large.where(F.col("key") == F.col("_key")).drop("_key")
        parts = stored(spark, halves(large.drop("size"), length), "halves")
        links = parts.select("root_key", "root", "key", "context", "n")
        same = parts.groupBy("key", "context", "low", "high", "begin", "end")
        level = stored(spark, _with_size(same.agg(F.sum("n").alias("n"), F.first("content").alias("content"))), "items")
        part = compare(level.where(F.col("size") <= group), length, tasks).withColumnRenamed("key", "_key")
        back = spread_join(links, part, "context", ["root"]).where(F.col("key") == F.col("_key"))
        back = back.select(F.col("root_key").alias("key"), F.col("root").alias("context"), "ranges")
        found = found.unionByName(stored(spark, back, "ranges"))
    return found


def covered(spark: SparkSession, texts: DataFrame, length: int, group: int) -> DataFrame:
    """Per text with repeated windows: ``mark`` and ``cuts``, structs of ``begin`` and ``end`` in no order."""
    found = stored(spark, anchors(texts, length), "anchors")
    keys = found.groupBy("key").agg(F.sum("n").alias("all"), (F.min("context") != F.max("context")).alias("mixed"))
    again = spread_join(found, keys.where("all > 1").select("key", "mixed"), "key", ["mark", "x"])
    again = stored(spark, again, "repeated-anchors")
    mixed = again.where("mixed")
    contexts = mixed.groupBy("key", "context", "low", "high").agg(F.sum("n").alias("n"), F.min(F.struct("mark", "x")).alias("at"))
    contexts = _with_size(contexts)
    asked = contexts.groupBy("at.mark").agg(F.collect_list(F.struct("key", "context", "n", "low", "high", "size", "at.x")).alias("asked"))
    items = stored(spark, fetch(texts.select("mark", "text").join(asked, "mark"), length), "items")
    ranges = windows_of(spark, items, length, group)
    some = spread_join(mixed.withColumnRenamed("key", "_key"), ranges, "context", ["mark", "x"]).where(F.col("key") == F.col("_key"))
    whole = again.where("NOT mixed").withColumn("ranges", F.array("low", "high"))
    hits = whole.select("mark", "x", "run", "ranges").unionByName(some.select("mark", "x", "run", "ranges"))
    pairs = F.expr("transform(sequence(1, cast(size(ranges) / 2 as int)), k -> struct(x - ranges[2 * k - 1] AS begin, x + run - 1 - ranges[2 * k - 2] AS last))")
    return hits.select("mark", F.inline(pairs)).groupBy("mark").agg(
        F.collect_list(F.struct("begin", (F.col("last") + length).alias("end"))).alias("cuts")
    )


def fetch(asked: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts that are asked for, from their texts."""
    schema = pa.schema(
        [("key", pa.int64()), ("context", pa.int64()), ("n", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("size", pa.int64()), ("content", pa.binary())]
    )

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts, lists = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", "asked"))
            for text, wanted in zip(texts, lists, strict=True):
                # A context may be nearly 2 * length long; long texts have many.
                for begin in range(0, len(wanted), 4096):
                    rows = wanted[begin : begin + 4096]
                    cut = [w | {"content": text[w["x"] - w["high"] : w["x"] - w["low"] + length]} for w in rows]
                    yield pa.RecordBatch.from_pylist(cut, schema)

    return in_tasks(asked, work, "key long, context long, n long, low int, high int, size long, content binary")


def without(texts: DataFrame) -> DataFrame:
    """Per row of ``mark, text, cuts``: ``n_removed, n_spans, kept_sha256`` and ``spans``, an array of begins and ends."""
    names = ["mark", "n_removed", "n_spans", "kept_sha256", "spans"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for mark, text, cuts in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("mark", "text", "cuts")), strict=True):
                spans: list[list[int]] = []
                for begin, end in sorted((c["begin"], c["end"]) for c in cuts):
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([begin, end])
                kept = sha256()
                edges = [0, *(e for span in spans for e in span), len(text)]
                for begin, end in zip(edges[::2], edges[1::2], strict=True):
                    kept.update(text[begin:end])
                rows.append((mark, sum(e - b for b, e in spans), len(spans), kept.hexdigest(), edges[1:-1]))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    return in_tasks(texts, work, "mark binary, n_removed long, n_spans long, kept_sha256 string, spans array<int>")


def remove_repeats(
    spark: SparkSession, docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text", group: int = GROUP
) -> DataFrame:
    """Per row: the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans``.

    A byte of a text's UTF-8 goes if a string of ``length`` bytes that covers it also begins elsewhere, in the same text (also
    overlapping itself) or another.  All is judged on the texts as they come.  ``spans`` holds begin and end of each
    maximal run that goes, in bytes; see :func:`kept_text`.  A null text is empty; texts shorter than ``length`` keep
    everything.  Rows may repeat and ids may be null: each row gives a row, and equal texts of ``length`` bytes or more lose all.
    An empty table gives no rows.  Other columns are left out.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    read = docs.select(F.col(id_column).alias("id"), text.alias("text"))
    sums = read.select("id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sum"))
    long = read.where(F.octet_length("text") >= length).select(_mark(F.sha2("text", 256)).alias("mark"), "text")
    alone = long.groupBy("mark").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    size = read.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    texts = stored_in_buckets(spark, alone, "texts", "mark", buckets)
    cuts = covered(spark, texts, length, group)
    found = stored(spark, without(texts.select("mark", "text").join(cuts, "mark")), "removed")
    results = texts.select("mark").join(found, "mark", "left").withColumn("mark", F.hex("mark"))
    nothing = [F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.col("sum").alias("kept_sha256")]
    short = sums.where(F.col("n_bytes") < length).select("id", "n_bytes", *nothing, F.array().cast("array<int>").alias("spans"))
    # Equal texts are few or very many.
    rest = spread_join(sums.where(F.col("n_bytes") >= length).withColumn("mark", F.hex(_mark(F.col("sum")))), results, "mark", ["id"])
    zero = F.lit(0).cast("long")
    rest = rest.select(
        "id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sum").alias("kept_sha256"), F.coalesce("spans", F.array().cast("array<int>")).alias("spans"),
    )
    return short.unionByName(rest).withColumnRenamed("id", id_column)


def _mark(checksum: Column) -> Column:
    """Half of a SHA-256: 128 bits."""
    return F.unhex(F.substring(checksum, 1, 32))


def kept_text(text: Column, spans: Column) -> Column:
    """The bytes that stay; they need not be whole characters."""
    raw = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    edges = F.concat(F.array(F.lit(0)), spans, F.array(F.octet_length(raw)))
    pieces: Callable[[Column], Column] = lambda k: F.substr(raw, F.get(edges, 2 * k) + 1, F.get(edges, 2 * k + 1) - F.get(edges, 2 * k))
    count = (F.size(edges) / 2).cast("int")
    return F.aggregate(F.sequence(F.lit(0), count - 1), F.lit("").cast("binary"), lambda kept, k: F.concat(kept, pieces(k)))
