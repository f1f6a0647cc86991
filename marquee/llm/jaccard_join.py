"""Documents linked by the Jaccard similarity of their word shingles, by T-occurrence search.

Two sets of a similarity of at least t share all but a few of their elements, so the search is for
documents that occur at least T times in the inverted lists of a document's shingles.  As in
DivideSkip, short lists are merged and counted, and long lists are only probed for those that
could still reach T.  Lists are short or long by the number of documents that have a shingle;
that number is counted over all documents, and the most frequent shingles go last in one order of
all shingles.

1. Documents of equal sets become one class.
2. Each class offers the first few shingles of its set (those that no two linked sets can both
   miss).  Short lists of these give pairs with counts; pairs that cannot reach T even with all
   long lists go.  Classes whose offered shingles are partly frequent meet through long lists:
   they form clusters, without pairs.
3. The sets of what is left are compared in blocks of a cluster by DivideSkip itself; links
   within what is already linked are not looked for.  Where the blocks of large clusters would
   need many copies of the sets at once, they meet in several rounds.
4. The links' connected components are the result.

Elements are 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.batches import buffer_of, slices
from marquee.llm.components import components
from marquee.llm.numbering import numbered
from marquee.llm.shipping import in_tasks, ship
from marquee.llm.storage import drop, stored
from marquee.llm.wordhash import gram_hashes, mixed, space_words, word_hashes, word_spans, words_per_text

#: A shingle in more documents than this has a long list.
LONG_LIST = 24
#: Bits at most that mark the shingles of long lists, which the tasks know, and bits for one of them where that is fewer.  One marked by
#: chance goes late in the order, too, so that this bounds memory and changes no result.
KNOWN_LONG, BITS_EACH = 1 << 28, 64
#: Classes compared in one task are two blocks of this size at most.
BLOCK = 256
#: Bits that mark which documents' sets are wanted; documents marked by chance are left out later.
MARKS = 1 << 24
#: Copies of all compared sets, by their shingles, that a round of meeting blocks moves at most, if more than a single offset of blocks.
COPIES = 3
_DELTA = 1e-9


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The set of each text as sorted hashes; shorter texts have one shingle, empty ones none."""
    raw, starts = buffer_of(texts)
    begins, ends = word_spans(raw, starts, space_words())
    words = word_hashes(raw, begins, ends)
    grams = gram_hashes(words, width)
    bounds = words_per_text(begins, starts).tolist()
    for first, last in zip(bounds, bounds[1:], strict=False):
        if last - first >= width:
            yield np.unique(grams[first : last - width + 1])
        else:
            yield gram_hashes(words[first:last], last - first) if last > first else grams[:0]


def smallest_overlap(size: int, threshold: float) -> int:
    """Elements that a set of ``size`` shares at least with any set it is linked with."""
    return ceil(threshold * size - _DELTA)


def _bounds(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def planes(value: np.ndarray) -> bytes:
    """Sorted 32-bit numbers, upper halves first: those repeat, so that a shuffle's compression takes about half of the bytes."""
    return (value >> np.uint32(16)).astype(np.uint16).tobytes() + value.astype(np.uint16).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    high, low = np.frombuffer(raw, np.uint16).reshape(2, -1).astype(np.uint32)
    return (high << np.uint32(16)) | low


def bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """``bits`` bits in words of 64, of which those in the column ``slot`` of whole numbers are set."""
    words = slots.groupBy(F.shiftright("slot", 6).cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, CAST(slot % 64 AS INT)))").alias("bits"))
    found = words.toArrow()
    marks = np.zeros(-(-bits // 64), np.uint64)
    marks[np.asarray(found["word"])] = np.asarray(found["bits"]).view(np.uint64)
    return marks


def is_set(marks: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (marks[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def long_lists(read: DataFrame, width: int, buckets: int) -> tuple[np.ndarray, int]:
    """Marks of all shingles with a long list, and the number of their bits, over which the leading 32 bits of a shingle are dealt in order.

    Every task counts its documents' shingles and sends them sorted, in ``buckets`` by value; the
    counts of a bucket are summed in one task.  Two shingles that agree in these bits count
    together: that can only make a list look longer, which changes the order and no result.
    """

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counted in memory up to a size, then sent on.
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            value, count = np.unique(np.concatenate(held), return_counts=True)
            bucket = (value.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(cuts))
            small = np.minimum(count, 255).astype(np.uint8)
            # Counts above one byte are written as repeated values.
            rest = count - small
            extra = np.repeat(value, np.ceil(rest / 255).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some.astype(np.int32)),
                    pa.array([planes(value[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
                    pa.array([small[cuts[b] : cuts[b + 1]].tobytes() for b in some], pa.binary()),
                ],
                ["bucket", "value", "count"],
            )
            if len(extra):
                bucket = ((extra.astype(np.uint64) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)
                full = [bytes([255])] * len(extra)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array([planes(extra[k : k + 1]) for k in range(len(extra))], pa.binary()), pa.array(full, pa.binary())],
                    ["bucket", "value", "count"],
                )

        for batch in slices(batches, "text"):
            for found in shingle_sets(_bounds(batch, "text"), width):
                held.append((found >> np.uint64(32)).astype(np.uint32))
                size += len(found)
            if size > 4_000_000:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    def total(key: tuple, table: pa.Table) -> pa.Table:  # noqa: ARG001
        value = np.concatenate([from_planes(raw) for raw in table["value"].to_pylist()])
        count = np.frombuffer(b"".join(table["count"].to_pylist()), np.uint8)
        found, back = np.unique(value, return_inverse=True)
        sums = np.bincount(back, count).astype(np.int64)
        return pa.table({"value": found[sums > LONG_LIST].astype(np.int64)})

    sent = in_tasks(read, send, "bucket int, value binary, count binary")
    long = stored(read.sparkSession, sent.groupBy("bucket").applyInArrow(total, "value long"), "frequent")
    bits = min(KNOWN_LONG, BITS_EACH * max(1, long.count()))
    marks = bitmap(long.select(F.shiftright(F.col("value") * bits, 32).alias("slot")), bits)
    drop(read.sparkSession, long)
    return marks, bits


def signatures(spark: SparkSession, read: DataFrame, width: int, threshold: float, known: tuple[np.ndarray, int]) -> DataFrame:
    """Per document ``id``, set size ``n``, fingerprint ``f1``, ``f2``, and the offered shingles ``rare``, ``often``."""
    shared = spark.sparkContext.broadcast(known)
    kind = read.schema["id"].dataType.simpleString()

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bits = shared.value
        for batch in slices(batches, "text"):
            rows = []
            for found in shingle_sets(_bounds(batch, "text"), width):
                size = len(found)
                offered = size - smallest_overlap(size, threshold) + 1 if size else 0
                long = is_set(marks, (((found >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32)).astype(np.int64))
                rare, often = found[~long][:offered], found[long]
                often = often[: offered - len(rare)]
                one, two = mixed(found), mixed(found ^ np.uint64(0x5851F42D4C957F2D))
                rows.append((size, one.sum(dtype=np.uint64), two.sum(dtype=np.uint64), rare, often))
            if rows:
                size, one, two, rare, often = zip(*rows, strict=True)
                lists = [pa.array([x.astype(np.int64) for x in column], pa.list_(pa.int64())) for column in (rare, often)]
                sums = [pa.array(np.array(column, np.uint64).astype(np.int64)) for column in (one, two)]
                yield pa.RecordBatch.from_arrays(
                    [_bounds(batch, "id"), pa.array(size, pa.int64()), *sums, *lists], ["id", "n", "f1", "f2", "rare", "often"]
                )

    return in_tasks(read, sign, f"id {kind}, n long, f1 long, f2 long, rare array<long>, often array<long>")


def candidates(classes: DataFrame, threshold: float) -> DataFrame:
    """Links ``a``, ``b`` that may hold, or that lead to the smallest class of a long list."""

    def offered(n: Column) -> Column:
        return n - F.ceil(threshold * n - _DELTA) + 1

    # Set size and number of long lists in one number: these rows are the bulk of what is shuffled.
    sizes = F.shiftleft("n", 31) + F.size("often")
    short = (
        classes.select("node", sizes.alias("sizes"), F.explode("rare").alias("shingle"))
        .groupBy("shingle")
        .agg(F.array_sort(F.collect_list(F.struct("node", "sizes"))).alias("list"))
        .where(F.size("list") > 1)
    )
    pairs = (
        short.select("list", F.posexplode("list").alias("at", "x"))
        .select("x", F.explode(F.slice("list", F.col("at") + 2, F.size("list"))).alias("y"))
    )
    n = [F.shiftright(F.col(side)["sizes"], 31) for side in "xy"]
    long = [F.col(side)["sizes"].bitwiseAND((1 << 31) - 1) for side in "xy"]
    possible = (n[0] >= threshold * n[1] - _DELTA) & (n[1] >= threshold * n[0] - _DELTA)
    # Of T shared elements the sets' other parts can give at most ``rest``, long lists at most ``long``.
    needed = F.ceil(threshold / (1 + threshold) * (n[0] + n[1]) - _DELTA)
    rest = F.greatest(*(size - offered(size) for size in n))
    counted = pairs.where(possible).groupBy("x", "y").agg(F.count("*").alias("shared"))
    likely = counted.where(F.col("shared") + F.least(*long) >= needed - rest)
    frequent = classes.select("node", F.explode("often").alias("shingle"))
    first = frequent.groupBy("shingle").agg(F.min("node").alias("b"), F.count("*").alias("s")).where("s > 1").drop("s")
    through = frequent.join(first, "shingle").select(F.col("node").alias("a"), "b")
    return (
        likely.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
        .unionByName(through)
        .where("a <> b")
        .distinct()
    )


def wanted_sets(spark: SparkSession, read: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``id`` and ``set`` of the documents ``nodes``; the tasks first pass over those not marked.

    The marks are a bitmap of fixed size, by a hash of the id.
    """
    slot = F.pmod(F.xxhash64("node"), F.lit(MARKS))
    shared = spark.sparkContext.broadcast(bitmap(nodes.select(slot.alias("slot")), MARKS))
    kind = read.schema["id"].dataType.simpleString()

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value

        def marked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                slot = np.asarray(_bounds(batch, "slot")).astype(np.int64)
                yield batch.filter(pa.array(is_set(marks, slot)))

        for batch in slices(marked(), "text"):
            sets = [found.tobytes() for found in shingle_sets(_bounds(batch, "text"), width)]
            yield pa.RecordBatch.from_arrays([_bounds(batch, "id"), pa.array(sets, pa.binary())], ["id", "set"])

    slotted = read.where("id IS NOT NULL").withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(MARKS)).cast("int"))
    return in_tasks(slotted, keep, f"id {kind}, set binary").withColumnRenamed("id", "node")


class Block:
    """Inverted lists of some sets, and T-occurrence search over them."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        order = np.lexsort((owner, flat))
        self.owner = owner[order]
        self.shingles, first = np.unique(flat[order], return_index=True)
        self.first = np.concatenate([first, [len(flat)]])
        self.sizes = np.array([len(s) for s in sets])

    def search(self, query: np.ndarray, wanted: np.ndarray, threshold: float) -> np.ndarray:
        """Of the sets marked in ``wanted``, those linked with the query."""
        low = smallest_overlap(len(query), threshold)
        place = np.minimum(np.searchsorted(self.shingles, query), len(self.shingles) - 1)
        place = place[self.shingles[place] == query]
        if len(place) < low:
            return np.zeros(0, np.int64)
        begin, end = self.first[place], self.first[place + 1]
        order = np.argsort(end - begin, kind="stable")
        begin, end = begin[order], end[order]
        # The longest lists are probed: fewer than T of them, more if they are longer (as DivideSkip has it).
        longest = int(end[-1] - begin[-1])
        probed = min(low - 1, int(low / (0.05 * np.log2(longest + 1) + 1))) if longest > 1 else 0
        merged = len(place) - probed
        length = (end - begin)[:merged]
        at = np.repeat(begin[:merged] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        count = np.bincount(self.owner[at], minlength=len(self.sizes))
        needed = np.ceil(threshold / (1 + threshold) * (len(query) + self.sizes) - _DELTA)
        left = np.flatnonzero(wanted & (count + probed >= needed))
        for k in range(merged, len(place)):
            if not len(left):
                break
            line = self.owner[begin[k] : end[k]]
            spot = np.minimum(np.searchsorted(line, left), len(line) - 1)
            count[left] += line[spot] == left
            left = left[count[left] + (len(place) - 1 - k) >= needed[left]]
        return left


def _linked(threshold: float) -> Callable[[tuple, pa.Table], pa.Table]:
    """Links between the sets of two blocks (or within one), enough to connect what is connected."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:  # noqa: ARG001
        side, node = np.asarray(table["side"]), np.asarray(table["node"])
        sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        root, made = np.unique(np.asarray(table["label"]), return_inverse=True)[1], []
        held, asking = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = not len(asking)
        index = Block([sets[k] for k in held])
        for rank, k in enumerate(held if within else asking):
            apart = root[held] != root[k]
            if within:
                apart &= np.arange(len(held)) < rank
            for found in held[index.search(sets[k], apart, threshold)] if apart.any() else ():
                if root[found] != root[k]:
                    root[root == root[found]] = root[k]
                    made.append((int(node[k]), int(node[found])))
        a, b = zip(*made, strict=True) if made else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compare


def links(spark: SparkSession, clusters: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links that hold, compared in blocks, or others that connect the same; ``clusters`` has ``node``, ``root`` and ``n``.

    The classes of a cluster are parted by size into bands, and bands into blocks.  Sizes that allow
    a link are in one band or in neighbouring ones, so only such blocks meet.  The pairs of blocks of a
    cluster grow with its square, and each needs a copy of its sets, so that they meet in rounds by
    the distance of their places: within one distance a block meets four others at most.  Blocks
    that a round has found to be linked as a whole meet no more.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(-log(threshold))).cast("int")
    banded = clusters.withColumn("band", band).withColumn("group", F.xxhash64("root", "band"))
    blocks = numbered(banded, "group", ["node", "root", "band"], "place").withColumn("block", F.floor(F.col("place") / BLOCK))
    blocks = stored(spark, blocks.select("root", "band", "block", "node", "n"), "blocks")
    whole = blocks.agg(F.sum("n")).first()[0] or 0
    found, done = None, -1
    while True:
        labelled = blocks.withColumn("label", F.col("node"))
        if found is not None:
            labels = found.select(F.col("a").alias("node"), F.col("b").alias("root_of"))
            labelled = blocks.join(labels, "node", "left").withColumn("label", F.coalesce("root_of", "node")).drop("root_of")
        pairs = meeting(labelled, threshold).where(F.col("distance") > done)
        moved = pairs.groupBy("distance").agg(F.sum("moved").alias("moved")).orderBy("distance").collect()
        if not moved:
            return found if found is not None else blocks.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        taken, done = moved[0]["moved"], moved[0]["distance"]
        for row in moved[1:]:
            if taken + row["moved"] > COPIES * whole:
                break
            taken, done = taken + row["moved"], row["distance"]
        last = done == moved[-1]["distance"]
        if found is None and not last:
            sets = stored(spark, sets, "sets")
        compared = compare(labelled, pairs.where(F.col("distance") <= done), sets, threshold)
        if found is None and last:
            return compared
        # What is linked so far, each class with the smallest one.
        joined = components(spark, compared if found is None else found.unionByName(compared))
        before, found = found, stored(spark, joined.select(F.col("node").alias("a"), F.col("root").alias("b")), "linked")
        if before is not None:
            drop(spark, before)
        if last:
            drop(spark, sets)
            return found


def meeting(blocks: DataFrame, threshold: float) -> DataFrame:
    """Pairs of blocks that may hold links: the structs ``one`` and ``two``, ``same`` if these are one block, how far apart their places are, and
    the sizes of their sets, ``moved``.  Two blocks with the same single ``label`` are left out."""
    about = blocks.groupBy("root", "band", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.sum("n").alias("all"), F.min("label").alias("first"), F.max("label").alias("last")
    )
    count = Window.partitionBy("root", "band")
    about = about.withColumn("blocks", F.max("block").over(count) + 1)
    one, two = about.alias("one"), about.withColumn("meets", F.explode(F.array("band", F.col("band") - 1))).alias("two")
    same = (F.col("one.band") == F.col("two.band")) & (F.col("one.block") == F.col("two.block"))
    later = (F.col("two.band") > F.col("one.band")) | (F.col("two.block") >= F.col("one.block"))
    # A size on the edge of a band may be put on either side of it.
    near = F.col("one.high") >= threshold * F.col("two.low") - _DELTA
    apart = F.least("one.first", "two.first") < F.greatest("one.last", "two.last")
    met = one.join(two, (F.col("one.root") == F.col("two.root")) & (F.col("one.band") == F.col("two.meets")) & later & near & apart)
    distance = F.pmod(F.col("two.block") - F.col("one.block"), F.greatest("one.blocks", "two.blocks"))
    moved = F.col("one.all") + F.when(same, 0).otherwise(F.col("two.all"))
    sides = [F.struct(*(F.col(f"{b}.{c}").alias(c) for c in ("root", "band", "block"))).alias(b) for b in ("one", "two")]
    return met.select(*sides, same.alias("same"), distance.alias("distance"), moved.alias("moved"))


def compare(blocks: DataFrame, pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links ``a``, ``b`` between the sets of each pair of blocks, but for those within a ``label``."""
    sides = [F.struct(f"{b}.root", f"{b}.band", f"{b}.block", F.lit(k).alias("side")) for k, b in enumerate(("one", "two"))]
    pair = F.xxhash64("one.root", "one.band", "one.block", "two.band", "two.block").alias("pair")
    places = pairs.select(pair, F.inline(F.when(F.col("same"), F.array(sides[0])).otherwise(F.array(*sides))))
    members = places.join(blocks.select("root", "band", "block", "node", "label"), ["root", "band", "block"])
    compared = members.join(sets, "node").select("pair", "side", "node", "label", "set").groupBy("pair")
    return compared.applyInArrow(_linked(threshold), "a long, b long")


def near_duplicates(
    spark: SparkSession,
    docs: DataFrame,
    width: int = 5,
    threshold: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id reachable over links.

    Words are parted by white space and lose the case of A-Z; a shingle is ``width`` words, or all words of a
    shorter text.  Two documents are linked if their sets' Jaccard similarity is at least
    ``threshold``.  Null, empty and blank texts have no shingles and no links.  Ids are whole
    numbers; repeated rows are one document, and texts that share their smallest id are taken as
    linked.  A null id has a null component.  Other columns are left out.
    """
    ship(spark)
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = long_lists(read, width, max(64, 2 * tasks))
    signed = stored(spark, signatures(spark, read, width, threshold, known), "signatures")
    equal = ["n", "f1", "f2"]
    classes = (
        signed.where("n > 0 AND id IS NOT NULL")
        .groupBy(*equal)
        .agg(F.min("id").alias("node"), F.first("rare").alias("rare"), F.first("often").alias("often"))
    )
    # Gapless runs of numbers take far fewer bytes of a shuffle than ids, which may be hashes.
    offering = stored(spark, classes.withColumn("number", F.monotonically_increasing_id()), "offering")
    # What the classes offer is read once more, for the candidates; later steps need only the rest.
    slim = stored(spark, signed.select("id", *equal), "sizes")
    drop(spark, signed)
    classes = stored(spark, offering.select(*equal, "node", "number"), "classes")
    clusters = components(spark, candidates(offering.drop("node").withColumnRenamed("number", "node"), threshold))
    drop(spark, offering)
    clusters = clusters.withColumnRenamed("node", "number")
    grouped = stored(spark, clusters.join(classes.select("number", "node", "n"), "number").drop("number"), "clusters")
    sets = wanted_sets(spark, read, grouped.select("node"), width)
    roots = components(spark, links(spark, grouped, sets, threshold))
    labelled = classes.select(*equal, "node").join(roots, "node", "left")
    labelled = labelled.select(*equal, F.coalesce("root", "node").alias("label"))
    return slim.join(labelled, equal, "left").select(
        F.col("id").cast(docs.schema[id_column].dataType).alias(id_column),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("label", "id")).alias("component_id"),
    )
