"""Nearest items by cosine for tables too large for all pairs: random hyperplanes and sorted signatures.

An item's signature in a hash table says on which side of each of the table's planes it lies.  Items that agree in many leading
bits are alike, and lie near each other when the table is put in order.  That order is cut into blocks of equal size, twice, the second
time shifted by half a block, and only items of a block are compared, exactly.  So no bucket is ever too
full, the work grows with the number of items, and more tables or larger blocks find more of the true neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from math import floor, sin

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import dot, settled
from marquee.sources.scratch import scratch_folder


@dataclass(frozen=True)
class Hashing:
    """How items are hashed and compared: ``tables`` of ``planes`` planes each, and the items of a block."""

    tables: int = 16
    planes: int = 20
    block: int = 256

    def __post_init__(self) -> None:
        if min(self.tables, self.planes) < 1 or self.planes > 62 or self.block < 2:
            raise ValueError("at least one table, 1 to 62 planes and blocks of two items are needed")


def coefficient(plane: int, dimension: int) -> float:
    """A number between -0.5 and 0.5 that is the same in every engine and on every run."""
    value = sin(plane * 977 + dimension * 131 + 7) * 43758.5453
    return value - floor(value) - 0.5


def _planes(first: int, count: int, size: int) -> np.ndarray:
    return np.array([[coefficient(p, d) for d in range(size)] for p in range(first, first + count)])


def directed(items: DataFrame, item: str, vector: str) -> DataFrame:
    """``item`` and ``vector`` of the rows that have both and a direction: no null, endless or zero length."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    squared = dot(F.col("vector"), F.col("vector"))
    named = items.select(F.col(item).alias("item"), numbers.alias("vector"))
    return named.where(F.col("item").isNotNull() & (squared > 0) & (squared < F.lit(float("inf"))))


def mean_vector(pointed: DataFrame, size: int) -> list[float]:
    """The mean of vectors of one size: a row per task, then a row per dimension."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size), 0
        for batch in batches:
            total += np.asarray(batch.column(0).flatten()).reshape(-1, size).sum(axis=0)
            rows += batch.num_rows
        if rows:
            yield pa.RecordBatch.from_pylist([{"rows": rows, "total": total.tolist()}], pa.schema([("rows", pa.int64()), ("total", pa.list_(pa.float64()))]))

    sums = pointed.select("vector").mapInArrow(partial, "rows long, total array<double>")
    means = sums.select("rows", F.posexplode("total").alias("at", "total")).groupBy("at").agg((F.sum("total") / F.sum("rows")).alias("mean"))
    return [row["mean"] for row in means.orderBy("at").collect()]


def signatures(pointed: DataFrame, size: int, mean: list[float], how: Hashing) -> DataFrame:
    """``item``, ``hash_table`` and ``signature``, a row per item and table; planes go through the mean."""
    kind = pointed.schema["item"].dataType.simpleString()
    planes, tables = how.planes, how.tables
    normals = _planes(0, planes * tables, size).T
    weights = 1 << np.arange(planes - 1, -1, -1, dtype=np.int64)
    centre = np.array(mean)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if rows:
                matrix = np.asarray(batch.column(1).flatten()).reshape(rows, size) - centre
                sides = (matrix @ normals > 0).reshape(rows, tables, planes)
                found = (sides @ weights).ravel()
                items = batch.column(0).take(pa.array(np.repeat(np.arange(rows), tables)))
                number = pa.array(np.tile(np.arange(tables, dtype=np.int32), rows))
                yield pa.RecordBatch.from_arrays([items, number, pa.array(found)], ["item", "hash_table", "signature"])

    return pointed.select("item", "vector").mapInArrow(work, f"item {kind}, hash_table int, signature long")


def in_blocks(signed: DataFrame, how: Hashing) -> DataFrame:
    """``item, hash_table, shift, block``: twice per table and item.

    The order goes over all tasks.  It is written once, so that each row's place in its task's part
    is settled; adding what the parts before hold makes it a place in the table.
    """
    spark = signed.sparkSession
    order = ["hash_table", "signature", "item"]
    path = scratch_folder(spark, "signatures")
    placed = signed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    written = spark.read.parquet(path).withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND((1 << 33) - 1))
    # One row per part and table; the window sees these only.
    counts = written.groupBy("_part", "hash_table").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("hash_table").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("_part").orderBy("hash_table").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part",
        "hash_table",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.coalesce(F.sum("_rows").over(within), F.lit(0))).alias("_start"),
    )
    ranked = written.join(starts, ["_part", "hash_table"]).withColumn("_rank", F.col("_at") + F.col("_start"))
    shifts = F.array(F.lit(0), F.lit(how.block // 2))
    spread = ranked.select("item", "hash_table", "_rank", F.explode(shifts).alias("shift"))
    return spread.select("item", "hash_table", "shift", F.floor((F.col("_rank") + F.col("shift")) / how.block).alias("block"))


def _best_of_blocks(count: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each item of a block the ``count`` most similar others of it.  Helpers are local, for tasks need not import this package."""
    place = ["hash_table", "shift", "block"]

    def best(group: pa.Table) -> pa.RecordBatch:
        items, rows = group["item"].combine_chunks(), group.num_rows
        matrix = np.stack([np.asarray(v, dtype=float) for v in group["vector"].to_pylist()])
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        similar = matrix @ matrix.T
        np.fill_diagonal(similar, -np.inf)
        kept = min(count, rows - 1)
        # Items are in order, so that a stable sort settles ties.
        order = np.argsort(-similar.round(9), axis=1, kind="stable")[:, :kept]
        left = pa.array(np.repeat(np.arange(rows), kept))
        value = np.take_along_axis(similar, order, axis=1).ravel()
        return pa.RecordBatch.from_arrays([items.take(left), items.take(pa.array(order.ravel())), pa.array(value)], ["item", "neighbour", "similarity"])

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([np.asarray(batch.column(batch.schema.get_field_index(c))).astype(np.int64) for c in place], axis=1)
            cuts = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                now = tuple(names[begin].tolist())
                if held and now != last:
                    yield best(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(begin, end - begin))
                last = now
        if held:
            yield best(pa.Table.from_batches(held))

    return work


def approximate_neighbours(items: DataFrame, item: str, vector: str, count: int = 10, how: Hashing = Hashing()) -> DataFrame:
    """About the ``count`` most similar other items of every item, by exact cosine, ties by item.

    ``item`` is unique.  Rows without an item or a direction take no part; all vectors have the size of the most frequent one, and rows of
    another size take no part either.  No rows come of fewer than two items.  Finding size and mean runs small jobs.
    """
    pointed = directed(items, item, vector)
    size = most_frequent_size(pointed)
    pointed = pointed.where(F.size("vector") == size)
    kind = pointed.schema["item"].dataType.simpleString()
    if size == 0:
        found = pointed.select("item", F.col("item").alias("neighbour"), F.lit(0.0).alias("similarity"))
    else:
        blocks = in_blocks(signatures(pointed, size, mean_vector(pointed, size), how), how)
        place = ["hash_table", "shift", "block"]
        tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = blocks.join(pointed, "item").repartition(tasks, *place).sortWithinPartitions(*place, "item")
        found = dealt.select(*place, "item", "vector").mapInArrow(_best_of_blocks(count), f"item {kind}, neighbour {kind}, similarity double")
    # The same pair may have met in several tables.
    once = found.groupBy("item", "neighbour").agg(F.max("similarity").alias("similarity"))
    ranking = Window.partitionBy("item").orderBy(F.desc(settled(F.col("similarity"))), "neighbour")
    ranked = once.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= count)
    return ranked.select(F.col("item").alias(item), "neighbour", "similarity", "rank")


def most_frequent_size(pointed: DataFrame) -> int:
    """The size that most vectors have, the larger one of equally frequent ones; 0 without vectors."""
    sizes = pointed.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows"))
    most = sizes.agg(F.max(F.struct("rows", "size")).alias("most")).first()["most"]
    return most["size"] if most else 0


def compared_pairs(items: DataFrame, item: str, vector: str, how: Hashing = Hashing()) -> DataFrame:
    """One row: ``compared``, the products of two vectors that :func:`approximate_neighbours` makes, and ``all_pairs``."""
    pointed = directed(items, item, vector)
    pointed = pointed.where(F.size("vector") == most_frequent_size(pointed))
    rows = pointed.agg(F.count("*").alias("rows")).scalar()
    shifts = [0, how.block // 2]

    def pairs(shift: int) -> Column:
        # Blocks are full but for the first and the last one.
        first = F.least(F.col("rows"), F.lit(how.block - shift))
        rest = F.col("rows") - first
        last = rest % how.block
        full = (rest - last) / how.block
        return first * (first - 1) / 2 + full * (how.block * (how.block - 1) / 2) + last * (last - 1) / 2

    counted = items.sparkSession.range(1).select(rows.alias("rows"))
    compared = sum((pairs(s) for s in shifts[1:]), pairs(shifts[0])) * how.tables
    return counted.select(compared.cast("long").alias("compared"), (F.col("rows") * (F.col("rows") - 1) / 2).cast("long").alias("all_pairs"))


def recall(found: DataFrame, exact: DataFrame, item: str) -> DataFrame:
    """One row: ``neighbours`` in ``exact`` and ``recall``, the share of them that ``found`` holds, too."""
    both = exact.select(item, "neighbour").join(found.select(item, "neighbour", F.lit(1).alias("_hit")), [item, "neighbour"], "left")
    return both.agg(F.count("*").alias("neighbours"), F.try_divide(F.count("_hit"), F.count("*")).alias("recall"))
