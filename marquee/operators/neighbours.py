"""Exact nearest items by cosine, without forming all pairs as rows."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import dot, settled
from marquee.operators.products import largest_products, matrix_of
from marquee.operators.skew import spread_join

SMALL_BLOCK = 1000


def _best_in_block(count: int) -> Callable[[pa.Table], pa.Table]:
    """For each asking vector of a block the ``count`` most similar items offered in it.

    All helpers are local, so that tasks need not import this package.
    """
    matrix, largest = matrix_of(), largest_products(count)

    def unit(table: pa.Table) -> np.ndarray:
        vectors = matrix(table)
        return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

    def best(block: pa.Table) -> pa.Table:
        left, right = block.filter(block["asks"]), block.filter(pc.invert(block["asks"])).sort_by("item")
        asking, offered = left["item"].combine_chunks(), right["item"].combine_chunks()
        parts = [pa.table({"group": asking[:0], "item": offered[:0], "similarity": pa.array([], pa.float64())})]
        if len(asking) and len(offered):
            parts += [
                pa.table({"group": asking.take(pa.array(rows)), "item": offered.take(pa.array(places)), "similarity": pa.array(value)})
                for rows, places, value in largest(unit(left), unit(right))
            ]
        return pa.concat_tables(parts)

    return best


def nearest_items(
    items: DataFrame,
    item: str,
    vector: str,
    count: int = 10,
    block_rows: int = 20_000,
) -> DataFrame:
    """The ``count`` most similar other items of every item, ties by item.

    Equal vectors are scored once.  A vector's best items hold at most
    ``count + 1`` items of any other vector, so that many stand for all its
    copies and nothing is lost.  Items move by two hashes of their vector, 128 bits in all;
    only different vectors move themselves.  Those that stand are dealt into blocks of about
    at most ``block_rows``; each pair of blocks is one matrix product in one
    task and hands on only the best items of each vector.  A vector whose squared
    length is zero, infinite or not a number has no direction: it gets no
    neighbours and is none.  Counting the vectors that stand, for the number of blocks, runs a job.
    """
    spare = count + 1
    # Floats move as they are, half as long, and become doubles where they are multiplied.
    number = "float" if items.schema[vector].dataType.simpleString() == "array<float>" else "double"
    numbers = F.transform(vector, lambda x: x.cast(number) + F.lit(0.0).cast(number))
    # Spark takes NaN for larger than any number, so it fails the second test below.
    squared = dot(F.col("vector"), F.col("vector"))
    pointed = (
        items.select(F.col(item).alias("item"), numbers.alias("vector"))
        .where(F.col("item").isNotNull() & (squared > 0) & (squared < F.lit(float("inf"))))
        .withColumns({"key": F.xxhash64("vector"), "check": F.xxhash64(F.lit(1), "vector")})
    )
    same = ["key", "check"]
    copies = pointed.groupBy(*same).agg(F.count("*").alias("n"))
    rows = copies.agg(F.coalesce(F.sum(F.least("n", F.lit(spare))), F.lit(0))).first()[0]
    tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    busy = min(ceil(tasks**0.5), ceil(rows / SMALL_BLOCK))
    blocks = max(1, busy, ceil(rows / block_rows))

    named = pointed.select("item", *same)
    in_order = Window.partitionBy(*same).orderBy("item")
    standing = named.withColumn("copy", F.row_number().over(in_order)).where(F.col("copy") <= spare)
    standing = standing.join(pointed.select(*same, "vector").distinct(), same)

    def dealt(name: str):
        return F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int")

    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    first = standing.where(F.col("copy") == 1)
    asking = first.select(F.lit(True).alias("asks"), "item", "vector", dealt("item").alias("row"), every.alias("column"))
    offered = standing.select(F.lit(False).alias("asks"), "item", "vector", dealt("item").alias("column"), every.alias("row"))
    kind = pointed.schema["item"].dataType.simpleString()
    scored = (
        asking.unionByName(offered)
        .groupBy("row", "column")
        .applyInArrow(_best_in_block(spare), f"group {kind}, item {kind}, similarity double")
    )
    ranking = Window.partitionBy("group").orderBy(F.desc(settled(F.col("similarity"))), "item")
    best = (
        scored.withColumn("place", F.row_number().over(ranking))
        .where(F.col("place") <= spare)
        .groupBy("group")
        .agg(F.sort_array(F.collect_list(F.struct("place", "item", "similarity"))).alias("best"))
    )
    groups = first.select(F.col("item").alias("group"), "key", F.col("check").alias("_check"))
    lists = groups.join(best, "group").select("key", "_check", "best")
    others = F.filter("best", lambda one: one["item"] != F.col("item"))
    return (
        spread_join(named, lists, "key", left_by=["item"])
        .where(F.col("check") == F.col("_check"))
        .select("item", F.posexplode(F.slice(others, 1, count)).alias("at", "one"))
        .select(
            F.col("item").alias(item),
            F.col("one.item").alias("neighbour"),
            F.col("one.similarity").alias("similarity"),
            (F.col("at") + 1).alias("rank"),
        )
    )
