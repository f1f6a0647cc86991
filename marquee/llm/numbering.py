"""Gapless numbers within groups of any size, without meeting a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def numbered(frame: DataFrame, group: str, order: Sequence[str], name: str, buckets: int | None = None) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... within each value of ``group`` (not null).

    The rows of a group are dealt to ``buckets`` by a hash of ``order`` and numbered
    there; the counts of the buckets, one row each, say where every bucket begins.  Rows
    equal in ``order`` must be interchangeable.
    """
    if buckets is None:
        buckets = max(8, int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = frame.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(group, "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    placed = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        placed.join(begins, [group, "_bucket"])
        .withColumn(name, F.col("_place") + F.col("_begin"))
        .drop("_bucket", "_place", "_begin")
    )
