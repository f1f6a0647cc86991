"""A join that does not tie a very frequent key to one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FREQUENT_SHARE = 0.001
# A sketch cannot track more keys than ten times the inverse.
SMALLEST_SHARE = 0.00001


def uneven_share(frame: DataFrame) -> float:
    """Share of the rows that makes a key frequent: half of a task's even share, 0.1 % at most."""
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(SMALLEST_SHARE, min(FREQUENT_SHARE, 0.5 / tasks))


def frequent_keys(frame: DataFrame, key: str, share: float | None = None) -> DataFrame:
    """Keys that hold at least ``share`` of the rows; never more than ``1 / share`` of them.

    By default the share follows the number of tasks, see :func:`uneven_share`.

    Each task sends one frequent-items sketch, not its rows; sketches are merged
    in groups first and then once more, so no task meets all of them.  A sketch
    tracks ten times the keys that can be frequent, so none of those is missed.
    """
    share = uneven_share(frame) if share is None else share
    most = ceil(1 / share)
    groups = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = (
        frame.where(F.col(key).isNotNull())
        .select(F.col(key).alias("key"), F.pmod(F.spark_partition_id(), F.lit(groups)).alias("group"))
        .groupBy("group")
        .agg(F.expr(f"approx_top_k_accumulate(key, {10 * most})").alias("sketch"), F.count("*").alias("rows"))
    )
    # Grouped by a constant, so that an empty table gives no row and not an empty sketch.
    whole = grouped.groupBy(F.lit("all").alias("part")).agg(
        F.expr("approx_top_k_combine(sketch)").alias("sketch"), F.sum("rows").alias("rows")
    )
    listed = whole.select(
        "rows", F.inline(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("item", "times")
    )
    return listed.where(F.col("times") >= share * F.col("rows")).select(F.col("item").alias(key))


def _slots(ways: int, hot: Column) -> Column:
    return F.when(hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_by: Sequence[str],
    right_by: Sequence[str] = (),
    ways: int | None = None,
    hot: DataFrame | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``key`` where rows of frequent keys are spread over many tasks.

    Frequent keys are those of ``left``, or of ``hot_from``, unless ``hot`` lists them.  For them the left rows
    are dealt into ``ways`` parts by ``left_by`` and the right rows repeated for
    every part.  With ``right_by`` the right rows are dealt too, so that a key
    frequent on both sides becomes a square of small joins.  All other keys
    join as usual, and no row is lost or doubled.
    """
    if ways is None:
        ways = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Said before the join, so that the search for frequent keys can share the shuffles below.
    left = left.where(F.col(key).isNotNull())
    columns = [*left.columns, *(c for c in right.columns if c != key)]
    if right_by:
        ways = max(1, round(ways**0.5))
    if hot is None:
        # At most one row per smallest share, whatever the size of the tables.
        hot = F.broadcast(frequent_keys(left if hot_from is None else hot_from, key).withColumn("_hot", F.lit(True)))
    else:
        hot = hot.select(key).distinct().withColumn("_hot", F.lit(True))
    is_hot = F.coalesce("_hot", F.lit(False))

    def dealt(by: Sequence[str]) -> Column:
        return F.when(is_hot, F.pmod(F.xxhash64(*by), F.lit(ways)).cast("int")).otherwise(0)

    left = left.join(hot, key, "left").withColumn("_row", dealt(left_by))
    right = right.join(hot, key, "left").withColumn("_row", F.explode(_slots(ways, is_hot)))
    parts = [key, "_row"]
    if right_by:
        left = left.withColumn("_column", F.explode(_slots(ways, is_hot)))
        right = right.withColumn("_column", dealt(right_by))
        parts.append("_column")
    return left.drop("_hot").join(right.drop("_hot"), parts).select(*columns)
