"""Dense integer ids, for models that want small numbers instead of keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dense_ids(frame: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Distinct keys numbered 0, 1, 2, ... in a reproducible way.

    Keys are numbered inside hash buckets of about equal size; each bucket then
    starts where the one before ended.  Only the bucket sizes meet in one place.
    """
    if buckets is None:
        buckets = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = (
        frame.where(F.col(key).isNotNull())
        .select(key)
        .distinct()
        .withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    )
    sizes = keyed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1
    # ``starts`` has at most ``buckets`` rows.
    return keyed.withColumn("_place", place).join(F.broadcast(starts), "_bucket").select(
        key, (F.col("_start") + F.col("_place")).cast("int").alias(name)
    )
