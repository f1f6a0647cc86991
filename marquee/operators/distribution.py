"""Histogram, box plot and correlation matrix as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import correlation


def value_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.groupBy(*columns).agg(F.count("*").alias("n"))


def histogram(frame: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; nulls are left out.

    Rows are first counted per distinct value, so the edges and the bins both
    come from one scan.  All bins are listed; if every value is the same, the
    range is half a unit to each side of it.
    """
    counts = value_counts(frame.where(F.col(column).isNotNull()), [column])
    lowest, highest = F.min(column).cast("double"), F.max(column).cast("double")
    margin = F.when(lowest == highest, 0.5).otherwise(0.0)
    # The row count is asked for only to share the shuffle of ``counts``.
    edges = counts.agg(
        F.struct(
            (lowest - margin).alias("low"), (highest + margin).alias("high"), F.sum("n").alias("rows")
        )
    ).scalar()
    low, span = F.col("edges.low"), F.col("edges.high") - F.col("edges.low")
    place = F.floor((F.col(column) - low) / span * bins)
    filled = (
        counts.withColumn("edges", edges)
        .select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"), "n")
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
    )
    width = span / bins
    listed = frame.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        listed.join(filled, "bin", "left")
        .withColumn("edges", edges)
        .select(
            "bin",
            (low + F.col("bin") * width).alias("bin_start"),
            (low + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("n", F.lit(0)).cast("long").alias("num_titles"),
        )
        .orderBy("bin")
    )


def box_plot(frame: DataFrame, key: str, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count of ``column`` per ``key``.

    Quartiles are exact (linear interpolation) and taken over counted distinct
    values, so the aggregation state grows with the distinct values only.  A
    whisker is the last value within ``reach`` interquartile ranges.
    """
    counts = value_counts(frame.where(F.col(column).isNotNull()), [key, column])
    quartiles = (
        counts.groupBy(key)
        .agg(F.percentile(column, [0.25, 0.5, 0.75], F.col("n")).alias("q"))
        .select(
            F.col(key),
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
        )
    )
    span = (F.col("q3") - F.col("q1")) * reach
    inside = F.col(column).between(F.col("q1") - span, F.col("q3") + span)
    return (
        counts.join(quartiles, key)
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(column))).alias("whisker_low"),
            F.max(F.when(inside, F.col(column))).alias("whisker_high"),
            F.sum("n").alias("n"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).cast("long").alias("n_outliers"),
        )
        .orderBy(key)
    )


def correlation_matrix(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlations of all column pairs as rows ``var_x, var_y, corr``."""
    place = {name: at for at, name in enumerate(columns)}
    cells = []
    for x in columns:
        for y in columns:
            first, second = sorted((x, y), key=place.get)
            value = correlation(F.col(first), F.col(second))
            cells.append(F.struct(F.lit(x).alias("var_x"), F.lit(y).alias("var_y"), value.alias("corr")))
    return frame.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
