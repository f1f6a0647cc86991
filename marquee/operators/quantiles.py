"""Quantiles from sketches that merge, for columns with too many distinct values to count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: about three times as many numbers are held per group, however many rows it has.
SKETCH_SIZE = 1024


def rank_error(size: int = SKETCH_SIZE) -> float:
    """How far, as a share of the rows, the rank of a value from a sketch may be off in 99 of 100 cases.

    Published formula of the sketch.
    """
    return 2.296 / size**0.9021


def quantile_sketches(frame: DataFrame, keys: Sequence[str], column: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``keys`` and ``sketch`` of ``column`` in each group; tasks sketch their own rows first.  Nulls and NaN are left out."""
    value = F.col(column).cast("double")
    known = frame.where(value.isNotNull() & ~F.isnan(value)).select(*keys, value.alias("_value"))
    return known.groupBy(*keys).agg(F.kll_sketch_agg_double("_value", F.lit(size)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SKETCH_SIZE) -> DataFrame:
    """Sketches of coarser groups from those of finer ones, without the rows."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``keys``, ``n`` and ``quantiles``, one value of the column per share."""
    wanted = F.array(*(F.lit(float(s)) for s in shares))
    return sketches.select(
        *keys,
        F.kll_sketch_get_n_double("sketch").alias("n"),
        F.kll_sketch_get_quantile_double("sketch", wanted).alias("quantiles"),
    )


def sketched_box_plot(frame: DataFrame, key: str, column: str, reach: float = 1.5, size: int = SKETCH_SIZE) -> DataFrame:
    """As :func:`marquee.operators.distribution.box_plot`, with quartiles from sketches.

    Quartiles are values of the column whose rank is off by :func:`rank_error` at most, mostly; whiskers, counts and
    outliers are exact for these quartiles.  The state of a group does not grow with its distinct values.
    """
    quartiles = sketched_quantiles(quantile_sketches(frame, [key], column, size), [key])
    named = quartiles.select(F.col(key).alias("_key"), *(F.get("quantiles", F.lit(k)).alias(n) for k, n in enumerate(("q1", "median", "q3"))))
    span = (F.col("q3") - F.col("q1")) * reach
    inside = F.col(column).between(F.col("q1") - span, F.col("q3") + span)
    # One row per group on the right side.
    known = frame.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).select(key, column)
    return (
        known.join(named, F.col(key).eqNullSafe(F.col("_key")))
        .groupBy(key, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(column))).alias("whisker_low"),
            F.max(F.when(inside, F.col(column))).alias("whisker_high"),
            F.count("*").alias("n"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def rank_gap(frame: DataFrame, quartiles: DataFrame, key: str, column: str, shares: Sequence[float]) -> DataFrame:
    """``key`` and ``gap``: how far, as a share of the rows, the given ``quantiles`` are from the wanted ranks.

    A value that many rows have covers a range of ranks; it is off only outside of it.
    """
    known = frame.where(F.col(column).isNotNull()).select(F.col(key).alias("_key"), F.col(column).cast("double").alias("_value"))
    both = known.join(quartiles, F.col("_key").eqNullSafe(F.col(key)))
    at = [F.get("quantiles", F.lit(k)) for k in range(len(shares))]
    below = [F.avg((F.col("_value") < q).cast("int")) for q in at]
    upto = [F.avg((F.col("_value") <= q).cast("int")) for q in at]
    gaps = [F.greatest(F.lit(0.0), b - s, s - u) for b, u, s in zip(below, upto, shares, strict=True)]
    return both.groupBy(key).agg(F.greatest(*gaps, F.lit(0.0)).alias("gap"))
