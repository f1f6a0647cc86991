"""A smooth curve of how a column's values are distributed."""

from __future__ import annotations

from math import pi

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.distribution import value_counts

#: Bandwidths beyond which a value adds less than the last digit of a double to the value at its own place.
REACH = 8.5


def density_curve(frame: DataFrame, column: str, points: int = 200, bandwidth: float | None = None) -> DataFrame:
    """Gaussian kernel density of ``column`` at ``points`` equal steps from its least to its largest value: ``x, density``.

    Rows are counted per distinct value first, and a value adds only to the points within its reach.  Without ``bandwidth`` it is
    the sample deviation times the rows to the power of -1/5.  Nulls, NaN and endless values are left out.  Fewer than
    two rows or a single value have no curve: no rows come.
    """
    if points < 2 or (bandwidth is not None and bandwidth <= 0):
        raise ValueError("at least two points and a bandwidth above zero are needed")
    value = F.col(column).cast("double")
    known = frame.where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))).select(value.alias("_value"))
    width = F.lit(float(bandwidth)) if bandwidth else F.stddev_samp("_value") * F.pow(F.count("*").cast("double"), F.lit(-0.2))
    whole = F.struct(F.min("_value").alias("low"), F.max("_value").alias("high"), F.count("*").alias("rows"), width.alias("width"))
    facts = known.agg(whole.alias("facts")).scalar()
    spread = value_counts(known, ["_value"]).withColumn("_facts", facts).where("_facts.high > _facts.low")
    low, high, width = F.col("_facts.low"), F.col("_facts.high"), F.col("_facts.width")
    step = (high - low) / (points - 1)
    first = F.greatest(F.lit(0), F.ceil((F.col("_value") - low - REACH * width) / step).cast("int"))
    last = F.least(F.lit(points - 1), F.floor((F.col("_value") - low + REACH * width) / step).cast("int"))
    near = spread.withColumn("_at", F.explode(F.sequence(first, F.greatest(first, last))))
    away = (low + F.col("_at") * step - F.col("_value")) / width
    part = F.col("n") * F.exp(-away * away / 2)
    summed = near.groupBy("_at").agg(F.sum(part).alias("_sum"))
    grid = frame.sparkSession.range(points).select(F.col("id").cast("int").alias("_at")).withColumn("_facts", facts)
    curve = grid.where("_facts.high > _facts.low").join(summed, "_at", "left")
    scale = F.col("_facts.rows") * width * F.lit((2 * pi) ** 0.5)
    return curve.select((low + F.col("_at") * step).alias("x"), (F.coalesce("_sum", F.lit(0.0)) / scale).alias("density")).orderBy("x")
