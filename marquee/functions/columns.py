"""Column expressions shared by the analyses; all built from Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARKER = r"\N"


def unmark(column: Column) -> Column:
    """Text column with the null marker turned into a real null."""
    return F.nullif(column, F.lit(NULL_MARKER))


def listed(column: str) -> Column:
    """Array held in a comma-separated text column."""
    return F.split(column, ",")


def settled(column: Column, digits: int = 9) -> Column:
    """Value fit for ranking and thresholds.

    The last bits of a mean depend on the order in which rows were added up;
    comparing the rounded value keeps ranks and cuts equal from run to run.
    """
    return F.round(column, digits)


def settled_popularity(mean: Column, votes: Column) -> Column:
    """Mean times votes, fit for ranking: large products would blow up the mean's last bits."""
    return settled(mean) * votes


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of ``value`` where each row stands for ``weight`` rows; nulls are skipped."""
    return F.try_divide(
        F.sum(value.cast("double") * weight),
        F.sum(F.when(value.isNotNull(), weight)),
    )


def band(value: Column, limits: list[tuple[Column, str]], beyond: str, missing: str) -> Column:
    """Label of the first limit that holds, ``beyond`` past all, ``missing`` for null."""
    label = F.when(value.isNull(), missing)
    for holds, name in limits:
        label = label.when(holds, name)
    return label.otherwise(beyond)


def rating_band(rating: Column) -> Column:
    """Two-point rating ranges, lower edge in; a missing rating is ``unrated``."""
    # Edges and labels.
    limits = [(rating < high, f"{high - 2}-{high}") for high in (2, 4, 6, 8)]
    return band(rating, limits, "8-10", "unrated")


def runtime_band(minutes: Column) -> Column:
    """Half-hour runtime ranges, upper edge in past the first; missing is ``unknown``."""
    # Edges and labels.
    limits = [(minutes < 30, "<30 min")]
    limits += [(minutes <= high, f"{high - 30}-{high} min") for high in (60, 90, 120)]
    return band(minutes, limits, ">120 min", "unknown")


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(left: Column, right: Column) -> Column:
    """Cosine of two equally long arrays; null if either has no length."""
    return F.try_divide(dot(left, right), F.sqrt(dot(left, left)) * F.sqrt(dot(right, right)))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation aggregate; null (not an error) if a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)
