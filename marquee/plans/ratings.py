"""Questions about ratings and title types."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import rating_band, settled
from marquee.operators.density import density_curve
from marquee.operators.distribution import box_plot, histogram
from marquee.operators.quantiles import sketched_box_plot
from marquee.operators.shaping import eligible, relevant_titles, summarise, top_rows, with_ratings
from marquee.schemas import RELEVANT_TYPES


def rated_relevant(titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES) -> DataFrame:
    """Relevant titles, unrated ones included, with their rating."""
    return with_ratings(relevant_titles(titles, types), ratings)


def ratings_by_title_type(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Mean rating and number of titles per type, best first."""
    per_type = summarise(
        rated_relevant(titles, ratings, types),
        "titleType",
        avg_rating=F.avg("averageRating"),
        num_titles=F.count("*"),
    )
    return per_type.orderBy(F.desc_nulls_last(settled(F.col("avg_rating"))), "titleType")


def top_rated_titles(
    titles: DataFrame, ratings: DataFrame, count: int = 10, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Best-rated titles; there is no floor on votes, ties go by id."""
    best = top_rows(
        rated_relevant(titles, ratings, types), count, F.desc_nulls_last("averageRating"), F.asc("tconst")
    )
    return best.select("tconst", "primaryTitle", "averageRating", "titleType")


def rating_distribution(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Titles per rating value; the null row holds the unrated titles."""
    per_value = summarise(rated_relevant(titles, ratings, types), "averageRating", num_titles=F.count("*"))
    return per_value.orderBy(F.desc_nulls_last("averageRating"))


def rating_ranges(titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES) -> DataFrame:
    """Titles per two-point range, unrated ones apart."""
    ranged = rated_relevant(titles, ratings, types).withColumn(
        "rating_range", rating_band(F.col("averageRating"))
    )
    return summarise(ranged, "rating_range", num_titles=F.count("*")).orderBy("rating_range")


def rating_histogram(
    titles: DataFrame, ratings: DataFrame, bins: int = 20, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Equal bins between the lowest and highest rating."""
    return histogram(rated_relevant(titles, ratings, types), "averageRating", bins)


def rating_boxplot_by_title_type(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Five-number summary of the ratings of each type."""
    return box_plot(rated_relevant(titles, ratings, types), "titleType", "averageRating")


def rating_density(
    titles: DataFrame, ratings: DataFrame, points: int = 200, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Smooth curve over the ratings that the histogram counts."""
    return density_curve(rated_relevant(titles, ratings, types), "averageRating", points)


def rating_boxplot_sketched(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """The box plot from mergeable sketches, for ratings too many and too fine to count."""
    return sketched_box_plot(rated_relevant(titles, ratings, types), "titleType", "averageRating")


def rating_variance_by_title_type(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Population variance and mean per type over all rated titles that are not adult."""
    typed = eligible(titles).where(F.col("titleType").isNotNull())
    per_type = summarise(
        with_ratings(typed, ratings, "inner"),
        "titleType",
        rating_variance=F.var_pop("averageRating"),
        avg_rating=F.avg("averageRating"),
        num_titles=F.count("tconst"),
    )
    return per_type.orderBy(F.desc_nulls_last(settled(F.col("rating_variance"))), "titleType")
