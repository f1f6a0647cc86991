"""Questions about running time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import runtime_band
from marquee.operators.distribution import correlation_matrix
from marquee.operators.shaping import eligible, summarise, with_ratings


def runtime_rating_pairs(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Runtime, rating and type of each rated title with a usable runtime."""
    timed = titles.where(F.col("runtimeMinutes").isNotNull())
    return with_ratings(timed, ratings, "inner").select("runtimeMinutes", "averageRating", "titleType")


def runtime_rating_correlation(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    return correlation_matrix(runtime_rating_pairs(titles, ratings), ["runtimeMinutes", "averageRating"])


def runtime_perception(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Ratings and votes per runtime band, titles that are not adult.

    Titles whose runtime is missing or not a number are the band ``unknown``.
    """
    banded = with_ratings(eligible(titles), ratings).withColumn("runtime_bin", runtime_band(F.col("runtimeMinutes")))
    return summarise(
        banded,
        "runtime_bin",
        avg_rating=F.avg("averageRating"),
        rating_stddev=F.stddev("averageRating"),
        avg_votes=F.avg("numVotes"),
        num_titles=F.count("*"),
    ).orderBy("runtime_bin")
