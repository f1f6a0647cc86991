"""Questions about the regions of alternative titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import settled, weighted_mean
from marquee.operators.shaping import summarise, top_rows


def ratings_by_region(akas: DataFrame, ratings: DataFrame, min_titles: int = 50) -> DataFrame:
    """Mean rating and number of alternative titles of regions with over ``min_titles``.

    Alternative titles are counted per title and region before the join, so a
    title with very many of them does not gather in one task.
    """
    # Fixed value: the word that stands for "no region" besides the null marker.
    named = akas.where(F.col("region").isNotNull() & (F.col("region") != "None"))
    copies = named.groupBy(F.col("titleId").alias("tconst"), "region").agg(F.count("*").alias("copies"))
    per_region = summarise(
        copies.join(ratings.select("tconst", "averageRating"), "tconst"),
        "region",
        avg_rating=weighted_mean(F.col("averageRating"), F.col("copies")),
        num_titles=F.sum("copies"),
    ).where(F.col("num_titles") > min_titles)
    return per_region.orderBy(*_best_first())


def top_regions(akas: DataFrame, ratings: DataFrame, min_titles: int = 50, count: int = 10) -> DataFrame:
    return top_rows(ratings_by_region(akas, ratings, min_titles), count, *_best_first())


def _best_first():
    return F.desc_nulls_last(settled(F.col("avg_rating"))), F.asc("region")
