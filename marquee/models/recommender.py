"""Titles like a given one: genre similarity blended with a collaborative score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import cosine, settled
from marquee.models.embeddings import EMBEDDING, WORDS, embed, fit_genre_vectors, rated_genre_lists
from marquee.models.factors import one_user_scores
from marquee.operators.neighbours import nearest_items
from marquee.operators.shaping import top_rows
from marquee.sources.scratch import stored_once


def similarity_to(items: DataFrame, item: str, vector: str, wanted: object) -> DataFrame:
    """Cosine of every other item to the wanted one; no rows if that one is unknown.

    The wanted vector is a single value put into the projection, so there is no join.
    """
    anchor = items.where(F.col(item) == F.lit(wanted)).agg(F.first(vector).alias("anchor")).scalar()
    others = items.where(F.col(item) != F.lit(wanted)).withColumn("_anchor", anchor)
    known = others.where(F.col("_anchor").isNotNull())
    return known.withColumn("similarity", cosine(F.col(vector), F.col("_anchor"))).drop("_anchor")


def blend(
    content: DataFrame, scores: DataFrame, item: str, alpha: float = 0.5, count: int = 10
) -> DataFrame:
    """Top items by ``alpha * similarity + (1 - alpha) * cf_score``; a missing part counts 0."""
    joined = content.join(scores.select(item, "cf_score"), item, "left")
    score = alpha * F.coalesce("similarity", F.lit(0.0)) + (1 - alpha) * F.coalesce("cf_score", F.lit(0.0))
    return top_rows(joined.withColumn("score", score), count, F.desc(settled(F.col("score"))), F.asc(item))


class TitleRecommender:
    """Fit once, then ask for titles like a given one."""

    def __init__(self, size: int = 100, seed: int = 42, parts: int = 8, movies_only: bool = False):
        self.size, self.seed, self.parts, self.movies_only = size, seed, parts, movies_only
        self.items: DataFrame | None = None
        self.scores: DataFrame | None = None

    def fit(self, titles: DataFrame, ratings: DataFrame) -> "TitleRecommender":
        rated = rated_genre_lists(titles, ratings, self.movies_only)
        model = fit_genre_vectors(rated, self.size, self.seed, self.parts)
        # What follows reads the titles several times, so their joins run once for all.
        kept = stored_once(rated.select("tconst", "primaryTitle", WORDS, "averageRating"), "rated-titles")
        self.items = embed(model, kept).select("tconst", "primaryTitle", EMBEDDING)
        self.scores = one_user_scores(kept, "tconst", "averageRating")
        return self

    def _fitted(self) -> tuple[DataFrame, DataFrame]:
        if self.items is None or self.scores is None:
            raise ValueError("fit the recommender first")
        return self.items, self.scores

    def recommend(self, wanted: str, alpha: float = 0.5, count: int = 10) -> DataFrame:
        items, scores = self._fitted()
        content = similarity_to(items, "tconst", EMBEDDING, wanted).drop(EMBEDDING)
        best = blend(content, scores, "tconst", alpha, count)
        return best.select("tconst", "primaryTitle", "similarity", "cf_score", "score")

    def similar_titles(self, count: int = 10) -> DataFrame:
        """The nearest titles by genre of every title."""
        items, _ = self._fitted()
        return nearest_items(items, "tconst", EMBEDDING, count)
