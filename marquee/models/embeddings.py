"""Word vectors of genres; a title is the mean of its genres' vectors."""

from __future__ import annotations

from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import listed
from marquee.operators.shaping import eligible, fill_with, with_ratings

WORDS, EMBEDDING = "genres_array", "genre_embedding"


def with_genre_list(titles: DataFrame) -> DataFrame:
    """Titles with a non-empty genre list in ``genres_array``."""
    filled = fill_with(titles, {"genres": ""}).withColumn(WORDS, listed("genres"))
    return filled.where(F.get(WORDS, F.lit(0)) != "")


def rated_genre_lists(titles: DataFrame, ratings: DataFrame, movies_only: bool = False) -> DataFrame:
    """Rated titles with a genre list; ``movies_only`` keeps movies that are not adult."""
    if movies_only:
        titles = eligible(titles, types=["movie"])
    return with_ratings(with_genre_list(titles), ratings, "inner")


def fit_genre_vectors(
    frame: DataFrame, size: int = 100, seed: int = 42, parts: int = 8
) -> Word2VecModel:
    """Train on the genre lists in ``parts`` tasks.

    Results depend on the number of parts, so it does not follow the cluster.
    The model holds one vector per genre.
    """
    return Word2Vec(
        vectorSize=size, minCount=1, inputCol=WORDS, outputCol=EMBEDDING, seed=seed, numPartitions=parts
    ).fit(frame.select(WORDS))


def embed(model: Word2VecModel, frame: DataFrame) -> DataFrame:
    """Add the title vector as an array; row by row, no join."""
    return model.transform(frame).withColumn(EMBEDDING, vector_to_array(EMBEDDING))
