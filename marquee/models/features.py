"""Genre combinations as categories (index and one-hot vector), and single genres as marks (multi-hot vector)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INDEX, VECTOR = "genreIndex", "genreVec"


def genre_indexer(unknown: str = "skip") -> StringIndexer:
    """Index of the whole genre list, most frequent first, ties by name.

    Null and unseen lists are skipped, or with ``unknown="keep"`` are one more
    category.  The fitted model holds one entry per combination of genres.
    """
    return StringIndexer(inputCol="genres", outputCol=INDEX, handleInvalid=unknown)


def genre_encoder(unknown: str = "error") -> OneHotEncoder:
    """One-hot vector of the index; the last category is the zero vector."""
    return OneHotEncoder(inputCols=[INDEX], outputCols=[VECTOR], handleInvalid=unknown)


def fit_genre_features(frame: DataFrame) -> PipelineModel:
    return Pipeline(stages=[genre_indexer(), genre_encoder()]).fit(frame)


def prepare_features(frame: DataFrame) -> DataFrame:
    return fit_genre_features(frame).transform(frame)


def fit_vocabulary(frame: DataFrame, terms: str, most: int = 10_000) -> list[str]:
    """Distinct elements of the array column ``terms``, those of most rows first, ties by name; ``most`` at the most.

    Counted over all rows; the list is what a model holds, so its length is bounded.  Nulls and empty terms are left out.
    """
    listed = frame.select(F.explode(F.array_distinct(terms)).alias("term")).where("term <> ''")
    counts = listed.groupBy("term").agg(F.count("*").alias("n"))
    return [row["term"] for row in counts.orderBy(F.desc("n"), "term").limit(most).collect()]


def multi_hot(vocabulary: list[str], terms: str, output: str) -> CountVectorizerModel:
    """A stage that marks each term of the array column; terms not in the vocabulary leave no mark."""
    model = CountVectorizerModel.from_vocabulary(vocabulary or [""], inputCol=terms, outputCol=output)
    return model.setBinary(True)
