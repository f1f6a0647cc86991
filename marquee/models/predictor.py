"""Predicting a title's rating from its genres with a regression forest."""

from __future__ import annotations

from math import ceil

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.models.features import VECTOR, genre_encoder, genre_indexer
from marquee.sources.scratch import stored_once

LABEL, PREDICTION = "averageRating", "prediction"


def split_by_key(frame: DataFrame, key: str = "tconst", train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same on every run, cluster and engine."""
    slot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    return frame.where(slot < train_percent), frame.where(slot >= train_percent)


#: The forest holds a number per genre list for every row, in the parts in which it gets the rows.
ROWS_OF_A_TASK = 100_000


class RatingPredictor:
    """Index, encode and fit; titles without genres or rating take no part in fitting.

    Every title gets a prediction: genre lists that are missing or were not seen
    in training share a category of their own.
    """

    def __init__(self, trees: int = 20, depth: int = 5, seed: int = 42):
        forest = RandomForestRegressor(
            featuresCol=VECTOR, labelCol=LABEL, predictionCol=PREDICTION, numTrees=trees, maxDepth=depth, seed=seed
        )
        self.pipeline = Pipeline(stages=[genre_indexer("keep"), genre_encoder("keep"), forest])
        self.model: PipelineModel | None = None

    def fit(self, rated: DataFrame) -> "RatingPredictor":
        usable = rated.where(F.col("genres").isNotNull() & F.col(LABEL).isNotNull())
        kept = stored_once(usable.select("genres", LABEL), "training-rows")
        tasks = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.model = self.pipeline.fit(kept.repartition(max(tasks, ceil(kept.count() / ROWS_OF_A_TASK))))
        return self

    def predict(self, titles: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("fit the predictor first")
        return self.model.transform(titles)


def evaluate(predicted: DataFrame) -> DataFrame:
    """Rows, rmse, mae and r2 of the predictions in one pass."""
    error = F.col(LABEL) - F.col(PREDICTION)
    return predicted.where(F.col(LABEL).isNotNull()).agg(
        F.count("*").alias("rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(LABEL))).alias("r2"),
    )
