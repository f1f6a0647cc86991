"""A forest over genres and numbers of titles: chosen among several, judged on rows kept out, saved and loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import listed
from marquee.models.features import fit_vocabulary, multi_hot
from marquee.models.predictor import PREDICTION
from marquee.sources.scratch import stored_once

_TERMS, _MARKS, _FEATURES = "_genre_terms", "_genre_marks", "_features"


def fold_of(key: str, folds: int) -> Column:
    """The fold of a row by a hash of its key: the same on every run and cluster."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(folds)).cast("int")


class TitleForest:
    """Predicts ``label`` of titles from single genres and from ``numbers``.

    Every genre is a mark of its own, so a combination that was not seen in training still has features.  Missing numbers
    become the median of training.  The number of trees and their depth are chosen by cross-validation over
    ``folds`` parts, dealt by a hash of the key; the best choice is fitted anew on all rows.
    """

    def __init__(
        self,
        label: str = "averageRating",
        numbers: Sequence[str] = (),
        trees: Sequence[int] = (10, 20),
        depths: Sequence[int] = (3, 6),
        folds: int = 3,
        seed: int = 42,
        at_once: int = 2,
    ):
        self.label, self.numbers, self.folds, self.seed, self.at_once = label, list(numbers), folds, seed, at_once
        self.trees, self.depths = list(trees), list(depths)
        self.model: PipelineModel | None = None
        self._trials: list[tuple[int, int, float]] = []

    def _preparing(self, rated: DataFrame) -> Pipeline:
        """Stages that need no choice: terms, marks, medians and one vector.  All of them can be saved."""
        terms = SQLTransformer(
            statement=f"SELECT *, coalesce(split(genres, ','), array('')) AS {_TERMS} FROM __THIS__"
        )
        vocabulary = fit_vocabulary(rated.select(listed("genres").alias(_TERMS)), _TERMS)
        stages = [terms, multi_hot(vocabulary, _TERMS, _MARKS)]
        filled = [f"_known_{name}" for name in self.numbers]
        if filled:
            stages.append(Imputer(inputCols=self.numbers, outputCols=filled, strategy="median"))
        stages.append(VectorAssembler(inputCols=[_MARKS, *filled], outputCol=_FEATURES))
        return Pipeline(stages=stages)

    def _typed(self, frame: DataFrame) -> DataFrame:
        return frame.withColumns({name: F.col(name).cast("double") for name in self.numbers})

    def fit(self, rated: DataFrame, key: str = "tconst") -> "TitleForest":
        """Rows without a label take no part.  The rows are read for medians, terms and every fold, so they are stored before."""
        usable = self._typed(rated.where(F.col(self.label).isNotNull()))
        usable = usable.withColumn("_label", F.col(self.label).cast("double")).withColumn("_fold", fold_of(key, self.folds))
        usable = usable.select("genres", *(n for n in self.numbers if n != "genres"), "_label", "_fold")
        # Rows are few bytes, of which Spark would write few files and let few tasks read them; many small ones it deals to all cores.
        tasks = int(usable.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        usable = stored_once(usable.repartition(tasks), "forest-rows")
        preparing = self._preparing(usable).fit(usable)
        forest = RandomForestRegressor(featuresCol=_FEATURES, labelCol="_label", predictionCol=PREDICTION, seed=self.seed)
        grid = ParamGridBuilder().addGrid(forest.numTrees, self.trees).addGrid(forest.maxDepth, self.depths).build()
        judge = RegressionEvaluator(labelCol="_label", predictionCol=PREDICTION, metricName="rmse")
        choosing = CrossValidator(
            estimator=forest, estimatorParamMaps=grid, evaluator=judge, numFolds=self.folds, foldCol="_fold", parallelism=self.at_once
        )
        prepared = preparing.transform(usable).select(_FEATURES, "_label", "_fold")
        chosen: CrossValidatorModel = choosing.fit(prepared)
        self._trials = [
            (params[forest.numTrees], params[forest.maxDepth], float(error))
            for params, error in zip(grid, chosen.avgMetrics, strict=True)
        ]
        self.model = PipelineModel(stages=[*preparing.stages, chosen.bestModel])
        return self

    def trials(self, spark: SparkSession) -> DataFrame:
        """Every choice with its mean error over the folds, best first."""
        return spark.createDataFrame(self._trials, "trees int, depth int, rmse double").orderBy("rmse", "trees", "depth")

    def predict(self, titles: DataFrame) -> DataFrame:
        """``titles`` with ``prediction``, whatever is missing in a row."""
        if self.model is None:
            raise ValueError("fit or load the forest first")
        predicted = self.model.transform(self._typed(titles))
        return predicted.select(*(c for c in titles.columns if c not in self.numbers), *self.numbers, PREDICTION)

    def save(self, path: str) -> None:
        """Writes the fitted stages to any path Hadoop can open, replacing what is there."""
        if self.model is None:
            raise ValueError("fit or load the forest first")
        self.model.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, label: str = "averageRating", numbers: Sequence[str] = ()) -> "TitleForest":
        """A forest that :meth:`save` has written, in this or any other session."""
        loaded = cls(label, numbers)
        loaded.model = PipelineModel.load(path)
        return loaded


def judged(predicted: DataFrame, label: str) -> DataFrame:
    """One row: ``rows`` with a label, ``rmse``, and ``share``, the error as a share of always guessing the mean."""
    error = F.sqrt(F.avg(F.pow(F.col(label) - F.col(PREDICTION), F.lit(2.0))))
    return predicted.where(F.col(label).isNotNull()).agg(
        F.count("*").alias("rows"), error.alias("rmse"), F.try_divide(error, F.stddev_pop(label)).alias("share")
    )
