import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marquee.models import embeddings, factors, features, predictor
from marquee.models.recommender import TitleRecommender, blend, similarity_to


def test_one_hot_drops_the_last_category(spark):
    frame = spark.createDataFrame([(g,) for g in "AAABBC"] + [(None,)], "genres string")
    encoded = features.prepare_features(frame).select(
        "genres", "genreIndex", vector_to_array("genreVec").alias("v")
    ).distinct()
    assert sorted(rows(encoded)) == [("A", 0.0, [1.0, 0.0]), ("B", 1.0, [0.0, 1.0]), ("C", 2.0, [0.0, 0.0])]


def test_index_ties_are_alphabetical(spark):
    frame = spark.createDataFrame([(g,) for g in "CCBBA"], "genres string")
    got = dict(rows(features.prepare_features(frame).select("genres", "genreIndex").distinct()))
    assert got == {"B": 0.0, "C": 1.0, "A": 2.0}


@pytest.fixture(scope="module")
def separable(spark):
    """Three genre lists whose ratings differ clearly."""
    return spark.range(300).select(
        F.concat(F.lit("t"), "id").alias("tconst"),
        F.concat(F.lit("Title "), "id").alias("primaryTitle"),
        F.element_at(F.array(F.lit("Drama"), F.lit("Horror"), F.lit("Comedy,Drama")), (F.col("id") % 3 + 1).cast("int")).alias(
            "genres"
        ),
        (F.col("id") % 3 * 3 + 2 + F.col("id") % 2 * 0.1).alias("averageRating"),
    )


def test_split_is_disjoint_and_repeatable(separable):
    train, test = predictor.split_by_key(separable)
    assert train.count() + test.count() == 300 and test.count() > 0
    assert train.join(test, "tconst").count() == 0
    again, _ = predictor.split_by_key(separable.repartition(5))
    assert sorted(rows(again, "tconst")) == sorted(rows(train, "tconst"))


def test_predictor_beats_the_mean(separable):
    train, test = predictor.split_by_key(separable)
    scores = predictor.evaluate(predictor.RatingPredictor().fit(train).predict(test)).first()
    # Always guessing the mean has the deviation as its rmse.
    assert scores.rmse < test.agg(F.stddev_pop("averageRating")).first()[0]
    assert scores.r2 > 0 and scores.rows == test.count()


def test_predictor_wants_fitting(separable):
    with pytest.raises(ValueError):
        predictor.RatingPredictor().predict(separable)


def test_equal_lists_get_equal_vectors(separable):
    listed = embeddings.with_genre_list(separable)
    model = embeddings.fit_genre_vectors(listed, size=100, parts=1)
    got = embeddings.embed(model, listed)
    assert got.select(F.size("genre_embedding")).distinct().collect() == [(100,)]
    assert got.select("genres", "genre_embedding").distinct().count() == 3
    again = embeddings.embed(embeddings.fit_genre_vectors(listed, size=100, parts=1), listed)
    assert again.select("genre_embedding").distinct().exceptAll(got.select("genre_embedding").distinct()).count() == 0


def test_movies_only(small):
    kept = embeddings.rated_genre_lists(small.titles, small.ratings, movies_only=True)
    assert sorted(rows(kept, "tconst")) == [("t1",), ("t2",)]
    assert embeddings.rated_genre_lists(small.titles, small.ratings).count() == 6


def test_als_of_one_user_approaches_the_closed_form(separable):
    some = separable.where("tconst < 't12'")
    closed = factors.one_user_scores(some, "tconst", "averageRating")
    users = some.withColumn("user", F.lit(1))

    def largest_gap(iterations):
        fitted = factors.factor_scores(users, "user", "tconst", "averageRating", iterations=iterations, blocks=1)
        both = closed.join(fitted.select("tconst", F.col("cf_score").alias("als")), "tconst")
        assert both.count() == some.count()
        return both.agg(F.max(F.abs(F.col("als") - F.col("cf_score")))).first()[0]

    early, late = largest_gap(10), largest_gap(60)
    assert late < early < 0.2 and late < 0.02
    assert closed.where("cf_score < 0").count() == 0


def test_scores_of_many_users(spark):
    rated = spark.range(400).select(
        F.concat(F.lit("u"), F.col("id") % 20).alias("user"),
        F.concat(F.lit("i"), F.floor(F.col("id") / 20)).alias("item"),
        (F.col("id") % 5 + 1).cast("double").alias("rating"),
    )
    got = factors.factor_scores(rated, "user", "item", "rating", blocks=2)
    assert got.count() == 400 and got.where("cf_score < 0").count() == 0
    error = got.join(rated, ["user", "item"]).agg(F.avg(F.abs(F.col("rating") - F.col("cf_score")))).first()[0]
    assert error < 0.5


def test_low_ratings_score_zero(spark):
    rated = spark.createDataFrame([("a", 0.05), ("b", None)], "item string, rating double")
    assert rows(factors.one_user_scores(rated, "item", "rating")) == [("a", 0.0)]


def test_blend(spark):
    content = spark.createDataFrame([("a", 0.8), ("b", 0.4), ("c", 0.8), ("d", None)], "id string, similarity double")
    scores = spark.createDataFrame([("b", 1.0), ("z", 9.0)], "id string, cf_score double")
    got = blend(content, scores, "id", alpha=0.5, count=3)
    assert rows(got, "id", "score") == [("b", 0.7), ("a", 0.4), ("c", 0.4)]


def test_similarity_to_leaves_the_item_out(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0])], "id int, v array<double>")
    got = dict(rows(similarity_to(items, "id", "v", 1), "id", "similarity"))
    assert got == {2: pytest.approx(0.5**0.5), 3: None}
    assert similarity_to(items, "id", "v", 9).count() == 0


def test_recommender(separable):
    titles = separable.drop("averageRating").withColumn("isAdult", F.lit(0))
    ratings = separable.select("tconst", "averageRating", F.lit(1).alias("numVotes"))
    fitted = TitleRecommender(size=20, parts=1).fit(titles, ratings)
    best = fitted.recommend("t0", alpha=1.0, count=10).collect()
    assert [r.similarity for r in best] == [pytest.approx(1.0)] * 10
    assert "t0" not in {r.tconst for r in best}
    by_rating = fitted.recommend("t0", alpha=0.0, count=5).collect()
    assert [r.score for r in by_rating] == sorted((r.score for r in by_rating), reverse=True)
    assert by_rating[0].cf_score == pytest.approx(8.1, rel=0.05)
    similar = fitted.similar_titles(3)
    assert similar.count() == 900
    assert similar.where("similarity < 0.999").count() == 0
    with pytest.raises(ValueError):
        TitleRecommender().recommend("t0")
