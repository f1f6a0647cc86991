"""Questions about genres."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import settled, settled_popularity, weighted_mean
from marquee.operators.distribution import correlation_matrix
from marquee.operators.shaping import (
    eligible,
    one_per_key,
    relevant_titles,
    summarise,
    top_rows,
    unfold,
    with_crew,
    with_ratings,
)
from marquee.schemas import RELEVANT_TYPES


def genre_distribution(titles: DataFrame) -> DataFrame:
    """Titles per genre, most frequent first."""
    return unfold(titles, "genres", "genre").groupBy("genre").count().orderBy(F.desc("count"), "genre")


def genre_rating_correlation(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Across genres, does a better mean rating go with more rated titles?"""
    rated = unfold(with_ratings(titles, ratings, "inner"), "genres", "genre")
    per_genre = summarise(rated, "genre", avg_rating=F.avg("averageRating"), genre_count=F.count("*"))
    return correlation_matrix(per_genre, ["avg_rating", "genre_count"])


def genre_popularity(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES, crew: DataFrame | None = None
) -> DataFrame:
    """Titles, mean rating, votes and popularity (mean x votes) of each genre.

    ``title_percentage`` is the share of titles that carry the genre, so it
    sums to more than 100; ``popularity_score`` sums to 1.  The number of
    titles is found in the same scan: each title counts once, at its first
    genre.  The windows see one row per genre.

    With ``crew``, ``directed_titles`` and ``written_titles`` count the titles whose directors or writers are
    known; the other columns are the same with and without it, also if a title has several crew rows.
    """
    per_title = with_ratings(relevant_titles(titles, types), ratings)
    credited = {}
    if crew is not None:
        per_title = with_crew(per_title, one_per_key(crew, ["tconst"], ["tconst"]))
        credited = {f"{done}_titles": F.count(people) for done, people in (("directed", "directors"), ("written", "writers"))}
    per_genre = summarise(
        per_title.select(
            "titleType", "averageRating", "numVotes", *(("directors", "writers") if credited else ()),
            F.posexplode(F.split("genres", ",")).alias("at", "genre"),
        ),
        "genre",
        total_titles=F.count("*"),
        avg_rating=F.avg("averageRating"),
        total_votes=F.sum("numVotes"),
        weighted_popularity=F.avg("averageRating") * F.sum("numVotes"),
        movie_count=F.count_if(F.col("titleType") == "movie"),
        tvseries_count=F.count_if(F.col("titleType") == "tvSeries"),
        first_here=F.count_if(F.col("at") == 0),
        **credited,
    )
    everything = Window.partitionBy()
    return (
        per_genre.withColumn("title_percentage", F.col("total_titles") / F.sum("first_here").over(everything) * 100)
        .withColumn(
            "popularity_score",
            F.try_divide("weighted_popularity", F.sum("weighted_popularity").over(everything)),
        )
        .drop("first_here")
        .orderBy(settled_popularity(F.col("avg_rating"), F.col("total_votes")).desc_nulls_last(), "genre")
    )


def genre_trends(titles: DataFrame, ratings: DataFrame, min_titles: int = 10, best: int = 5) -> DataFrame:
    """The most voted genres of each year, among genres with over ``min_titles`` rated titles."""
    dated = titles.where(F.col("startYear").isNotNull())
    per_year = summarise(
        unfold(with_ratings(dated, ratings, "inner"), "genres", "genre"),
        ["startYear", "genre"],
        avg_rating=F.avg("averageRating"),
        title_count=F.count("*"),
        total_votes=F.sum("numVotes"),
    ).where(F.col("title_count") > min_titles)
    by_votes = Window.partitionBy("startYear").orderBy(F.desc("total_votes"))
    return (
        per_year.withColumn("genre_rank", F.dense_rank().over(by_votes))
        .where(F.col("genre_rank") <= best)
        .orderBy("startYear", "genre_rank", "genre")
    )


def genre_popularity_by(
    titles: DataFrame,
    akas: DataFrame,
    ratings: DataFrame,
    place: str,
    types: Iterable[str] = RELEVANT_TYPES,
) -> DataFrame:
    """Per (``place``, genre): alternative titles, mean rating and mean votes.

    ``place`` is ``region`` or ``language``; a missing one is a group of its
    own.  Every alternative title counts.  They are counted per title and
    place before the join, so a title with very many of them brings only one
    row per place.
    """
    copies = akas.groupBy(F.col("titleId").alias("tconst"), place).agg(F.count("*").alias("copies"))
    rated = with_ratings(eligible(titles, types, genres=True), ratings, "inner")
    return summarise(
        unfold(rated.join(copies, "tconst"), "genres", "genre"),
        [place, "genre"],
        total_titles=F.sum("copies"),
        avg_rating=weighted_mean(F.col("averageRating"), F.col("copies")),
        avg_votes=weighted_mean(F.col("numVotes"), F.col("copies")),
    ).orderBy(F.desc("total_titles"), place, "genre")


def emerging_declining_genres(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Change of a genre's popularity since the last year it appeared; no change, no row."""
    dated = relevant_titles(titles, types).where(F.col("startYear").isNotNull())
    per_year = summarise(
        unfold(with_ratings(dated, ratings), "genres", "genre"),
        ["genre", "startYear"],
        total_titles=F.count("*"),
        avg_rating=F.avg("averageRating"),
        avg_votes=F.avg("numVotes"),
        total_votes=F.sum("numVotes"),
    )
    history = Window.partitionBy("genre").orderBy("startYear")
    popularity = F.col("weighted_popularity")
    stable = settled_popularity(F.col("avg_rating"), F.col("total_votes"))
    return (
        per_year.withColumn("weighted_popularity", F.col("avg_rating") * F.col("total_votes"))
        .withColumn("total_titles_year", F.sum("total_titles").over(Window.partitionBy("startYear")))
        .withColumn("title_percentage", F.col("total_titles") / F.col("total_titles_year") * 100)
        .withColumn("popularity_change", popularity - F.lag(popularity).over(history))
        .withColumn("direction", F.signum(stable - F.lag(stable).over(history)))
        .where(F.col("direction") != 0)
        .withColumn("trend", F.when(F.col("direction") > 0, "emerging").otherwise("declining"))
        .drop("direction")
        .orderBy(F.desc(settled(F.col("popularity_change"), 6)), "genre", "startYear")
    )


def top_rated_genres(
    titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> DataFrame:
    """Mean rating and number of relevant titles per genre, best first."""
    per_genre = summarise(
        unfold(with_ratings(relevant_titles(titles, types), ratings), "genres", "genre"),
        "genre",
        avg_rating=F.avg("averageRating"),
        num_titles=F.count("*"),
    )
    return per_genre.orderBy(F.desc_nulls_last(settled(F.col("avg_rating"))), "genre")


def _genre_spread(titles: DataFrame, ratings: DataFrame, **more) -> DataFrame:
    return summarise(
        unfold(with_ratings(eligible(titles, genres=True), ratings), "genres", "genre"),
        "genre",
        avg_rating=F.avg("averageRating"),
        rating_stddev=F.stddev("averageRating"),
        num_titles=F.count("*"),
        **more,
    )


def genre_consistency(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Mean and sample deviation of the ratings of each genre, all title types."""
    return _genre_spread(titles, ratings).orderBy(F.desc_nulls_last(settled(F.col("avg_rating"))), "genre")


def audience_preferences_by_genre(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Genre consistency with the mean number of votes."""
    return _genre_spread(titles, ratings, avg_votes=F.avg("numVotes")).orderBy(
        F.desc_nulls_last(settled(F.col("avg_rating"))), "genre"
    )


def consistent_genres(
    titles: DataFrame,
    ratings: DataFrame,
    most: bool = True,
    min_titles: int = 50,
    count: int = 5,
) -> DataFrame:
    """Genres with the smallest (``most``) or largest rating deviation.

    Only genres with over ``min_titles`` titles; a genre without a deviation
    (fewer than two ratings) is left out of both ends.
    """
    known = _genre_spread(titles, ratings).where(
        (F.col("num_titles") > min_titles) & F.col("rating_stddev").isNotNull()
    )
    deviation = settled(F.col("rating_stddev"))
    return top_rows(known, count, deviation.asc() if most else deviation.desc(), "genre")
