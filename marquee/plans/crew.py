"""Questions about directors, writers and other credits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import listed, settled, settled_popularity
from marquee.operators.shaping import eligible, relevant_titles, summarise, top_rows, unfold, with_ratings
from marquee.operators.skew import spread_join
from marquee.schemas import RELEVANT_TYPES


def director_productivity(crew: DataFrame, count: int = 10) -> DataFrame:
    """Directors with the most titles."""
    per_director = unfold(crew.select("directors"), "directors", "director_id").groupBy("director_id").count()
    return top_rows(per_director, count, F.desc("count"), F.asc("director_id"))


def job_distribution(principals: DataFrame) -> DataFrame:
    """Credits per (category, job); credits without a job are a group of their own."""
    return principals.groupBy("category", "job").count().orderBy(F.desc("count"), "category", "job")


def multi_role_people(principals: DataFrame, count: int = 10) -> DataFrame:
    """People with the most credits and the set of their categories.

    ``num_roles`` counts credits, not different categories.  Credits are
    counted per person and category first; sets are built for the winners only.
    """
    per_category = summarise(principals, ["nconst", "category"], credits=F.count("category"))
    people = summarise(per_category, "nconst", num_roles=F.sum("credits"))
    best = top_rows(people, count, F.desc("num_roles"), F.asc("nconst"))
    # ``best`` has ``count`` rows.
    return (
        per_category.join(F.broadcast(best), "nconst")
        .groupBy("nconst", "num_roles")
        .agg(F.sort_array(F.collect_set("category")).alias("roles"))
        .orderBy(F.desc("num_roles"), "nconst")
    )


def collaboration_network(principals: DataFrame, ways: int | None = None) -> DataFrame:
    """Director-producer edges weighted by shared credits.

    A person credited twice on a title counts twice, so credits are first
    counted per title and person and the counts multiplied: each pair of
    people comes up once per title.  Titles with a large share of all credits
    are joined in parts.
    """
    roles = ("director", "producer")
    credits = principals.where(F.col("category").isin(*roles))
    # Counted once for both roles; all that follows reads this one exchange.
    times = summarise(
        credits, ["tconst", "nconst"], **{f"{role}_times": F.count_if(F.col("category") == role) for role in roles}
    )
    directors, producers = (
        times.where(F.col(f"{role}_times") > 0).select("tconst", F.col("nconst").alias(f"{role}_id"), f"{role}_times")
        for role in roles
    )
    pairs = spread_join(
        directors,
        producers,
        "tconst",
        left_by=["director_id"],
        right_by=["producer_id"],
        ways=ways,
        hot_from=times,
    )
    return summarise(
        pairs,
        ["director_id", "producer_id"],
        count=F.sum(F.col("director_times") * F.col("producer_times")),
    ).orderBy(F.desc("count"), "director_id", "producer_id")


def crew_contribution(
    titles: DataFrame,
    crew: DataFrame,
    ratings: DataFrame,
    count: int = 10,
    min_titles: int = 3,
    as_lists: bool = False,
) -> DataFrame:
    """Best directors by mean rating, among those with over ``min_titles`` rated titles.

    One row per director and title, so that no row has to hold all the titles
    of a person.  ``as_lists`` folds them into one sorted list per director
    for catalogues where a person's titles fit into a row.
    """
    rated = with_ratings(titles.select("tconst", "primaryTitle"), ratings, "inner")
    directed = unfold(rated.join(crew.select("tconst", "directors"), "tconst"), "directors", "nconst")
    order = (F.desc_nulls_last(settled(F.col("avg_title_rating"))), F.asc("nconst"))
    best = top_rows(
        summarise(
            directed, "nconst", avg_title_rating=F.avg("averageRating"), total_titles=F.count("*")
        ).where(F.col("total_titles") > min_titles),
        count,
        *order,
    )
    # ``best`` has ``count`` rows.
    listed = directed.join(F.broadcast(best), "nconst")
    if as_lists:
        return summarise(
            listed,
            ["nconst", "avg_title_rating", "total_titles"],
            titles=F.sort_array(F.collect_list("primaryTitle")),
        ).orderBy(*order)
    shown = ("nconst", "avg_title_rating", "total_titles", "tconst", "primaryTitle", "averageRating")
    return listed.select(*shown).orderBy(*order, "tconst")


def _performance(titles, ratings, crew, principals, types) -> DataFrame:
    """Per role and person; directors from crew lists, writers from credits, each once per title.

    Directors' titles meet one to one before the list is unfolded; writers are made
    one per title and person, and join the titles once.
    """
    rated = with_ratings(relevant_titles(titles, types), ratings).select("tconst", "averageRating", "numVotes")
    led = rated.join(crew.select("tconst", "directors"), "tconst")
    measures = ("averageRating", "numVotes")
    directors = led.select(
        F.lit("director").alias("role"), F.explode(F.array_distinct(listed("directors"))).alias("nconst"), *measures
    )
    credits = principals.where(F.col("category") == "writer").select("tconst", "nconst").distinct()
    writers = credits.join(rated, "tconst").select(F.lit("writer").alias("role"), "nconst", *measures)
    return summarise(
        directors.unionByName(writers),
        ["role", "nconst"],
        avg_rating=F.avg("averageRating"),
        num_titles=F.count("*"),
        total_votes=F.sum("numVotes"),
        weighted_popularity=F.avg("averageRating") * F.sum("numVotes"),
    )


def _popular_first():
    popularity = settled_popularity(F.col("avg_rating"), F.col("total_votes"))
    return popularity.desc_nulls_last(), F.asc("role"), F.asc("nconst")


def _best_first():
    return F.desc_nulls_last(settled(F.col("avg_rating"))), F.asc("role"), F.asc("nconst")


def crew_performance(
    titles: DataFrame,
    ratings: DataFrame,
    crew: DataFrame,
    principals: DataFrame,
    types: Iterable[str] = RELEVANT_TYPES,
) -> DataFrame:
    """Rating, titles (unrated included), votes and popularity per director and per writer."""
    return _performance(titles, ratings, crew, principals, types).orderBy(*_popular_first())


def _high_performers(titles, ratings, crew, principals, min_rating, min_titles, types) -> DataFrame:
    return _performance(titles, ratings, crew, principals, types).where(
        (settled(F.col("avg_rating")) >= min_rating) & (F.col("num_titles") >= min_titles)
    )


def high_performing_crew(
    titles: DataFrame,
    ratings: DataFrame,
    crew: DataFrame,
    principals: DataFrame,
    min_rating: float = 8.0,
    min_titles: int = 5,
    types: Iterable[str] = RELEVANT_TYPES,
) -> DataFrame:
    """Crew performance of people at or above both thresholds, best mean first."""
    return _high_performers(titles, ratings, crew, principals, min_rating, min_titles, types).orderBy(
        *_best_first()
    )


def top_performers(
    titles: DataFrame,
    ratings: DataFrame,
    crew: DataFrame,
    principals: DataFrame,
    min_rating: float = 8.0,
    min_titles: int = 5,
    count: int = 10,
    types: Iterable[str] = RELEVANT_TYPES,
) -> DataFrame:
    """The first few of :func:`high_performing_crew`."""
    kept = _high_performers(titles, ratings, crew, principals, min_rating, min_titles, types)
    return top_rows(kept, count, *_best_first())


def crew_scatter(
    titles: DataFrame,
    ratings: DataFrame,
    crew: DataFrame,
    principals: DataFrame,
    count: int = 20,
    types: Iterable[str] = RELEVANT_TYPES,
) -> DataFrame:
    """The most popular people as points (popularity, mean, titles, votes)."""
    best = top_rows(_performance(titles, ratings, crew, principals, types), count, *_popular_first())
    return best.select("nconst", "role", "weighted_popularity", "avg_rating", "num_titles", "total_votes")


def _consistency(titles: DataFrame, ratings: DataFrame, crew: DataFrame, lists: str, name: str) -> DataFrame:
    rated = with_ratings(eligible(titles, genres=True), ratings)
    credited = rated.join(crew.select("tconst", lists), "tconst")
    return summarise(
        unfold(credited, lists, name),
        name,
        avg_rating=F.avg("averageRating"),
        rating_stddev=F.stddev("averageRating"),
        num_titles=F.count("*"),
    ).orderBy(F.desc_nulls_last(settled(F.col("avg_rating"))), name)


def director_consistency(titles: DataFrame, ratings: DataFrame, crew: DataFrame) -> DataFrame:
    """Mean and sample deviation of the ratings of each director's titles."""
    return _consistency(titles, ratings, crew, "directors", "director")


def writer_consistency(titles: DataFrame, ratings: DataFrame, crew: DataFrame) -> DataFrame:
    """Mean and sample deviation of the ratings of each writer's titles."""
    return _consistency(titles, ratings, crew, "writers", "writer")
