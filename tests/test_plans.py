import pytest
from conftest import rows
from pyspark.sql import functions as F

from marquee.plans import crew, genres, places, ratings, reports, runtime, trends


def test_genre_distribution(small):
    assert rows(genres.genre_distribution(small.titles)) == [("Drama", 5), ("Comedy", 2), ("Horror", 2)]


def test_genre_rating_correlation(small):
    got = {(r.var_x, r.var_y): r.corr for r in genres.genre_rating_correlation(small.titles, small.ratings).collect()}
    # Drama (8 + 2 + 9.9 + 6) / 4 with 4 titles, Comedy 8 with 2, Horror 8 with 2.
    assert got[("avg_rating", "genre_count")] == pytest.approx(-1.0)
    assert got[("avg_rating", "avg_rating")] == pytest.approx(1.0)
    assert got[("genre_count", "avg_rating")] == got[("avg_rating", "genre_count")]


def test_genre_popularity(small):
    got = {r.genre: r for r in genres.genre_popularity(small.titles, small.ratings).collect()}
    drama = got["Drama"]
    assert (drama.total_titles, drama.total_votes, drama.movie_count, drama.tvseries_count) == (4, 170, 3, 1)
    assert drama.avg_rating == pytest.approx(16 / 3)
    assert drama.weighted_popularity == pytest.approx(16 / 3 * 170)
    assert drama.title_percentage == pytest.approx(80.0)
    assert sum(r.popularity_score for r in got.values()) == pytest.approx(1.0)


def test_genre_trends(small):
    assert genres.genre_trends(small.titles, small.ratings).count() == 0
    got = genres.genre_trends(small.titles, small.ratings, min_titles=0)
    assert rows(got, "startYear", "genre", "title_count", "total_votes", "genre_rank") == [
        (2000, "Drama", 2, 110, 1),
        (2000, "Comedy", 1, 100, 2),
        (2001, "Drama", 1, 60, 1),
        (2001, "Horror", 1, 60, 1),
        (2002, "Comedy", 1, 50, 1),
        (2002, "Drama", 1, 5, 2),
    ]


def test_genre_popularity_by_region_counts_every_copy(small):
    got = genres.genre_popularity_by(small.titles, small.akas, small.ratings, "region")
    assert rows(got) == [
        ("US", "Drama", 2, 5.0, 55.0),
        (None, "Comedy", 1, 8.0, 100.0),
        (None, "Drama", 1, 8.0, 100.0),
        ("FR", "Comedy", 1, 8.0, 100.0),
        ("FR", "Drama", 1, 8.0, 100.0),
        ("None", "Comedy", 1, 8.0, 50.0),
        ("US", "Comedy", 1, 8.0, 100.0),
    ]
    languages = genres.genre_popularity_by(small.titles, small.akas, small.ratings, "language")
    null_drama = languages.where("language IS NULL AND genre = 'Drama'").first()
    assert (null_drama.total_titles, null_drama.avg_rating) == (2, 5.0)


def test_emerging_and_declining(small):
    got = genres.emerging_declining_genres(small.titles, small.ratings)
    assert rows(got, "genre", "startYear", "popularity_change", "trend") == [
        ("Drama", 2001, 360.0 - 550.0, "declining"),
        ("Comedy", 2002, 400.0 - 800.0, "declining"),
    ]
    shares = got.groupBy("startYear").agg(F.max("total_titles_year").alias("n")).collect()
    assert {r.startYear: r.n for r in shares} == {2001: 2, 2002: 2}


def test_shares_of_a_year_sum_to_100(small):
    everything = genres.emerging_declining_genres(small.titles, small.ratings)
    for row in everything.collect():
        assert row.title_percentage == pytest.approx(row.total_titles / row.total_titles_year * 100)


def test_consistency(small):
    got = {r.genre: r for r in genres.genre_consistency(small.titles, small.ratings).collect()}
    assert got["Drama"].num_titles == 4
    assert got["Drama"].rating_stddev == pytest.approx(((8 - 16 / 3) ** 2 + (2 - 16 / 3) ** 2 + (6 - 16 / 3) ** 2) ** 0.5 / 2**0.5)
    assert got["Horror"].avg_rating == 8.0
    preferences = {r.genre: r.avg_votes for r in genres.audience_preferences_by_genre(small.titles, small.ratings).collect()}
    assert preferences["Horror"] == 33.5
    steady = genres.consistent_genres(small.titles, small.ratings, min_titles=1, count=2)
    loose = genres.consistent_genres(small.titles, small.ratings, most=False, min_titles=1, count=1)
    assert rows(steady, "genre") == [("Comedy",), ("Horror",)]
    assert rows(loose, "genre") == [("Drama",)]


def test_a_single_rating_has_no_deviation(spark):
    titles = spark.createDataFrame([("a", 0, "X"), ("b", 0, "X")], "tconst string, isAdult int, genres string")
    rated = spark.createDataFrame([("a", 7.0, 1)], "tconst string, averageRating double, numVotes int")
    only = genres.genre_consistency(titles, rated).first()
    assert (only.avg_rating, only.rating_stddev, only.num_titles) == (7.0, None, 2)
    assert genres.consistent_genres(titles, rated, min_titles=0).count() == 0


def test_by_title_type(small):
    got = rows(ratings.ratings_by_title_type(small.titles, small.ratings))
    assert got == [("tvSeries", 7.0, 2), ("movie", 5.0, 3)]
    assert rows(genres.top_rated_genres(small.titles, small.ratings))[0] == ("Comedy", 8.0, 2)


def test_top_titles_break_ties_by_id(small):
    got = rows(ratings.top_rated_titles(small.titles, small.ratings), "tconst", "averageRating")
    assert got == [("t1", 8.0), ("t3", 8.0), ("t8", 6.0), ("t2", 2.0), ("t5", None)]


def test_rating_distribution_and_ranges(small):
    assert rows(ratings.rating_distribution(small.titles, small.ratings)) == [(8.0, 2), (6.0, 1), (2.0, 1), (None, 1)]
    assert rows(ratings.rating_ranges(small.titles, small.ratings)) == [
        ("2-4", 1),
        ("6-8", 1),
        ("8-10", 2),
        ("unrated", 1),
    ]


def test_variance_by_type(small):
    got = {r.titleType: r for r in ratings.rating_variance_by_title_type(small.titles, small.ratings).collect()}
    assert got["short"].rating_variance == 0.0
    assert got["tvSeries"].rating_variance == pytest.approx(1.0)
    assert got["movie"].num_titles == 3


def test_runtime(small):
    pairs = sorted(rows(runtime.runtime_rating_pairs(small.titles, small.ratings)))
    assert pairs == [
        (29, 8.0, "movie"),
        (30, 2.0, "movie"),
        (60, 8.0, "tvSeries"),
        (90, 9.9, "movie"),
        (120, 6.0, "tvSeries"),
    ]
    bands = {r.runtime_bin: r.num_titles for r in runtime.runtime_perception(small.titles, small.ratings).collect()}
    assert bands == {"<30 min": 1, "30-60 min": 2, "90-120 min": 1, ">120 min": 1, "unknown": 2}
    corr = runtime.runtime_rating_correlation(small.titles, small.ratings)
    assert corr.count() == 4


def test_regions(small):
    got = rows(places.ratings_by_region(small.akas, small.ratings, min_titles=0))
    assert got == [("FR", 8.0, 1), ("US", 5.0, 2)]
    assert rows(places.ratings_by_region(small.akas, small.ratings, min_titles=1)) == [("US", 5.0, 2)]
    assert rows(places.top_regions(small.akas, small.ratings, min_titles=0, count=1), "region") == [("FR",)]


def test_content_type_trends(small):
    assert rows(trends.content_type_trends(small.titles)) == [
        (2000, "movie", 2),
        (2001, "movie", 1),
        (2001, "tvSeries", 1),
        (2002, "movie", 2),
        (2002, "tvSeries", 1),
    ]


def test_directors_and_jobs(small):
    assert rows(crew.director_productivity(small.crew)) == [("n1", 3), ("n2", 2)]
    assert rows(crew.job_distribution(small.principals))[0] == ("director", None, 2)
    people = rows(crew.multi_role_people(small.principals))
    assert people == [
        ("n1", 3, ["director", "writer"]),
        ("n5", 3, ["producer"]),
        ("n3", 2, ["writer"]),
        ("n4", 1, ["writer"]),
    ]


def test_repeated_credits_multiply(small):
    assert rows(crew.collaboration_network(small.principals)) == [("n1", "n5", 3)]


def test_crew_contribution(small):
    got = crew.crew_contribution(small.titles, small.crew, small.ratings, min_titles=1)
    assert rows(got, "nconst", "avg_title_rating", "total_titles", "tconst") == [
        ("n2", 8.0, 2, "t1"),
        ("n2", 8.0, 2, "t3"),
        ("n1", 5.0, 2, "t1"),
        ("n1", 5.0, 2, "t2"),
    ]
    lists = crew.crew_contribution(small.titles, small.crew, small.ratings, min_titles=1, as_lists=True)
    assert rows(lists) == [("n2", 8.0, 2, ["Alpha", "Gamma"]), ("n1", 5.0, 2, ["Alpha", "Beta"])]
    assert crew.crew_contribution(small.titles, small.crew, small.ratings).count() == 0


def test_crew_performance(small):
    tables = (small.titles, small.ratings, small.crew, small.principals)
    got = crew.crew_performance(*tables)
    assert sorted(rows(got, "role", "nconst", "avg_rating", "num_titles", "total_votes")) == [
        ("director", "n1", 5.0, 3, 110),
        ("director", "n2", 8.0, 2, 150),
        ("writer", "n1", 6.0, 1, 60),
        ("writer", "n3", 8.0, 1, 100),
        ("writer", "n4", 8.0, 1, 50),
    ]
    high = crew.high_performing_crew(*tables, min_titles=1)
    assert rows(high, "role", "nconst") == [("director", "n2"), ("writer", "n3"), ("writer", "n4")]
    assert set(rows(high)) <= set(rows(got))
    assert crew.high_performing_crew(*tables).count() == 0
    assert rows(crew.top_performers(*tables, min_titles=1, count=1)) == rows(high)[:1]
    assert rows(crew.crew_scatter(*tables, count=2), "nconst", "role") == rows(got, "nconst", "role")[:2]


def test_crew_consistency(small):
    directors = rows(crew.director_consistency(small.titles, small.ratings, small.crew), "director", "num_titles")
    assert directors == [("n2", 2), ("n1", 3)]
    writers = {r.writer: r for r in crew.writer_consistency(small.titles, small.ratings, small.crew).collect()}
    assert writers["n3"].num_titles == 3 and writers["n3"].avg_rating == pytest.approx(22 / 3)
    assert writers["n4"].num_titles == 2 and writers["n4"].rating_stddev is None


def test_reports_name_their_frames(small):
    assert set(reports.rating_consistency(small.titles, small.ratings)) == {"genres"}
    assert set(reports.rating_consistency(small.titles, small.ratings, small.crew)) == {"genres", "directors", "writers"}
    assert set(reports.top_rated(small.titles, small.ratings)) == {
        "top_rated_genre",
        "top_rated_title_type",
        "top_rated_overall",
    }
    assert set(reports.popularity_by_place(small.titles, small.akas, small.ratings)) == {"by_region", "by_language"}
    assert len(reports.rating_spread(small.titles, small.ratings)) == 3
    assert len(reports.consistent_genres(small.titles, small.ratings)) == 2
    assert len(reports.runtime_and_rating(small.titles, small.ratings)) == 2


def test_analyses_are_lazy(spark, small):
    tables = (small.titles, small.ratings, small.crew, small.principals)
    spark.sparkContext.setJobGroup("lazy", "building plans must run nothing")
    try:
        genres.genre_popularity(small.titles, small.ratings)
        genres.emerging_declining_genres(small.titles, small.ratings)
        ratings.rating_histogram(small.titles, small.ratings)
        ratings.rating_boxplot_by_title_type(small.titles, small.ratings)
        crew.crew_performance(*tables)
        crew.collaboration_network(small.principals)
        crew.crew_contribution(small.titles, small.crew, small.ratings)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_crew_changes_nothing_else(spark, small):
    plain = genres.genre_popularity(small.titles, small.ratings)
    # A second crew row of a title must not count it twice.
    doubled = small.crew.unionByName(small.crew.where("tconst = 't1'"))
    found = genres.genre_popularity(small.titles, small.ratings, crew=doubled)
    assert rows(found.select(*plain.columns)) == rows(plain)
    counts = {r.genre: (r.directed_titles, r.written_titles) for r in found.collect()}
    # Of the dramas t1, t2, t5 and t8 the last has no director and t2 no writer.
    assert counts["Drama"] == (3, 3)
