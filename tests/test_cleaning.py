import pytest
from conftest import rows

from marquee.operators import shaping
from marquee.models.embeddings import with_genre_list


def test_drop_nulls(small):
    kept = shaping.handle_nulls(small.titles, ["startYear", "runtimeMinutes"])
    assert sorted(rows(kept, "tconst")) == [("t1",), ("t2",), ("t3",), ("t4",), ("t5",), ("t8",)]


def test_fill_touches_numbers_only(small):
    filled = shaping.handle_nulls(small.titles, ["runtimeMinutes", "genres"], "fill")
    got = {r.tconst: r for r in filled.collect()}
    assert got["t7"].runtimeMinutes == 0 and got["t7"].genres is None


def test_unknown_strategy(small):
    with pytest.raises(ValueError):
        shaping.handle_nulls(small.titles, ["genres"], "guess")


def test_fill_with_values(small):
    filled = shaping.fill_with(small.titles, {"genres": ""})
    assert filled.where("genres IS NULL").count() == 0


def test_one_per_key_keeps_the_smallest(small):
    keys = ["tconst", "nconst", "category"]
    kept = shaping.one_per_key(small.principals, keys, ["job"])
    assert kept.columns == small.principals.columns
    got = {tuple(r)[:3]: r.job for r in kept.collect()}
    assert len(got) == 7
    assert got[("t1", "n5", "producer")] == "executive"
    assert got[("t1", "n3", "writer")] == "screenplay"
    assert shaping.one_per_key(small.principals, keys).count() == 7


def test_relevant_titles(small):
    assert sorted(rows(shaping.relevant_titles(small.titles), "tconst")) == [
        ("t1",),
        ("t2",),
        ("t3",),
        ("t5",),
        ("t8",),
    ]


def test_genre_list_must_not_be_empty(spark, small):
    assert sorted(rows(with_genre_list(small.titles), "tconst")) == [(f"t{i}",) for i in (1, 2, 3, 4, 5, 6, 8)]
    blank = spark.createDataFrame([("a", ""), ("b", "X,Y"), ("c", None)], "tconst string, genres string")
    assert rows(with_genre_list(blank), "tconst") == [("b",)]


def test_crew_beside_titles_changes_no_result(small):
    relevant = shaping.with_ratings(shaping.relevant_titles(small.titles), small.ratings)
    enriched = shaping.with_crew(relevant, small.crew)
    columns = ("tconst", "averageRating", "numVotes")
    assert sorted(rows(enriched, *columns), key=str) == sorted(rows(relevant, *columns), key=str)
