"""Plans that matter at scale: narrow scans, pushed filters, shared shuffles."""

import re

from marquee.operators.distribution import histogram
from marquee.plans import genres, ratings


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_consistency_reads_what_it_needs(small):
    text = physical(genres.genre_consistency(small.titles, small.ratings))
    assert {"tconst", "isAdult", "genres"} in read_columns(text)
    assert {"tconst", "averageRating"} in read_columns(text)
    assert "EqualTo(isAdult,0)" in text and "IsNotNull(genres)" in text


def test_relevant_types_reach_the_scan(small):
    text = physical(ratings.rating_ranges(small.titles, small.ratings))
    assert "In(titleType, [movie,tvSeries])" in text


def test_lists_are_unfolded_after_the_join(small):
    text = physical(genres.genre_trends(small.titles, small.ratings))
    assert text.index("Generate explode") < text.index("Join [tconst")


def test_histogram_scans_once(small):
    frame = histogram(small.ratings, "averageRating")
    frame.collect()
    final = physical(frame)
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in final and "NestedLoop" not in final
