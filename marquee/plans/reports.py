"""Analyses that belong together, as named frames; each is run only when asked for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from marquee.plans import crew as crews
from marquee.plans import genres, ratings as rates, runtime
from marquee.schemas import RELEVANT_TYPES

Report = dict[str, DataFrame]


def top_rated(titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES, count: int = 10) -> Report:
    types = tuple(types)
    return {
        "top_rated_genre": genres.top_rated_genres(titles, ratings, types),
        "top_rated_title_type": rates.ratings_by_title_type(titles, ratings, types),
        "top_rated_overall": rates.top_rated_titles(titles, ratings, count, types),
    }


def rating_spread(titles: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES) -> Report:
    types = tuple(types)
    return {
        "rating_distribution": rates.rating_distribution(titles, ratings, types),
        "rating_ranges": rates.rating_ranges(titles, ratings, types),
        "rating_histogram": rates.rating_histogram(titles, ratings, types=types),
    }


def rating_consistency(titles: DataFrame, ratings: DataFrame, crew: DataFrame | None = None) -> Report:
    """By genre, and also by director and writer if the crew table is given."""
    report = {"genres": genres.genre_consistency(titles, ratings)}
    if crew is not None:
        report["directors"] = crews.director_consistency(titles, ratings, crew)
        report["writers"] = crews.writer_consistency(titles, ratings, crew)
    return report


def consistent_genres(titles: DataFrame, ratings: DataFrame, min_titles: int = 50, count: int = 5) -> Report:
    return {
        "most_consistent_genres": genres.consistent_genres(titles, ratings, True, min_titles, count),
        "most_inconsistent_genres": genres.consistent_genres(titles, ratings, False, min_titles, count),
    }


def popularity_by_place(
    titles: DataFrame, akas: DataFrame, ratings: DataFrame, types: Iterable[str] = RELEVANT_TYPES
) -> Report:
    types = tuple(types)
    return {
        f"by_{place}": genres.genre_popularity_by(titles, akas, ratings, place, types)
        for place in ("region", "language")
    }


def runtime_and_rating(titles: DataFrame, ratings: DataFrame) -> Report:
    return {
        "pairs": runtime.runtime_rating_pairs(titles, ratings),
        "correlation": runtime.runtime_rating_correlation(titles, ratings),
    }
