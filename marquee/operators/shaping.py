"""Frame-to-frame steps: cleaning, selecting titles, summaries, top rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.columns import listed, unmark
from marquee.schemas import RELEVANT_TYPES, TABLES


# Comma lists; an empty one is a null like the marker.
LIST_COLUMNS = ("genres", "directors", "writers")


def normalise(frame: DataFrame, table: str) -> DataFrame:
    """Null markers become nulls and numeric text becomes numbers (bad text: null).

    Columns that already have their number type are left alone, so a filter on
    them still reaches the file scan.
    """
    targets = TABLES[table].types
    columns = []
    for column in frame.schema.fields:
        value = F.col(column.name)
        if isinstance(column.dataType, T.StringType):
            value = unmark(value)
            if column.name in LIST_COLUMNS:
                value = F.nullif(value, F.lit(""))
        wanted = targets.get(column.name)
        if wanted and column.dataType.simpleString() != wanted:
            value = value.try_cast(wanted)
        columns.append(value.alias(column.name))
    return frame.select(*columns)


def handle_nulls(frame: DataFrame, columns: Sequence[str], strategy: str = "drop") -> DataFrame:
    """Drop rows with a null in ``columns``, or fill their numeric columns with 0."""
    if strategy == "drop":
        return frame.dropna(subset=list(columns))
    if strategy == "fill":
        return frame.fillna(0, subset=list(columns))
    raise ValueError(f"unknown strategy {strategy!r}: use 'drop' or 'fill'")


def fill_with(frame: DataFrame, values: dict[str, object]) -> DataFrame:
    """Fill nulls column by column."""
    return frame.fillna(values)


def one_per_key(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key; with ``order_by`` always the smallest row in that order.

    The smallest row is found by a ``min`` over a struct, which combines on the
    map side: a key with very many copies never gathers in one task.
    """
    if not order_by:
        return frame.dropDuplicates(list(keys))
    rest = [c for c in order_by if c not in keys]
    rest += [c for c in frame.columns if c not in rest and c not in keys]
    smallest = frame.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return smallest.select(*keys, "row.*").select(*frame.columns)


def eligible(
    titles: DataFrame,
    types: Iterable[str] | None = None,
    genres: bool = False,
) -> DataFrame:
    """Titles that are not adult, optionally of given types and with a genre list."""
    kept = titles.where(F.col("isAdult") == 0)
    if genres:
        kept = kept.where(F.col("genres").isNotNull())
    if types is not None:
        kept = kept.where(F.col("titleType").isin(*types))
    return kept


def relevant_titles(titles: DataFrame, types: Iterable[str] = RELEVANT_TYPES) -> DataFrame:
    return eligible(titles, types, genres=True)


def with_ratings(titles: DataFrame, ratings: DataFrame, how: str = "left") -> DataFrame:
    """Titles with ``averageRating`` and ``numVotes`` beside them."""
    return titles.join(ratings.select("tconst", "averageRating", "numVotes"), "tconst", how)


def with_crew(titles: DataFrame, crew: DataFrame, how: str = "left") -> DataFrame:
    """Titles with their ``directors`` and ``writers`` lists beside them."""
    return titles.join(crew.select("tconst", "directors", "writers"), "tconst", how)


def unfold(frame: DataFrame, column: str, name: str) -> DataFrame:
    """One row per element of a comma list; rows without a list vanish."""
    return frame.withColumn(name, F.explode(listed(column))).drop(column)


def summarise(frame: DataFrame, keys: str | Sequence[str], **measures: Column) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return frame.groupBy(*keys).agg(*(value.alias(name) for name, value in measures.items()))


def top_rows(frame: DataFrame, count: int, *order: Column | str) -> DataFrame:
    """First ``count`` rows; the last order column must be unique to fix ties."""
    return frame.orderBy(*order).limit(count)
