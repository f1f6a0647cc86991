"""Reading catalogue tables: columnar, tab-separated and comma text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.columns import NULL_MARKER
from marquee.operators.shaping import normalise
from marquee.schemas import TABLES

TEXT_OPTIONS = {"sep": "\t", "header": True, "nullValue": NULL_MARKER, "quote": ""}


def join_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def read_columnar(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Parquet file or directory at any path Hadoop can open; typed if ``table`` is named."""
    frame = spark.read.parquet(path)
    return normalise(frame, table) if table else frame


def read_text(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Tab-separated text with a header, plain or gzip; quotes are ordinary characters."""
    frame = spark.read.options(**TEXT_OPTIONS).csv(path)
    if table:
        missing = [c for c in TABLES[table].required if c not in frame.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
    return normalise(frame, table) if table else frame


def read_comma_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True)


class Catalogue:
    """The seven tables below one base path on any Hadoop file system, read lazily.

    Set ``ingested`` for tables written by :func:`marquee.sources.ingest.ingest`:
    their types and nulls are already right, so they are read untouched and
    filters on any column reach the scan.
    """

    def __init__(self, spark: SparkSession, base: str, ingested: bool = False):
        self.spark = spark
        self.base = base
        self.ingested = ingested

    def table(self, name: str) -> DataFrame:
        path = join_path(self.base, TABLES[name].parquet_dir)
        return read_columnar(self.spark, path, None if self.ingested else name)

    def titles(self) -> DataFrame:
        return self.table("titles")

    def ratings(self) -> DataFrame:
        return self.table("ratings")

    def names(self) -> DataFrame:
        return self.table("names")

    def akas(self) -> DataFrame:
        return self.table("akas")

    def episodes(self) -> DataFrame:
        return self.table("episodes")

    def principals(self) -> DataFrame:
        return self.table("principals")

    def crew(self) -> DataFrame:
        return self.table("crew")


def table_schemas(
    frames: dict[str, DataFrame], rows: int = 5, order_by: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """Name, place and type of every column, each with the values of ``rows`` rows.

    Any rows will do, so no table is read further than that.  With
    ``order_by`` a table's first rows by these columns are shown.
    """
    parts = []
    for name, frame in frames.items():
        order = (order_by or {}).get(name, ())
        sample = (frame.orderBy(*(F.asc_nulls_last(c) for c in order)) if order else frame).limit(rows)
        cells = F.array(
            *(
                F.struct(
                    F.lit(position).alias("position"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("data_type"),
                    F.col(field.name).cast("string").alias("value"),
                )
                for position, field in enumerate(frame.schema.fields)
            )
        )
        parts.append(sample.select(F.lit(name).alias("table_name"), F.inline(cells)))
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.unionByName(part)
    return joined
