"""Text against Parquet: rows, bytes and read time of the same datasets."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.schemas import TABLES
from marquee.sources.catalogue import join_path, read_columnar, read_text

# Names of the measures, and savings as percentages of the text's.
MEASURES = "dataset string, tsv_count long, parquet_count long, tsv_size long, parquet_size long, tsv_time double, parquet_time double"


def stored_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes below ``path``, or None if it is missing; file contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return files.agg(F.sum("length")).first()[0]


def timed_count(frame: DataFrame) -> tuple[int, float]:
    started = time.perf_counter()
    return frame.count(), time.perf_counter() - started


def compare_formats(
    spark: SparkSession,
    text_base: str,
    parquet_base: str,
    tables: Iterable[str] = tuple(TABLES),
) -> DataFrame:
    """One row per table stored in both formats; a table missing in one is skipped.

    ``compression_ratio`` and ``speedup`` are percentages saved by Parquet.
    Both sides are timed over a row count.
    """
    measured = []
    for table in tables:
        source = TABLES[table]
        text_path = join_path(text_base, source.text_file)
        parquet_path = join_path(parquet_base, source.parquet_dir)
        text_bytes, parquet_bytes = stored_bytes(spark, text_path), stored_bytes(spark, parquet_path)
        if text_bytes is None or parquet_bytes is None:
            continue
        text_rows, text_seconds = timed_count(read_text(spark, text_path))
        parquet_rows, parquet_seconds = timed_count(read_columnar(spark, parquet_path))
        measured.append(
            (source.dataset, text_rows, parquet_rows, text_bytes, parquet_bytes, text_seconds, parquet_seconds)
        )

    def saved(before: str, after: str):
        return F.try_divide(F.col(before) - F.col(after), F.col(before)) * 100

    return spark.createDataFrame(measured, MEASURES).select(
        "*",
        saved("tsv_size", "parquet_size").alias("compression_ratio"),
        saved("tsv_time", "parquet_time").alias("speedup"),
    )


def format_summary(comparison: DataFrame) -> DataFrame:
    """Mean times and savings, and the dataset that gains most in each respect."""
    return comparison.agg(
        F.count("dataset").alias("datasets"),
        F.avg("tsv_time").alias("avg_tsv_time"),
        F.avg("parquet_time").alias("avg_parquet_time"),
        F.avg("speedup").alias("avg_speedup"),
        F.avg("compression_ratio").alias("avg_compression_ratio"),
        F.max_by("dataset", "speedup").alias("fastest_gain"),
        F.max("speedup").alias("best_speedup"),
        F.max_by("dataset", "compression_ratio").alias("smallest"),
        F.max("compression_ratio").alias("best_compression_ratio"),
    )
