"""Writing tables: text to typed Parquet, catalogue text, result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.functions.columns import NULL_MARKER
from marquee.schemas import TABLES
from marquee.sources.catalogue import join_path, read_text


def ingest(spark: SparkSession, text_base: str, parquet_base: str, table: str, files: int | None = None) -> str:
    """Convert one ``.tsv.gz`` dataset to typed Parquet and return its path.

    A gzip file is read by one task, so rows are dealt out once here: into
    ``files`` parts, or into parts of Spark's advisory size if not given.
    """
    source = TABLES[table]
    typed = read_text(spark, join_path(text_base, source.text_file), table)
    spread = typed.repartition(files) if files else typed.hint("rebalance")
    target = join_path(parquet_base, source.parquet_dir)
    spread.write.mode("overwrite").parquet(target)
    return target


def save_bucketed(frame: DataFrame, table: str, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Save a catalogue table bucketed and sorted by its join key and read it back.

    Tables saved with the same number of buckets join on that key without a shuffle.
    """
    key = TABLES[table].order[0]
    writer = frame.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return frame.sparkSession.table(name)


def write_text(frame: DataFrame, path: str) -> None:
    """Gzip tab-separated text with a header and the null marker."""
    frame.write.mode("overwrite").csv(
        path,
        sep="\t",
        header=True,
        nullValue=NULL_MARKER,
        emptyValue="",
        quote="",
        escapeQuotes=False,
        compression="gzip",
    )


def write_csv(frame: DataFrame, path: str) -> None:
    """Result table as comma text with a header, replacing what is there."""
    frame.write.mode("overwrite").csv(path, header=True)
