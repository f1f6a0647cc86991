"""Text files read with a look at every line: rows that fit their table, and those that do not, with the reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.columns import unmark
from marquee.operators.shaping import normalise
from marquee.schemas import TABLES
from marquee.sources.catalogue import TEXT_OPTIONS, join_path
from marquee.sources.scratch import scratch_folder

#: Columns of rejected rows.
REJECT_COLUMNS = ["file", "reason", "line"]
_LINE = "_corrupt_line"


@dataclass(frozen=True)
class Checked:
    """``accepted`` rows, typed; ``rejected`` rows as ``file, reason, line``.  Together they are all rows of the files."""

    accepted: DataFrame
    rejected: DataFrame


def _reasons(table: str, columns: Sequence[str]) -> Column:
    """Why a row does not fit, or null: its number of fields, numbers that are none, a key that is missing."""
    source = TABLES[table]
    fields = F.size(F.split(F.col(_LINE), "\t"))
    shape = (
        F.when(F.col(_LINE).isNull(), None)
        .when(fields < len(columns), "too few fields")
        .when(fields > len(columns), "too many fields")
        .otherwise("malformed")
    )
    checks = [
        F.when(unmark(F.col(name)).isNotNull() & F.col(name).try_cast(kind).isNull(), f"{name}: not a number")
        for name, kind in source.types.items()
        if name in columns
    ]
    key = source.order[0]
    checks.append(F.when(unmark(F.col(key)).isNull(), f"{key}: missing"))
    found = F.array_compact(F.array(*checks))
    return F.coalesce(shape, F.when(F.size(found) > 0, F.array_join(found, "; ")))


def read_checked(spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None) -> Checked:
    """Tab-separated text, plain or gzip, split into rows that fit ``table`` and rows that do not.

    ``columns`` names the fields of files without a header.  Fields that are not there, or too many, numbers that cannot be
    read and a missing first key column make a row a reject; null markers are sound.  The files are read once, into a table in the shared
    folder, from which both frames are read.  Empty lines are no rows.
    """
    plain = {k: v for k, v in TEXT_OPTIONS.items() if k not in ("header", "nullValue")}
    if columns is None:
        columns = spark.read.options(**TEXT_OPTIONS).csv(path).columns
        header = True
    else:
        header = False
    missing = [c for c in TABLES[table].required if c not in columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _LINE]])
    # All fields are parsed, or a line with too many would pass for one that fits.
    reader = spark.read.options(**plain, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE, columnPruning=False)
    lines = reader.schema(schema).csv(path).withColumn("_file", F.element_at(F.split("_metadata.file_path", "/"), -1))
    stage = scratch_folder(spark, "checked")
    lines.withColumn("_reason", _reasons(table, columns)).write.parquet(stage)
    staged = spark.read.parquet(stage)
    whole = F.coalesce(F.col(_LINE), F.concat_ws("\t", *(F.coalesce(F.col(c), F.lit("")) for c in columns)))
    rejected = staged.where("_reason IS NOT NULL").select(F.col("_file").alias("file"), F.col("_reason").alias("reason"), whole.alias("line"))
    return Checked(normalise(staged.where("_reason IS NULL").select(*columns), table), rejected)


def ingest_checked(
    spark: SparkSession, text_base: str, parquet_base: str, table: str, columns: Sequence[str] | None = None
) -> tuple[str, str]:
    """Convert a dataset to typed Parquet, its rejects to a table of their own; returns both paths."""
    source = TABLES[table]
    found = read_checked(spark, join_path(text_base, source.text_file), table, columns)
    target = join_path(parquet_base, source.parquet_dir)
    beside = f"{target}_rejects"
    found.accepted.hint("rebalance").write.mode("overwrite").parquet(target)
    found.rejected.write.mode("overwrite").parquet(beside)
    return target, beside
