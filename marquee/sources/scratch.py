"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from marquee.sources.catalogue import join_path

_KEPT: set[str] = set()
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or without it the warehouse, unless that is a local folder of a cluster's driver."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith("/") or warehouse.startswith("file:")
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written meanwhile go when it is written, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored_once(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as written to and read back from a new scratch folder, so that later passes do not compute it again."""
    spark = frame.sparkSession
    path = scratch_folder(spark, purpose)
    with shuffles_removed(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below ``spark.checkpoint.dir``, or without it below the warehouse.

    What is written there is removed when the process ends.
    """
    path = join_path(shared_base(spark), f"marquee-{purpose}-{uuid.uuid4().hex}")
    if not _KEPT:
        atexit.register(remove_all)
    _KEPT.add(path)
    return path


def remove(path: str) -> None:
    """Deletes a folder that :func:`scratch_folder` named."""
    jvm = SparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    active = SparkContext._active_spark_context
    settings = active._jsc.hadoopConfiguration() if active else jvm.org.apache.hadoop.conf.Configuration()
    folder.getFileSystem(settings).delete(folder, True)
    _KEPT.discard(path)


def remove_all() -> None:
    for path in sorted(_KEPT):
        remove(path)
