"""Tables written on the way, in the folder that all executors share.

Written tables cut the lineage: after an executor is lost, only what was not yet written is made
again.  The folder is ``spark.checkpoint.dir``; without it, the warehouse.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from marquee.sources.catalogue import join_path
from marquee.sources.scratch import shared_base, shuffles_removed

_WRITTEN: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    return join_path(shared_base(spark), "llm")


def stored(spark: SparkSession, frame: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """The frame as written to and read back from a new folder."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        frame.write.options(**(options or {})).parquet(path)
    if not _WRITTEN:
        atexit.register(drop_all, spark)
    _WRITTEN.add(path)
    return spark.read.schema(frame.schema).parquet(path)


def stored_in_buckets(spark: SparkSession, frame: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As :func:`stored`, dealt by ``key``: a join on it with another frame moves only the other one."""
    label = uuid.uuid4().hex
    path = f"{shared_folder(spark)}/{name}-{label}"
    dealt = frame.write.bucketBy(buckets, key).sortBy(key).option("compression", "zstd").option("path", path)
    with shuffles_removed(spark):
        dealt.saveAsTable(f"llm_{name}_{label}")
    if not _WRITTEN:
        atexit.register(drop_all, spark)
    _WRITTEN.add(path)
    return spark.table(f"llm_{name}_{label}")


def drop(spark: SparkSession, frame: DataFrame) -> None:
    """Removes the files of a stored frame that nothing reads any more."""
    for file in frame.inputFiles():
        path = file.rsplit("/", 1)[0]
        for known in [p for p in _WRITTEN if path.endswith(p.split(":", 1)[-1])]:
            _remove(spark, known)
        return


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _WRITTEN.discard(path)


def drop_all(spark: SparkSession) -> None:
    """At the end of the session's process; the files of lazily read results live until then."""
    if spark.sparkContext._jsc is None:
        return
    for path in list(_WRITTEN):
        try:
            _remove(spark, path)
        except Exception:  # the session is already gone
            return
