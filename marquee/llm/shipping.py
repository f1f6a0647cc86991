"""Makes this package importable in Python workers, wherever they run."""

from __future__ import annotations

import ctypes
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from hashlib import md5
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.storage import shared_folder

#: Applications that have the package already.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the session's files, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[2]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted((top / "marquee").rglob("*.py")):
            archive.writestr(zipfile.ZipInfo(str(source.relative_to(top))), source.read_bytes())
    name = f"{shared_folder(spark)}/sources-{md5(packed.getvalue()).hexdigest()}-{context.applicationId}.zip"
    path = context._jvm.org.apache.hadoop.fs.Path(name)
    target = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path, True)
    target.write(packed.getvalue())
    target.close()
    context.addPyFile(name)
    _SHIPPED.add(context.applicationId)


def give_back() -> None:
    """Returns memory that is free to the system, from Arrow and, where there is such a call, from the C library."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Texts are long, so fewer rows than Spark's usual ten thousand go to a Python worker at once.
ROWS_AT_ONCE = 500
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_tasks(frame: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand; memory that a task no longer needs goes back at its end.

    Workers live on between tasks, and what they keep adds up.  A smaller batch size that the session
    sets is left as it is.
    """
    session = frame.sparkSession
    ship(session)
    if int(session.conf.get(_ROWS_SETTING)) > ROWS_AT_ONCE:
        session.conf.set(_ROWS_SETTING, str(ROWS_AT_ONCE))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return frame.mapInArrow(run, schema)
