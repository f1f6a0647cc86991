"""Correlations of all dimensions of a vector column from one mergeable aggregate."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = "at int, part int, rows long, mean array<double>, products array<double>"
#: Groups that the parts of a dimension are merged in first.
GROUPS = 64


def centred_products(frame: DataFrame, vector: str, size: int) -> DataFrame:
    """Per dimension ``at``: ``rows``, the ``mean`` of all dimensions and their centred ``products`` with it.

    Each task holds one square of ``size`` doubles and sends it by rows.  What is merged are centred
    sums, so that large means do not use up the digits.  All helpers are local, so that tasks need not import this package.
    """

    def joined(states: Iterable[tuple[float, np.ndarray, np.ndarray]], at: int | slice) -> tuple[float, np.ndarray, np.ndarray]:
        # Rows, means and centred products of several parts; ``at`` says whose dimension the products are of.
        rows, mean, products = 0.0, np.zeros(0), np.zeros(0)
        for more, centre, own in states:
            if not rows:
                rows, mean, products = more, centre, own
                continue
            away = centre - mean
            both = rows + more
            products = products + own + np.multiply.outer(away[at], away) * (rows * more / both)
            mean = mean + away * (more / both)
            rows = both
        return rows, mean, products

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = (0.0, np.zeros(size), np.zeros((size, size)))
        part = None
        for batch in batches:
            if batch.num_rows:
                part = batch.column(1)[0]
                matrix = np.asarray(batch.column(0).flatten()).reshape(batch.num_rows, size)
                mean = matrix.mean(axis=0)
                centred = matrix - mean
                state = joined([s for s in (state, (float(batch.num_rows), mean, centred.T @ centred)) if s[0]], slice(None))
        if part is not None:
            rows, mean, products = state
            for at in range(size):
                row = {"at": at, "part": part.as_py(), "rows": int(rows), "mean": mean.tolist(), "products": products[at].tolist()}
                yield pa.RecordBatch.from_pylist([row], schema)

    schema = pa.schema(
        [("at", pa.int32()), ("part", pa.int32()), ("rows", pa.int64()), ("mean", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))]
    )

    def merged(table: pa.Table) -> pa.Table:
        held = sorted(table.to_pylist(), key=lambda row: (row["part"], row["rows"], row["mean"]))
        at = held[0]["at"]
        rows, mean, products = joined([(float(r["rows"]), np.array(r["mean"]), np.array(r["products"])) for r in held], at)
        row = {"at": at, "part": held[0]["part"] % GROUPS, "rows": int(rows), "mean": mean.tolist(), "products": products.tolist()}
        return pa.Table.from_pylist([row], schema)

    named = frame.select(F.transform(vector, lambda x: x.cast("double")).alias("vector"), F.spark_partition_id().alias("part"))
    parts = named.mapInArrow(partial, _SCHEMA)
    some = parts.groupBy("at", F.pmod("part", F.lit(GROUPS)).alias("_group")).applyInArrow(merged, _SCHEMA)
    return some.groupBy("at").applyInArrow(merged, _SCHEMA).select("at", "rows", "mean", "products")


def vector_correlations(frame: DataFrame, vector: str) -> DataFrame:
    """Pearson correlations of all pairs of dimensions as rows ``dim_x, dim_y, corr`` (dimensions from 0).

    One pass over the rows, and a state of the square of the dimensions whatever their number.  Rows
    without a vector, with a null or endless element or of another size than most vectors take no part.  A constant
    dimension has null correlations.  Without rows there is no result.  Finding the size runs a small job.
    """
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    usable = frame.where(F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False)))
    sizes = usable.groupBy(F.size(vector).alias("size")).agg(F.count("*").alias("rows"))
    most = sizes.agg(F.max(F.struct("rows", "size")).alias("most")).first()["most"]
    size = most["size"] if most else 0
    centred = centred_products(usable.where(F.size(vector) == size), vector, size)
    # One number per dimension.
    spreads = centred.agg(F.array_sort(F.collect_list(F.struct("at", F.get("products", F.col("at")).alias("own"))))["own"].alias("own")).scalar()
    spread = centred.withColumn("own", spreads)
    cells = spread.select(F.col("at").alias("dim_x"), "own", F.posexplode("products").alias("dim_y", "product"))
    scale = F.sqrt(F.get("own", F.col("dim_x"))) * F.sqrt(F.get("own", F.col("dim_y")))
    return cells.select("dim_x", "dim_y", F.try_divide(F.col("product"), scale).alias("corr"))
