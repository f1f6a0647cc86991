"""The largest products of two sets of vectors, for use inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Products held at once, few enough to stay in a processor's cache, and columns of them.
CELLS_AT_ONCE, COLUMNS_AT_ONCE = 1_000_000, 2048
# More than the rounding step that decides ties.
MARGIN = 1e-8


def matrix_of() -> Callable[[pa.Table], np.ndarray]:
    """The function from the column ``vector`` to a matrix.  It is local, so that tasks need not import this package."""

    def matrix(table: pa.Table) -> np.ndarray:
        vectors = table["vector"].combine_chunks()
        sizes = pc.min_max(pc.list_value_length(vectors)).as_py()
        if sizes["min"] != sizes["max"]:
            raise ValueError("vectors of different lengths")
        return np.asarray(vectors.flatten(), "float64").reshape(len(vectors), -1)

    return matrix


def largest_products(count: int) -> Callable[..., Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """The function that finds for each row of ``left`` the ``count`` rows of ``right`` of the largest product, ties by place.

    It yields ``rows, places, value``, best first within a row.  Pairs (``row``, ``column``) given, in order of rows, count as minus
    infinity, as do products that are no numbers.  Where a row is known to have ``count`` products of ``floor`` or more, here or elsewhere,
    lower ones are left out.  Columns come in stretches, longest vectors first: no product is larger than the
    lengths' product, so that a row is done once that of the next stretch stays below its ``count``-th best so far.  The best of each of
    several runs of a stretch are products, and far fewer than all; the ``count``-th best of these is a close floor, so that only runs
    that reach it are looked at.
    """
    cells, most, margin = CELLS_AT_ONCE, COLUMNS_AT_ONCE, MARGIN

    def lengths(vectors: np.ndarray) -> np.ndarray:
        # Rounded up, for products are rounded, too.
        return np.nan_to_num(np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), nan=np.inf, posinf=np.inf) * (1 + 1e-9)

    def largest(left: np.ndarray, right: np.ndarray, row: np.ndarray | None = None, column: np.ndarray | None = None, floor: np.ndarray | None = None) -> Iterator[tuple]:
        columns = len(right)
        kept = min(count, columns)
        sure = bool(np.isfinite(left).all() and np.isfinite(right).all())
        long, wide = lengths(left), lengths(right)
        by_length = np.argsort(-wide, kind="stable")
        wide, turned = wide[by_length], np.ascontiguousarray(right[by_length].T)
        if row is not None and len(row):
            at_length = np.empty(columns, np.int64)
            at_length[by_length] = np.arange(columns)
            column = at_length[column]
        # Of vectors about as long as each other none can be left out by length.
        stretch = columns if wide[-1] > 0.9 * wide[0] else max(most, 4 * kept)
        step = max(1, cells // min(stretch, columns))
        for begin in range(0, len(left), step):
            vectors = left[begin : begin + step]
            open_rows, best = np.arange(len(vectors)), np.full((len(vectors), kept), -np.inf)
            if floor is not None:
                best[:] = floor[begin : begin + step, None]
            if row is not None and len(row):
                at = slice(*np.searchsorted(row, (begin, begin + len(vectors))))
                order = np.argsort(column[at], kind="stable")
                hidden_row, hidden_column = row[at][order] - begin, column[at][order]
            found = []
            for first in range(0, columns, stretch):
                if first or floor is not None:
                    with np.errstate(invalid="ignore"):
                        short = long[begin + open_rows] * wide[first] < best[open_rows].min(axis=1) - margin
                    open_rows = open_rows[~short]
                    if not len(open_rows):
                        break
                products = vectors[open_rows] @ turned[:, first : first + stretch]
                if not sure:
                    products[~np.isfinite(products)] = -np.inf
                if row is not None and len(row):
                    cut = slice(*np.searchsorted(hidden_column, (first, first + stretch)))
                    place = np.full(len(vectors), -1)
                    place[open_rows] = np.arange(len(open_rows))
                    there = place[hidden_row[cut]]
                    products[there[there >= 0], hidden_column[cut][there >= 0] - first] = -np.inf
                width = max(1, min(64, products.shape[1] // kept))
                runs = products.shape[1] // width
                # A run is every ``runs``-th column; what is left over are runs of one.
                tops = products[:, : runs * width].reshape(len(products), width, runs).max(axis=1)
                tops = np.concatenate([tops, products[:, runs * width :]], axis=1)
                best[open_rows] = np.partition(np.concatenate([best[open_rows], tops], axis=1), -kept, axis=1)[:, -kept:]
                lowest = best[open_rows].min(axis=1) - margin
                rows, run = np.nonzero(tops >= lowest[:, None])
                whole = run < runs
                places = np.concatenate([(run[whole][:, None] + runs * np.arange(width)).ravel(), run[~whole] - runs + runs * width])
                rows = np.concatenate([np.repeat(rows[whole], width), rows[~whole]])
                value = products[rows, places]
                high = value >= lowest[rows]
                found.append((open_rows[rows[high]], by_length[first + places[high]], value[high]))
            if not found:
                continue
            rows, places, value = (np.concatenate(parts) for parts in zip(*found, strict=True))
            high = value >= best.min(axis=1)[rows] - margin
            rows, places, value = rows[high], places[high], value[high]
            order = np.lexsort((places, -value.round(9), rows))
            rows, places, value = rows[order], places[order], value[order]
            ahead = np.arange(len(rows)) - np.searchsorted(rows, rows) < kept
            yield rows[ahead] + begin, places[ahead], value[ahead]

    return largest
