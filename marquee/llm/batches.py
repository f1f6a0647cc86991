"""Small helpers for tasks that work on Arrow batches of whole texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A slice handed to numpy holds about so many bytes of text, or one text if that is longer.
SLICE_BYTES = 1 << 19


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and where each begins (one more entry than texts); null is empty."""
    whole = texts.cast(pa.large_binary()).fill_null(b"")
    if whole.offset:
        whole = pa.concat_arrays([whole])
    _, offsets, data = whole.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts have at most ``most`` bytes together, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        lengths = np.asarray(pc.binary_length(text).fill_null(0), dtype=np.int64)
        ends = np.cumsum(lengths)
        begin = 0
        while begin < batch.num_rows:
            done = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, done + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
