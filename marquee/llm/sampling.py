"""A bounded sample that costs the same however many rows there are to choose from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def hashed_sample(frame: DataFrame, key: list[str], count: int) -> DataFrame:
    """At most ``count`` rows, chosen by a hash of ``key``: the same on every run.

    The number of rows tells below which hash about twice as many lie; only those are put in
    order, so no task sends more than its share of them.  An empty frame gives an empty sample.
    """
    below = min(_STEPS, 1 + 2 * count * _STEPS // max(1, frame.count()))
    hashed = F.xxhash64(*key)
    return frame.where(F.pmod(hashed, F.lit(_STEPS)) < below).orderBy(hashed, *key).limit(count)
