"""Weighted rendezvous hashing: every record goes to the shard that scores best for its key.

A shard's score depends on the key and on that shard alone.  So a new shard takes rows
only into itself, a shard that goes gives its rows to the others, and shards get
rows in proportion to their weights.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.numbering import numbered

#: Values of the 52 bits of a hash that are used.
STEPS = float(1 << 52)


def score(key: Column, shard: int, weight: float) -> Column:
    """Smallest wins: the waiting time of an exponential clock that runs at ``weight``."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12) + F.lit(0.5)) / F.lit(STEPS)
    return -F.log(uniform) / F.lit(float(weight))


def best_shard(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key; equal scores go to the smaller shard number."""
    if not weights or any(w <= 0 for w in weights.values()):
        raise ValueError("at least one shard is needed, and every weight must be above zero")
    scored = [F.struct(score(key, s, w).alias("score"), F.lit(s).alias("shard")) for s, w in sorted(weights.items())]
    return F.array_min(F.array(*scored))["shard"]


def assign_shards(
    docs: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: the id, ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard``.

    ``size`` is the UTF-8 bytes of the text plus 16, ``slot`` the place in the shard, from 0
    without gaps.  ``grown`` is another set of shards, to see which rows would move; without it
    ``grown_shard`` is null.  A null text has no bytes and checksum 0.  A null key is a key like
    any other; rows with equal keys share a shard.  Other columns are left out.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    # A null key still hashes, by the shard alone, so its rows have a place too.
    key = F.col(id_column)
    placed = docs.select(
        key.alias("key"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        best_shard(key, weights).alias("shard"),
        (best_shard(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
    )
    slots = numbered(placed, "shard", ["key", "size", "text_crc32"], "slot")
    return slots.select(
        F.col("key").alias(id_column), "size", "text_crc32", "shard", F.col("slot").cast("long"), "grown_shard"
    )
