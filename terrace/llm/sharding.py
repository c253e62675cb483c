"""Sharding by weighted rendezvous hashing.

Every shard draws a number for a record's key, and the best draw takes the record.  A
shard's draws do not depend on the others, so one more shard only takes records into
itself.  The choice is a row-wise expression; only numbering the rows of a shard moves
them, and that by ranges, so that no task holds a whole shard.

Defined results: a null text has no bytes; rows with a null key go where the key ``null``
goes; rows that repeat a key share its shard and have slots of their own; an empty table
gives no rows; other columns are carried by ``with_shards``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import positions, text_or_empty, whole_rows

#: Bytes a record takes besides its text.
OVERHEAD = 16


def draw(key: Column, shard: int, weight: float) -> Column:
    """An exponential variable of rate ``weight``; the smallest one wins in proportion."""
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("null")), F.lit(shard)), 12)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 52)) / weight


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard that takes ``key``; the smaller one if two draw the same."""
    draws = [F.struct(draw(key, i, w).alias("draw"), F.lit(i).alias("shard")) for i, w in enumerate(weights) if w > 0]
    return F.array_min(F.array(*draws))["shard"]


def with_shards(docs: DataFrame, weights: Sequence[float], key: str = "doc_id") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``shard``."""
    return docs.select(whole_rows(docs), rendezvous(F.col(f"`{key}`"), weights).alias("shard"))


def plan_shards(docs: DataFrame, weights: Sequence[float], added: float = 1.0) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``slot`` numbers the rows of a shard from 0 by id; ``grown_shard`` is the choice with one
    more shard of weight ``added``.
    """
    text, key = text_or_empty("text"), F.col("doc_id")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, added]).alias("grown_shard"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col(c) for c in ("shard", "doc_id", "text_crc32", "size", "tie")]
    return positions(rows, order, ["shard"]).withColumnRenamed("position", "slot").drop("tie")
