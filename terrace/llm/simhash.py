"""SimHash near-dedup by meet-in-the-middle ball hashing.

A text's fingerprint has a bit for each majority among the hashes of its word shingles.
Every fingerprint emits all variants within half the radius; two fingerprints within the
radius share a variant.  Fingerprints that meet at one variant are all within the radius of
each other, so each is linked to the smallest of them only: no link between components
is lost, and a variant with many fingerprints does not make all their pairs.  A variant
has at most as many fingerprints as its ball, whatever the data, as equal fingerprints
are merged before.

Defined results: a null or empty text has the fingerprint zero and links like any other; a
text of fewer words than a shingle is one shingle; repeated rows share a component; a
component without any id has a null id; an empty table gives no rows; other columns are
carried by ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.components import components
from terrace.llm.tables import materialize, ship_library, text_or_empty, whole_rows

BITS = 64
SEED = 42


def shingle_hashes(text: str, shingle: int = 3) -> np.ndarray:
    """XXH64 of the word shingles, repeats included; ``bytes.lower`` and ``split`` know ASCII only."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    digest = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit word whose bits are set in over half of the hashes, as a signed integer."""
    if not len(hashes):
        return 0
    votes = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    word = np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.int64)
    return int(word[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    def batch(texts: pd.Series) -> pd.Series:
        return pd.Series([majority(shingle_hashes(t or "", shingle)) for t in texts], dtype="int64")

    return F.pandas_udf(batch, "long")(text)


def ball(radius: int) -> list[int]:
    """The masks of at most ``radius`` bits, as signed integers."""
    masks = (sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(BITS), n))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``hub, fp``: links that join all distinct fingerprints within ``radius`` bits.

    ``prints`` has distinct ``fp``.  The radius must be even.
    """
    if radius % 2:
        raise ValueError("meeting in the middle takes an even radius")
    masks = F.array(*[F.lit(m) for m in ball(radius // 2)])
    variants = prints.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant")
    )
    hub = F.min("fp").over(Window.partitionBy("variant"))
    met = variants.withColumn("hub", hub).where("hub <> fp")
    return met.where(F.bit_count(F.col("hub").bitwiseXOR(F.col("fp"))) <= radius).select("hub", "fp").distinct()


def near_groups(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``fp, component_id``: each distinct fingerprint with the smallest id reachable from it.

    ``prints`` has ``doc_id, fp`` per row.
    """
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    hung = components(near_links(distinct.select("fp"), radius)).withColumnRenamed("node", "c_fp")
    groups = materialize(
        distinct.join(hung, F.col("fp") == F.col("c_fp"), "left").select(
            "fp", "first_id", F.coalesce("component", "fp").alias("group")
        )
    )
    least = groups.groupBy("group").agg(F.min("first_id").alias("component_id")).withColumnRenamed("group", "g")
    return groups.join(least, F.col("group") == F.col("g")).select("fp", "component_id", "group")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` per row.  Texts are read once, for the fingerprints."""
    ship_library(docs.sparkSession)
    prints = materialize(docs.select("doc_id", fingerprint(text_or_empty("text"), shingle).alias("fp")))
    groups = near_groups(prints, radius).withColumnRenamed("fp", "g_fp")
    return prints.join(groups, F.col("fp") == F.col("g_fp")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One whole row of each group: the one with the smallest id, or any of those that share it.

    Rows get a key when they are written with their fingerprints.  The choice is made among
    keys and ids alone, and whole rows move once, to meet the keys that stay.  Besides the rows
    only links are written.
    """
    ship_library(docs.sparkSession)
    text = text_or_empty("text")
    keyed = materialize(
        docs.select(
            whole_rows(docs), F.col("doc_id").alias("doc_id"), fingerprint(text, shingle).alias("fp"), F.monotonically_increasing_id().alias("key")
        )
    )
    hung = components(near_links(keyed.select("fp").distinct(), radius))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))
    chosen = (
        keyed.select("doc_id", "fp", "key")
        .join(hung, F.col("fp") == F.col("node"), "left")
        .groupBy(F.coalesce("component", "fp").alias("group"))
        .agg(first.alias("kept"))
        .select(F.col("kept.key").alias("kept_key"))
    )
    return keyed.select("row", "key").join(chosen, F.col("key") == F.col("kept_key"), "left_semi").select("row.*")
