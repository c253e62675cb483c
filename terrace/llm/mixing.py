"""Mixing sources to target weights.

Tokens are summed per source, each source gets a target, and the ratio of the two is
its repetition rate.  A document is emitted floor(rate) times, plus one copy whose
seeded hash falls below the fraction.  DataFrame functions throughout.

Defined results: a null or empty text has size 0; a null source is a source of its own,
ordered last; rows that share an id, or have none, are drawn by the digests of their texts, and
equal ones by their number among themselves, so each is drawn on its own; an empty table
gives an empty mix; other columns are carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import NON_SPACE, materialize, positions, text_or_empty, unit_interval, whole_rows


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(NON_SPACE)).cast("long")


def draw_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """What a row is drawn by, besides its number among equal rows: its id and the digest of its text."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(text_or_empty(text)))


def numbered(docs: DataFrame, key: Column) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``key``, made to differ between rows of the same key.

    Keys are counted first.  Only if some are shared are rows put in order to number them, by
    ranges, so that no task takes all rows of a key.
    """
    rows = docs.select(whole_rows(docs), key.alias("key"))
    if rows.groupBy("key").count().where("count > 1").isEmpty():
        return rows.select("row", F.concat("key", F.lit(":0")).alias("key"))
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    placed = positions(tied, [F.col("key"), F.col("tie")], ["key"])
    return placed.select("row", F.concat_ws(":", "key", F.col("position").cast("string")).alias("key"))


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """One row per source: ``source, source_size, weight, target, rate``.

    ``sized`` has ``source`` and ``size``.  Sources in code point order, null last, take the
    weights in turn and share ``share`` times all sizes.  A source stops at ``most`` times
    its size, and what it cannot take is shared by weight among the others: targets are
    ``min(most * size, level * weight)``, and the level rises until it stands.  Each round is
    one aggregate over the sources, and only its two sums come to the driver.
    """
    totals = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    placed = positions(totals, [F.col("source").asc_nulls_last()], [])
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    sources = materialize(placed.select("source", "source_size", turn.alias("weight")))

    def rest(level: float) -> tuple[int, float, float]:
        full = F.col("source_size") * most < F.col("weight") * level
        row = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, F.col("source_size"))), F.lit(0)).alias("stopped"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        return row["all"], row["stopped"], row["open"]

    level, seen = 0.0, None
    while seen != (state := rest(level)):
        seen = state
        size, stopped, weight = state
        if weight == 0:
            break
        level = (share * size - most * stopped) / weight
    target = F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(level))
    return sources.withColumn("target", target).withColumn(
        "rate",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0),
    )


def copies(docs: DataFrame, targets: DataFrame, key: Column, seed: str = "mix") -> DataFrame:
    """``row`` (all columns of ``docs``), ``source_size``, ``target`` and ``copies``.

    Only the source joins, one row per source; the planner broadcasts that side if it is
    small and splits hot sources if it is not.
    """
    drawn = numbered(docs, key).select(
        "row", F.col("row.source").alias("of"), unit_interval(F.concat(F.lit(f"{seed}:"), F.col("key"))).alias("u")
    )
    times = F.floor("rate") + (F.col("u") < F.col("rate") - F.floor("rate")).cast("long")
    return drawn.join(targets, F.col("of").eqNullSafe(F.col("source"))).select(
        "row", "source_size", "target", times.cast("long").alias("copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixed.select(
        "row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("one")
    ).select("row.*")
