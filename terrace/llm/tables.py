"""Helpers the operators share: intermediate tables, text of null rows, ASCII lower case."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.layout import ship_library, workspace

__all__ = ["ship_library"]

#: Runs of characters between ASCII white space.
NON_SPACE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage, survives lost executors and gives the planner a true size,
    by which it alone decides whether a side is small enough to be broadcast.
    """
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone.  ``lower`` does it for texts without other capital letters."""
    others = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"
    mapped = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(text.rlike(others), mapped).otherwise(F.lower(text))


def unit_interval(key: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the key's MD5 digest."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def whole_rows(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that added columns cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def positions(df: DataFrame, order: list[Column], within: list[str]) -> DataFrame:
    """Number the rows from 0 in ``order``, within each combination of ``within``.

    ``order`` must begin with the ``within`` columns.  Rows are range-partitioned and numbered
    inside each partition; only one row per partition and combination meets in a window, so
    no task holds a whole combination.  Adds ``position``.
    """
    names = [f"within_{i}" for i in range(len(within))]
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            whole_rows(df),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
        )
    ).withColumns({n: F.col("row")[w] for n, w in zip(names, within)})
    pieces = placed.groupBy("part", *names).agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place")
    )
    earlier = (
        Window.partitionBy(*names or [F.lit(0)])
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = pieces.withColumn(
        "before", F.coalesce(F.sum("n").over(earlier), F.lit(0))
    ).select(F.col("part").alias("at_part"), *[F.col(n).alias(f"at_{n}") for n in names], "before", "first_place")
    same = F.col("part") == F.col("at_part")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"at_{n}"))
    return placed.join(offsets, same).select(
        "row.*", (F.col("place") - F.col("first_place") + F.col("before")).alias("position")
    )


def uniform_draw(*values: str | Column) -> Column:
    """A number in [0, 1) by a 64-bit hash of the values."""
    return F.shiftrightunsigned(F.xxhash64(*values), 11) / F.lit(float(1 << 53))


#: Elements that are taken together in a running total.
TOGETHER = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` names it in a lambda."""
    return F.transform(F.array(value), body)[0]


def running(
    parts: Column,
    zero: Column,
    combine: Callable[[Column, Column], Column],
    each: Callable[[Column, Column], Column],
    kind: str,
) -> Column:
    """``each(total, part)`` for every part, ``total`` being what ``combine`` makes of those before it.

    ``kind`` is the type of an element of the result.  Arrays are appended to within groups of
    ``TOGETHER`` parts and once per group, so the time grows with the parts and hardly with their square.
    """
    none = F.array().cast(f"array<{kind}>")

    def groups(all_parts: Column) -> Column:
        last = F.floor((F.size(all_parts) - 1) / TOGETHER).cast("int")
        numbers = F.when(F.size(all_parts) > 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda g: F.slice(all_parts, g * TOGETHER + 1, TOGETHER))

    def totals(grouped: Column) -> Column:
        ahead = F.aggregate(
            grouped,
            F.struct(zero.alias("at"), F.array(zero).alias("all")),
            lambda acc, g: let(
                F.aggregate(g, acc["at"], combine),
                lambda at: F.struct(at.alias("at"), F.concat(acc["all"], F.array(at)).alias("all")),
            ),
        )
        return ahead["all"]

    def within(at: Column, group: Column) -> Column:
        start = F.struct(at.alias("at"), none.alias("out"))
        return F.aggregate(
            group,
            start,
            lambda acc, x: F.struct(
                combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(each(acc["at"], x))).alias("out")
            ),
        )["out"]

    def results(grouped: Column) -> Column:
        return let(totals(grouped), lambda t: F.flatten(F.transform(grouped, lambda g, i: within(F.get(t, i), g))))

    return let(parts, lambda p: let(groups(p), results))


def merged_spans(spans: Column, touching: bool) -> Column:
    """Sorted ``start, end`` spans as disjoint ones: those that overlap, or also touch, are one."""
    kind = "struct<start:int,end:int,before:int>"
    marked = running(
        spans,
        F.lit(-1),
        lambda at, s: F.greatest(at, s["end"]),
        lambda at, s: F.struct(s["start"].alias("start"), s["end"].alias("end"), at.alias("before")),
        kind,
    )

    def joined(all_spans: Column) -> Column:
        def first(s: Column) -> Column:
            return (s["before"] < s["start"]) if touching else (s["before"] <= s["start"])

        most = F.array_max(F.transform(all_spans, lambda s: s["end"]))
        return let(
            F.filter(all_spans, first),
            lambda starts: F.transform(
                starts,
                lambda s, i: F.struct(
                    s["start"].alias("start"), F.coalesce(F.get(starts, i + 1)["before"], most).alias("end")
                ),
            ),
        )

    return let(marked, joined)
