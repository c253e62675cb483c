"""Grouped totals by day and the series computed over them.

The series functions expect at most one row per (keys, date), which is what
``daily_totals`` returns.  A window task then holds no more rows than there are
dates, however many raw rows a hot key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import iso_date


def daily_totals(
    df: DataFrame,
    date: str,
    keys: Sequence[str],
    *,
    sums: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
    parse_groups: bool = False,
) -> DataFrame:
    """Sums and maxima by date and ``keys``; mappings go from result to input column.

    ``date`` may be a DATE or ISO text.  Text is parsed to DATE in one of two
    ways, with the same rows as result: row by row ahead of the only shuffle, or,
    with ``parse_groups``, once per group.  In that case rows are grouped by the
    text first and the groups again by the date, which is worth its extra shuffle
    if many rows share a group.  Both groupings merge within a task before they
    shuffle, so texts that are no dates, however many and different, come
    together in the NULL group without meeting in one task.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    first = _measures(sums, maxima)
    if not isinstance(df.schema[date].dataType, T.StringType):
        return df.groupBy(date, *keys).agg(*first)
    if not parse_groups:
        return df.withColumn(date, iso_date(F.col(date))).groupBy(date, *keys).agg(*first)
    again = _measures({a: a for a in sums}, {a: a for a in maxima})
    return (
        df.groupBy(date, *keys)
        .agg(*first)
        .withColumn(date, iso_date(F.col(date)))
        .groupBy(date, *keys)
        .agg(*again)
    )


def _measures(sums: Mapping[str, str], maxima: Mapping[str, str]) -> list[Column]:
    return [F.sum(c).alias(a) for a, c in sums.items()] + [
        F.max(c).alias(a) for a, c in maxima.items()
    ]


def rolling_mean_rows(
    df: DataFrame, value: str, into: str, *, by: Sequence[str], date: str, rows: int = 7
) -> DataFrame:
    """Mean of the last ``rows`` rows of the series, this one included.

    Gaps in the dates widen the span; NULL values are skipped.
    """
    frame = W.partitionBy(*by).orderBy(date).rowsBetween(1 - rows, W.currentRow)
    return df.withColumn(into, F.avg(value).over(frame))


def rolling_mean_days(
    df: DataFrame, value: str, into: str, *, by: Sequence[str], date: str, days: int = 7
) -> DataFrame:
    """Mean over the last ``days`` calendar days, this one included."""
    frame = (
        W.partitionBy(*by).orderBy(F.unix_date(date)).rangeBetween(1 - days, W.currentRow)
    )
    return df.withColumn(into, F.avg(value).over(frame))


def running_total(
    df: DataFrame, value: str, into: str, *, by: Sequence[str], date: str
) -> DataFrame:
    """Sum from the first row of the series up to this one."""
    frame = (
        W.partitionBy(*by).orderBy(date).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return df.withColumn(into, F.sum(value).over(frame))
