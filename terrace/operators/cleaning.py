"""Raw rows to silver rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import iso_date, silver_names, tolerant_cast
from terrace.registry import SourceSpec


def normalize_columns(df: DataFrame) -> DataFrame:
    """Every column under its silver name, in one projection."""
    return df.toDF(*silver_names(df.columns))


def cast_schema(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Cast the columns named in ``types``; other columns stay, absent ones are not added."""
    casts = {
        f.name: tolerant_cast(F.col(f"`{f.name}`"), f.dataType, types[f.name])
        for f in df.schema
        if f.name in types and f.dataType != types[f.name]
    }
    return df.withColumns(casts) if casts else df


def drop_undated(df: DataFrame, date_column: str, *, strict: bool = False) -> DataFrame:
    """Drop rows without a date; nothing happens if the column is absent.

    ``strict`` also drops texts that are not an ISO date.  Without it they stay
    and end up in the NULL-date group of the gold tables.
    """
    if date_column not in df.columns:
        return df
    date = F.col(date_column)
    if strict and isinstance(df.schema[date_column].dataType, T.StringType):
        date = iso_date(date)
    return df.where(date.isNotNull())


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; NULLs are equal to each other.

    Copies are merged in the scanning task before the shuffle, and the shuffle
    hashes the whole row, so a heavily copied row cannot load up one task.
    Snapshot columns, if present, keep this within a snapshot.
    """
    return df.dropDuplicates()


def add_metadata(
    df: DataFrame,
    source: str,
    run_date: str | dt.date | Column,
    processed_at: str,
) -> DataFrame:
    """Append lineage: ingestion DATE, source id, and the ISO time of processing."""
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return df.withColumns(
        {
            "_ingestion_date": day.cast("date"),
            "_source": F.lit(source),
            "_processed_at": F.lit(processed_at),
        }
    )


def clean(
    raw: DataFrame,
    spec: SourceSpec,
    run_date: str | dt.date | Column,
    processed_at: str,
    *,
    strict_dates: bool = False,
) -> DataFrame:
    """The whole way from raw to silver rows: rename, cast, drop, dedupe, add lineage.

    The only shuffle is the one of ``distinct_rows``.
    """
    named = normalize_columns(raw)
    typed = cast_schema(named, spec.silver_types)
    dated = drop_undated(typed, spec.date_column, strict=strict_dates)
    return add_metadata(distinct_rows(dated), spec.name, run_date, processed_at)
