"""Bronze snapshots to silver snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession

from terrace.layout import SNAPSHOT, run_days, snapshot_date, source_dir, utc_now
from terrace.operators.cleaning import clean
from terrace.registry import SourceSpec, lookup
from terrace.sources.bronze import read_bronze
from terrace.sources.files import snapshots_newest_first
from terrace.sources.metrics import counted
from terrace.sources.silver import empty_silver, write_silver, write_silver_snapshots


@dataclass(frozen=True)
class SilverRun:
    source: str
    rows_read: int
    rows_written: int


def _spec(source: str | SourceSpec) -> SourceSpec:
    return source if isinstance(source, SourceSpec) else lookup(source)


def build_silver(
    spark: SparkSession,
    source: str | SourceSpec,
    run_date: str | dt.date,
    bronze_root: str,
    silver_root: str,
    processed_at: str | None = None,
    *,
    declared: bool = False,
    strict_dates: bool = False,
) -> SilverRun:
    """Clean one snapshot and write it.  Both counts come from the write job.

    For JSON without ``declared`` the files are parsed into a staged table before, which tells
    their field names; no file is read twice.
    """
    spec = _spec(source)
    raw = read_bronze(spark, spec, bronze_root, run_date, declared=declared).drop(*SNAPSHOT)
    raw, read = counted(raw, "bronze rows read")
    silver = clean(raw, spec, run_date, processed_at or utc_now(), strict_dates=strict_dates)
    rows_written = write_silver(silver, silver_root, spec.name, run_date)
    return SilverRun(spec.name, read()["rows"], rows_written)


def backfill_silver(
    spark: SparkSession,
    source: str | SourceSpec,
    bronze_root: str,
    silver_root: str,
    processed_at: str | None = None,
    *,
    run_dates: str | dt.date | Sequence[str | dt.date] | None = None,
    declared: bool = False,
    strict_dates: bool = False,
) -> SilverRun:
    """Clean many snapshots in one job: those of ``run_dates``, or all.

    Rows are deduplicated within their snapshot, and each snapshot is replaced as
    a whole, also if no row of it is left.
    """
    spec = _spec(source)
    days = None if run_dates is None else run_days(run_dates)
    raw = read_bronze(spark, spec, bronze_root, days, declared=declared)
    raw, read = counted(raw, "bronze rows read")
    silver = clean(
        raw, spec, snapshot_date(), processed_at or utc_now(), strict_dates=strict_dates
    )
    rows_written, written = write_silver_snapshots(silver, silver_root, spec.name)
    if days is None:
        days = snapshots_newest_first(spark, source_dir(bronze_root, spec.name))
    empty_silver(silver, silver_root, spec.name, set(days) - written)
    return SilverRun(spec.name, read()["rows"], rows_written)
