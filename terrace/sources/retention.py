"""Deleting snapshots that are older than a zone keeps them."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from terrace.layout import SNAPSHOT, run_day, source_dir
from terrace.operators.snapshots import RETENTION_DAYS
from terrace.sources.files import listed, remove_directory

log = logging.getLogger(__name__)

KEPT, IN_GRACE, EXPIRED, REMOVED = "kept", "in grace", "expired", "removed"
RESULT = "source string, snapshot date, status string"


@dataclass(frozen=True)
class Snapshot:
    source: str
    day: dt.date
    directory: str


def snapshots(spark: SparkSession, zone_root: str, source: str) -> Iterator[Snapshot]:
    """The snapshot directories of a source, by their names; no file is looked at."""

    def below(directory: str, key: str) -> Iterator[tuple[int, str]]:
        for status in listed(spark, directory):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith(f"{key}=") and name.split("=")[1].isdigit():
                yield int(name.split("=")[1]), f"{directory}/{name}"

    year_key, month_key, day_key = SNAPSHOT
    for year, in_year in below(source_dir(zone_root, source), year_key):
        for month, in_month in below(in_year, month_key):
            for day, directory in below(in_month, day_key):
                try:
                    yield Snapshot(source, dt.date(year, month, day), directory)
                except ValueError:
                    log.warning("%s is not a date", directory)


def expire_snapshots(
    spark: SparkSession,
    zone_root: str,
    sources: Iterable[str],
    as_of: str | dt.date,
    *,
    zone: str | None = None,
    days: int | None = None,
    grace_days: int = 0,
    dry_run: bool = True,
) -> DataFrame:
    """What becomes of every snapshot of ``sources``: ``source, snapshot, status``.

    A snapshot is kept as long as it is no older than ``days`` at ``as_of``, by default those of
    the ``zone``.  For ``grace_days`` more it is ``in grace``, after that ``expired``, and without
    ``dry_run`` it is ``removed``: its directory with all files, and what landing has put aside
    for it.  The age is that of the snapshot's date, as its directory says, not of the files.
    There is a row per snapshot, that is, per past day.
    """
    if days is None:
        if zone not in ("bronze", "silver"):
            raise ValueError("name the days, or a zone with snapshots: bronze or silver")
        days = RETENTION_DAYS[zone]
    first = run_day(as_of) - dt.timedelta(days)
    last = first - dt.timedelta(grace_days)
    rows = []
    for source in sources:
        for place in (source, f"_rejected/{source}"):
            for one in snapshots(spark, zone_root, place):
                status = KEPT if one.day >= first else IN_GRACE if one.day >= last else EXPIRED
                if status == EXPIRED and not dry_run:
                    remove_directory(spark, one.directory)
                    log.info("removed %s", one.directory)
                    status = REMOVED
                if place == source:
                    rows.append((source, one.day, status))
    return spark.createDataFrame(rows, RESULT)
