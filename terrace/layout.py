"""Where things lie: zone paths, snapshot directories, scratch space."""

from __future__ import annotations

import datetime as dt
import shutil
import tempfile
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Partition columns of a snapshot, outermost first.
SNAPSHOT = ("year", "month", "day")


def run_day(run_date: str | dt.date) -> dt.date:
    return run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(run_date)


def run_days(run_dates: str | dt.date | Iterable[str | dt.date]) -> list[dt.date]:
    """One run date or several as dates."""
    if isinstance(run_dates, (str, dt.date)):
        run_dates = [run_dates]
    return [run_day(d) for d in run_dates]


def utc_now() -> str:
    """The time in UTC as ISO text, for the processing columns."""
    return dt.datetime.now(dt.UTC).replace(tzinfo=None).isoformat()


def source_dir(root: str, source: str) -> str:
    return f"{root.rstrip('/')}/{source}"


def snapshot_dir(root: str, source: str, run_date: str | dt.date) -> str:
    """``<root>/<source>/year=YYYY/month=MM/day=DD``, zero-padded."""
    return f"{source_dir(root, source)}/{run_day(run_date):year=%Y/month=%m/day=%d}"


def snapshot_keys(day: Column) -> dict[str, Column]:
    """Partition columns for a DATE column, zero-padded like ``snapshot_dir``."""
    return {
        "year": F.date_format(day, "yyyy"),
        "month": F.date_format(day, "MM"),
        "day": F.date_format(day, "dd"),
    }


def snapshot_date() -> Column:
    """The DATE of a row read back from a snapshot-partitioned directory."""
    return F.make_date(*(F.col(c).cast("int") for c in SNAPSHOT))


def workspace(spark: SparkSession) -> str:
    """A new directory in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="terrace-")
    return f"{shared.rstrip('/')}/terrace/{context.applicationId}/{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Let executors import this library even if it is installed on the driver alone."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        home = Path(tempfile.mkdtemp(prefix="terrace-library-"))
        shutil.copytree(package, home / "zip" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(home / package.name), "zip", home / "zip"))
        _SHIPPED.add(context.applicationId)
