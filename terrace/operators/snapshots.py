"""Choosing and retiring whole snapshots by their partition columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import days_before
from terrace.functions.dates import AsOf
from terrace.layout import SNAPSHOT, snapshot_date

# Days each zone is kept.  Gold has no snapshots: its tables are built from the newest
# silver snapshot and replaced as a whole, so nothing in them is older than the last build.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "gold": 365}


def latest_only(df: DataFrame) -> DataFrame:
    """Rows of the newest snapshot in ``df``.

    The newest date comes from a scalar subquery over the snapshot columns alone.
    On a partitioned scan it is known before the scan starts and prunes
    partitions.  ``terrace.sources.silver.read_silver`` does the same for a
    directory without looking into any file.
    """
    newest = df.select(F.max(snapshot_date())).scalar()
    return df.where(snapshot_date() == newest)


def _table_snapshots(spark: SparkSession, table: str) -> DataFrame:
    """The snapshots of a catalog table by the names of its partitions, as text."""
    return spark.sql(f"SHOW PARTITIONS {table}").select(
        *(F.regexp_extract("partition", rf"{c}=(\d+)", 1).alias(c) for c in SNAPSHOT)
    ).where("year <> '' AND month <> '' AND day <> ''")


def latest_of_table(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the newest snapshot of a catalog table that declares its snapshot columns as STRING.

    The newest one is the greatest of the catalog's partitions, so the table is scanned once, with a
    filter on them, and nothing is read to find it.
    """
    newest = _table_snapshots(spark, table).agg(F.max_by(F.struct(*SNAPSHOT), snapshot_date()).alias("at")).first()["at"]
    rows = spark.table(table)
    if newest is None:
        return rows.where(F.lit(False))
    return rows.where(reduce(Column.__and__, [F.col(c) == newest[c] for c in SNAPSHOT]))


def within_retention(as_of: AsOf, days: int) -> Column:
    """True for snapshots no older than ``days`` at ``as_of``."""
    return snapshot_date() >= days_before(as_of, days)


def keep_recent(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Rows within retention.  Only partition columns are tested, so the rest is not read."""
    return df.where(within_retention(as_of, days))


def expired_snapshots(df: DataFrame, as_of: AsOf, days: int) -> DataFrame:
    """Snapshots that retention would remove, one row each."""
    return df.where(~within_retention(as_of, days)).select(*SNAPSHOT).distinct()


def drop_expired_partitions(spark: SparkSession, table: str, as_of: AsOf, days: int) -> int:
    """Take expired snapshots out of a catalog table and say how many there were.

    The table must declare its snapshot columns as STRING, as ``register_zone``
    does.  For external tables this changes the catalog only; no file is deleted.
    Works on partition names from the catalog, never on data.
    """
    # One short row per expired snapshot, that is, per past day.
    expired = _table_snapshots(spark, table).where(~within_retention(as_of, days)).collect()
    if expired:
        specs = ", ".join(
            "PARTITION (" + ", ".join(f"{c}='{row[c]}'" for c in SNAPSHOT) + ")"
            for row in expired
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return len(expired)
