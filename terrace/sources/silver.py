"""Writing and reading the silver zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import SNAPSHOT, run_day, snapshot_date, snapshot_dir, snapshot_keys, source_dir
from terrace.sources.files import replace_snapshots, snapshots_newest_first
from terrace.sources.metrics import counted, written_rows


def write_silver(df: DataFrame, root: str, source: str, run_date: str | dt.date) -> int:
    """Replace one snapshot with ``df`` as Snappy Parquet and return its row count.

    Only the directory of the run date is replaced, and only when the job has succeeded: a
    rerun leaves the same rows, a failed one the old rows.  The count is that of the files'
    footers, so a task that ran twice does not count twice.
    """
    rows, written = write_silver_snapshots(
        df.drop(*SNAPSHOT).withColumns(snapshot_keys(F.lit(run_day(run_date)))), root, source
    )
    empty_silver(df, root, source, {run_day(run_date)} - written)
    return rows


def write_silver_snapshots(
    df: DataFrame, root: str, source: str
) -> tuple[int, set[dt.date]]:
    """Replace every snapshot present in ``df``, which has the snapshot columns, in one job.

    Returns the number of rows and the snapshots they are in.

    Cleaned rows lie spread over all tasks, and each task writes a file per snapshot it
    holds rows of.  The rebalance gathers a snapshot in few files, and adaptive execution
    cuts a hot one into several tasks.
    """
    padded = df.withColumns(
        {
            "year": F.lpad(F.col("year").cast("string"), 4, "0"),
            "month": F.lpad(F.col("month").cast("string"), 2, "0"),
            "day": F.lpad(F.col("day").cast("string"), 2, "0"),
        }
    )
    out, written = counted(
        padded.hint("rebalance", *SNAPSHOT), "silver rows written", days=F.collect_set(snapshot_date())
    )
    replace_snapshots(out.write.option("compression", "snappy")).parquet(source_dir(root, source))
    days = set(written()["days"])
    rows = written_rows(df.sparkSession, *[snapshot_dir(root, source, d) for d in sorted(days)]) if days else 0
    return rows, days


def empty_silver(df: DataFrame, root: str, source: str, days: set[dt.date]) -> None:
    """Leave snapshots without rows for ``days``: those silver has rows of, and the first ever."""
    spark = df.sparkSession
    if not days:
        return
    there = set(snapshots_newest_first(spark, source_dir(root, source), ".parquet"))
    for day in days & there if there else days:
        none = spark.createDataFrame([], df.drop(*SNAPSHOT).schema)
        none.write.mode("overwrite").parquet(snapshot_dir(root, source, day))


def read_silver(
    spark: SparkSession,
    root: str,
    source: str,
    snapshot: str | dt.date = "latest",
    *,
    merge_schema: bool | None = None,
) -> DataFrame:
    """Silver rows of the newest snapshot, of ``"all"``, or of one run date.

    Each snapshot is a full download, so adding up ``"all"`` counts a day once
    per download.  A single snapshot is read from its own directory, and the
    others are not even listed.  ``merge_schema`` is for snapshots that differ
    in their columns; by default it is on for ``"all"`` and off for a single snapshot.
    """
    base = source_dir(root, source)
    merge_schema = snapshot == "all" if merge_schema is None else merge_schema
    reader = spark.read.option("basePath", base).option("mergeSchema", str(merge_schema).lower())
    if snapshot == "latest":
        snapshot = next(snapshots_newest_first(spark, base, ".parquet"), "all")
    return reader.parquet(base if snapshot == "all" else snapshot_dir(root, source, snapshot))
