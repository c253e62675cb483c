"""Bronze to silver for files that have landed since the last run."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terrace.layout import source_dir, workspace
from terrace.plans.silver import SilverRun, backfill_silver
from terrace.registry import SourceSpec, lookup
from terrace.sources.files import (
    directory_exists,
    files_under,
    listed,
    make_directory,
    read_small,
    remove_directory,
    write_new,
)

_LEDGER = "path string, length bigint, modificationTime timestamp, gone boolean, at bigint"
_SNAPSHOT_PATH = r"/year=(\d+)/month=(\d+)/day=(\d+)/"
#: Entries of the ledger after which it is written anew as one.
ENTRIES = 16
#: Hours after which the claim of a run that did not end is void.
CLAIM_HOURS = 12


class RunInProgress(Exception):
    """Another run has claimed the checkpoint."""


def process_new_snapshots(
    spark: SparkSession,
    source: str | SourceSpec,
    bronze_root: str,
    silver_root: str,
    checkpoint: str,
    processed_at: str | None = None,
    *,
    max_files_per_batch: int | None = None,
    declared: bool = False,
    strict_dates: bool = False,
    claim_hours: float = CLAIM_HOURS,
) -> list[SilverRun]:
    """Bring silver up to date with bronze and stop; one entry per batch with news.

    The files of bronze are compared with those silver was built from, by name, length and
    modification time.  A file that is new, late, written anew under its old name or gone is
    news, however old its time stamp; no content is read for that.  The snapshots of such
    files are cleaned as a whole and replaced, so a late file is deduplicated against the
    earlier ones of its snapshot, and a batch that is run again after a failure leaves the
    same rows.  A snapshot of which no file is left keeps its silver rows, as silver is kept
    longer than bronze.

    ``checkpoint`` remembers the files and must outlive the run; a batch is noted there when
    silver has it.  ``max_files_per_batch`` bounds the files with news in a batch, but a snapshot
    is never cut.  One run at a time holds the claim on a checkpoint; RunInProgress if another
    one does and began less than ``claim_hours`` ago.
    """
    spec = source if isinstance(source, SourceSpec) else lookup(source)
    checkpoint = checkpoint.rstrip("/")
    release = _claim(spark, f"{checkpoint}/claim", claim_hours)
    try:
        ledger = f"{checkpoint}/files"
        noted = _entries(spark, ledger)
        news = _changes(spark, spec, bronze_root, noted)
        entry = 1 + max((int(r[0]) for r in noted.agg(F.max("at")).collect() if r[0] is not None), default=0)
        # One short row per snapshot with news.
        counts = news.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.max("stays").alias("stays")).orderBy("day").collect()
        runs: list[SilverRun] = []
        emptied = [r["day"] for r in counts if not r["stays"]]
        for days in _batches([(r["day"], r["n"]) for r in counts if r["stays"]], max_files_per_batch):
            runs.append(
                backfill_silver(
                    spark,
                    spec,
                    bronze_root,
                    silver_root,
                    processed_at,
                    run_dates=days,
                    declared=declared,
                    strict_dates=strict_dates,
                )
            )
            _note(news.where(F.col("day").isin(days)), ledger, entry)
            entry += 1
        if emptied:
            _note(news.where(F.col("day").isin(emptied)), ledger, entry)
        _compact(spark, ledger)
        return runs
    finally:
        release()


def _entries(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries: those of the newest whole ledger and what was noted since."""
    newest = max((n for n in _wholes(spark, ledger)), default=0)
    paths = [f"{ledger}/{kind}" for kind in (f"whole={newest}", f"since={newest}") if directory_exists(spark, f"{ledger}/{kind}")]
    return spark.read.schema(_LEDGER).parquet(*paths) if paths else spark.createDataFrame([], _LEDGER)


def _wholes(spark: SparkSession, ledger: str) -> list[int]:
    """Numbers of the whole ledgers that are complete."""
    names = [s.getPath().getName() for s in listed(spark, ledger) if s.isDirectory()]
    found = [n for n in names if n.startswith("whole=") and directory_exists(spark, f"{ledger}/{n}/_SUCCESS")]
    return [int(n.split("=")[1]) for n in found]


def _known(entries: DataFrame) -> DataFrame:
    """The files silver was built from: the newest word on each path, unless it says that it is gone."""
    newest = F.max_by(F.struct("length", "modificationTime", "gone"), "at").alias("newest")
    return entries.groupBy("path").agg(newest).select("path", "newest.*").where("NOT gone").drop("gone")


def _changes(spark: SparkSession, spec: SourceSpec, bronze_root: str, entries: DataFrame) -> DataFrame:
    """Files that are new, changed or gone, with the day of their snapshot and whether files of it stay.

    Written down, so that all that follows is about the same files.
    """
    visible = F.col("path").rlike(_SNAPSHOT_PATH) & ~F.col("path").rlike(r"/[._][^/]*$")
    root = source_dir(bronze_root, spec.name)
    files = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    if directory_exists(spark, root):
        files = files_under(spark, root).where(visible)
    known = _known(entries).select("path", F.col("length").alias("k_length"), F.col("modificationTime").alias("k_time"))
    both = files.join(known, "path", "full_outer")
    parts = [F.regexp_extract("path", _SNAPSHOT_PATH, i).cast("int") for i in (1, 2, 3)]
    same = F.col("length").eqNullSafe(F.col("k_length")) & F.col("modificationTime").eqNullSafe(F.col("k_time"))
    there = F.col("length").isNotNull()
    stays = F.max(there).over(Window.partitionBy("day"))
    staged = workspace(spark)
    (
        both.withColumn("day", F.make_date(*parts))
        .withColumn("stays", stays)
        .where(~same)
        .select("path", "length", "modificationTime", (~there).alias("gone"), "day", "stays")
        .write.parquet(staged)
    )
    return spark.read.parquet(staged)


def _note(files: DataFrame, ledger: str, entry: int) -> None:
    newest = max(_wholes(files.sparkSession, ledger), default=0)
    noted = files.drop("day", "stays").withColumn("at", F.lit(entry).cast("long"))
    noted.coalesce(1).write.mode("append").parquet(f"{ledger}/since={newest}")


def _compact(spark: SparkSession, ledger: str) -> None:
    """Write the ledger anew once it has many entries.  It counts when it is complete; the one before goes then."""
    before = max(_wholes(spark, ledger), default=0)
    since = f"{ledger}/since={before}"
    if sum(s.getPath().getName().endswith(".parquet") for s in listed(spark, since)) < ENTRIES:
        return
    entries = _entries(spark, ledger)
    last = entries.agg(F.max("at")).first()[0]
    whole = _known(entries).withColumns({"gone": F.lit(False), "at": F.lit(last).cast("long")})
    whole.write.mode("overwrite").parquet(f"{ledger}/whole={last}")
    for old in (f"whole={before}", f"since={before}"):
        remove_directory(spark, f"{ledger}/{old}")


def _claim(spark: SparkSession, path: str, hours: float) -> Callable[[], None]:
    """Take the claim, or one that is void; what it returns gives it back."""
    now = dt.datetime.now(dt.UTC)
    make_directory(spark, path.rsplit("/", 1)[0])
    mine = json.dumps({"run": uuid.uuid4().hex, "began": now.isoformat()})
    if not write_new(spark, path, mine):
        held = json.loads(read_small(spark, path))
        if now - dt.datetime.fromisoformat(held["began"]) < dt.timedelta(hours=hours):
            raise RunInProgress(f"{path} is held since {held['began']}")
        remove_directory(spark, path)
        if not write_new(spark, path, mine):
            raise RunInProgress(f"{path} was taken by another run")

    def release() -> None:
        if read_small(spark, path) == mine:
            remove_directory(spark, path)

    return release


def _batches(counts: list[tuple[dt.date, int]], limit: int | None) -> Iterator[list[dt.date]]:
    """Days in order, as many to a batch as keep to ``limit`` files, one at least."""
    batch: list[dt.date] = []
    files = 0
    for day, n in counts:
        if batch and limit and files + n > limit:
            yield batch
            batch, files = [], 0
        batch.append(day)
        files += n
    if batch:
        yield batch
