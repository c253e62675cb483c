"""Writing and reading gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.sources.files import remove_directory, remove_other_partitions
from terrace.sources.metrics import counted, written_rows
from terrace.sources.versions import Version, current, publish, read_version, stage


def gold_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_gold(
    df: DataFrame,
    root: str,
    table: str,
    *,
    partition: str = "region",
    replace: str = "table",
    sort_by: Sequence[str] = (),
    versioned: bool | None = None,
) -> int:
    """Write a gold table by region as Snappy Parquet and return its row count.

    What was there stays until the job has succeeded: regions are replaced at its end, and
    with ``replace="table"`` those without rows are removed after it.  With ``versioned`` the
    table is replaced in one step instead, so that a reader sees all old rows or all new ones, see
    ``terrace.sources.versions``; by default that is done for tables that have versions.

    ``replace="table"`` replaces the whole table; ``"regions"`` only the regions
    present in ``df``.  NULL and empty regions share the default partition and
    both read back as NULL.

    The rebalance hint makes one file per region out of small ones and several
    out of a region that holds much of the table.  Sorted by ``sort_by``, usually
    the date, row groups can be skipped by reports on a range of it.
    """
    spark, path = df.sparkSession, gold_path(root, table)
    if versioned or (versioned is None and current(spark, path)):
        return stage_gold(df, root, table, partition=partition, replace=replace, sort_by=sort_by).publish()
    _check(replace)
    regions = F.collect_set(F.coalesce(F.col(partition).cast("string"), F.lit("")))
    out, written = counted(_laid_out(df, partition, sort_by), "gold rows written", regions=regions)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(path)
    )
    found = written()
    if replace == "table":
        kept = {region or None for region in found["regions"]}
        remove_other_partitions(spark, path, partition, kept)
    return found["rows"]


def _check(replace: str) -> None:
    if replace not in ("table", "regions"):
        raise ValueError(f"replace the table or the regions, not {replace!r}")


def _laid_out(df: DataFrame, partition: str, sort_by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *sort_by)


@dataclass(frozen=True)
class StagedTable:
    """Rows that are written and become the table with ``publish``, or are dropped."""

    spark: SparkSession
    path: str
    directory: str
    schema: T.StructType
    partition: str
    whole: bool
    since: Version | None

    def publish(self) -> int:
        rows = written_rows(self.spark, f"{self.path}/{self.directory}")
        publish(self.spark, self.path, self.directory, self.schema, self.partition, self.since, whole=self.whole)
        return rows

    def drop(self) -> None:
        remove_directory(self.spark, f"{self.path}/{self.directory}")


def stage_gold(
    df: DataFrame, root: str, table: str, *, partition: str = "region", replace: str = "table", sort_by: Sequence[str] = ()
) -> StagedTable:
    """Write a gold table without making it visible; arguments as for ``write_gold``.

    Rows are counted by the footers of the files, so tasks that ran twice do not count twice.
    """
    _check(replace)
    spark, path = df.sparkSession, gold_path(root, table)
    since = current(spark, path)
    fields = [f for f in df.schema if f.name != partition]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(partition, T.StringType())])
    directory = stage(_laid_out(df, partition, sort_by), path, partition)
    return StagedTable(spark, path, directory, schema, partition, replace == "table", since)


def read_gold(spark: SparkSession, root: str, table: str, *, partition: str = "region") -> DataFrame:
    """A gold table; regions are text whatever they look like.

    A directory without versions, as other programs write it, is read as it is.
    """
    path = gold_path(root, table)
    version = current(spark, path)
    if version:
        return read_version(spark, path, version)
    found = spark.read.parquet(path).schema
    text = [T.StructField(f.name, T.StringType()) if f.name == partition else f for f in found]
    return spark.read.schema(T.StructType(text)).parquet(path)
