"""Registering the Parquet tables of a zone in the catalog."""

from __future__ import annotations

import logging
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrace.layout import SNAPSHOT
from terrace.operators.snapshots import RETENTION_DAYS
from terrace.sources.files import listed, qualified, visible
from terrace.sources.versions import LISTS, Version, current

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class FoundTable:
    """A table below a zone: its place relative to the root and the keys of its directories."""

    location: str
    partition_columns: tuple[str, ...]
    version: Version | None = None


def tables_below(spark: SparkSession, zone_root: str) -> list[FoundTable]:
    """Tables below a zone, found by walking its directories level by level.

    A directory is a table if there are Parquet files in it, versions, or partition directories
    with such files; of those only as many are looked at as it takes to find one file.
    """
    found, level = [], [""]
    root = qualified(spark, zone_root)
    while level:
        below = []
        for place in level:
            table, inner = _look(spark, root, place)
            found += [table] if table else []
            below += inner
        level = below
    return found


def _look(spark: SparkSession, root: str, place: str) -> tuple[FoundTable | None, list[str]]:
    """The table a directory is, if it is one, and the directories in it that may hold others."""
    here = f"{root}/{place}".rstrip("/")
    table, inner, keyed = None, [], []
    for status in listed(spark, here):
        name = status.getPath().getName()
        if not status.isDirectory():
            if table is None and visible(name) and name.endswith(".parquet"):
                table = FoundTable(place, ())
        elif name == LISTS:
            version = current(spark, here)
            if version:
                return FoundTable(place, (version.partition,), version), []
        elif "=" in name:
            keyed.append(name)
        elif visible(name):
            inner.append(f"{place}/{name}".lstrip("/"))
    if table is None:
        for name in keyed:
            keys = _keys(spark, f"{here}/{name}")
            if keys is not None:
                return FoundTable(place, (name.split("=", 1)[0], *keys)), inner
    return table, inner


def _keys(spark: SparkSession, directory: str) -> tuple[str, ...] | None:
    """Keys of the partition directories down to the first Parquet file; None without any file."""
    deeper = []
    for status in listed(spark, directory):
        name = status.getPath().getName()
        if not status.isDirectory():
            if visible(name) and name.endswith(".parquet"):
                return ()
        elif "=" in name:
            deeper.append(name)
    for name in deeper:
        keys = _keys(spark, f"{directory}/{name}")
        if keys is not None:
            return (name.split("=", 1)[0], *keys)
    return None


def discover_tables(spark: SparkSession, zone_root: str) -> DataFrame:
    """Tables below a zone: ``location`` relative to it and ``partition_columns``."""
    rows = [(t.location, list(t.partition_columns)) for t in tables_below(spark, zone_root)]
    return spark.createDataFrame(rows, "location string, partition_columns array<string>")


def register_zone(
    spark: SparkSession,
    database: str,
    zone_root: str,
    *,
    merge_schema: bool = False,
    database_location: str | None = None,
) -> list[str]:
    """Create or update one external table per table of the zone; returns their names.

    New partitions and new columns are added in place.  A table whose files have moved or
    changed a column's type is registered anew; its files are not touched.  Two tables
    that would have one name are an error, raised before any is registered.
    Partition columns are STRING, as their directories are.  ``merge_schema``
    looks at the footers of all files for columns that only some of them have.
    The root may be relative and be spelled in any way; locations are those of the file system.
    A table with versions has the partitions of its newest one until it is registered again.
    """
    at = f"LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {at}")
    root = qualified(spark, zone_root)
    found = [t for t in tables_below(spark, root) if t.location]
    leaves = Counter(t.location.rsplit("/", 1)[-1] for t in found)
    named: dict[str, FoundTable] = {}
    for one in sorted(found, key=lambda t: t.location):
        leaf = one.location.rsplit("/", 1)[-1]
        name = leaf if leaves[leaf] == 1 else one.location.replace("/", "_")
        clashes = [t.location for n, t in named.items() if n.lower() == name.lower()]
        if clashes:
            raise ValueError(f"{clashes[0]} and {one.location} would both be {database}.{name}")
        named[name] = one
    for name, one in named.items():
        _register(spark, f"{database}.`{name}`", f"{root}/{one.location}", one, merge_schema)
    names = list(named)
    for known in spark.catalog.listTables(database):
        if not known.isTemporary and known.name not in {n.lower() for n in names}:
            log.warning("%s.%s is not in %s any more", database, known.name, zone_root)
    return names


def create_retained_view(
    spark: SparkSession, view: str, table: str, days: int = RETENTION_DAYS["silver"]
) -> None:
    """A view of the snapshots of ``table`` that are within retention on the day it is read."""
    snapshot = ", ".join(f"CAST({c} AS INT)" for c in SNAPSHOT)
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table} "
        f"WHERE make_date({snapshot}) >= date_sub(current_date(), {int(days)})"
    )


def _register(spark: SparkSession, table: str, path: str, found: FoundTable, merge_schema: bool) -> None:
    keys = list(found.partition_columns)
    if found.version:
        schema = found.version.schema
    else:
        schema = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path).schema
    data = T.StructType([f for f in schema if f.name not in keys])
    if spark.catalog.tableExists(table) and _changed(spark, table, path, data):
        log.info("%s: registered anew at %s", table, path)
        spark.sql(f"DROP TABLE {table}")
    if spark.catalog.tableExists(table):
        known = {c.name.lower() for c in spark.catalog.listColumns(table)}
        added = T.StructType([f for f in data if f.name.lower() not in known])
        if added.fields:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_ddl(added)})")
            log.info("%s: added %s", table, ", ".join(added.names))
    else:
        text = T.StructType([T.StructField(k, T.StringType(), True) for k in keys])
        columns = _ddl(T.StructType(data.fields + text.fields))
        by = f"PARTITIONED BY ({', '.join(f'`{k}`' for k in keys)})" if keys else ""
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{path}'")
    if found.version:
        _point_partitions(spark, table, path, found.version)
    elif keys:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def _point_partitions(spark: SparkSession, table: str, path: str, version: Version) -> None:
    """Give the catalog the partitions of a version, each at the place where the version has it."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    wanted = {d.rsplit("/", 1)[-1]: f"{path}/{d}" for d in version.directories}
    there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}

    def spec(name: str) -> str:
        value = names.unescapePathName(name.split("=", 1)[1])
        quoted = value.replace("\\", "\\\\").replace("'", "\\'")
        literal = "null" if value == names.DEFAULT_PARTITION_NAME() else f"'{quoted}'"
        return f"PARTITION (`{version.partition}` = {literal})"

    for name in sorted(wanted):
        place = wanted[name].replace("'", "\\'")
        if name in there:
            spark.sql(f"ALTER TABLE {table} {spec(name)} SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec(name)} LOCATION '{place}'")
    for name in sorted(there - set(wanted)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {spec(name)}")


def _changed(spark: SparkSession, table: str, path: str, data: T.StructType) -> bool:
    """Whether the table lies elsewhere or has another type for a column than ``data``."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    config = spark.sparkContext._jsc.hadoopConfiguration()
    places = [p.getFileSystem(config).makeQualified(p).toString() for p in map(at, (details["data_type"], path))]
    types = {c.name.lower(): c.dataType for c in spark.catalog.listColumns(table)}
    return places[0] != places[1] or any(
        types.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString() for f in data
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
