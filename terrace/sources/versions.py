"""Tables that are replaced in one step.

A version of a table is a list of partition directories, kept with the schema in a small file under
``<table>/_versions``.  Data are written first, into ``<table>/version=<name>``, where no reader
looks; the new list then makes them the table, by a rename that fails if somebody else was
faster.  Readers take the newest list, so they see the old table or the new one, and a run that
dies in between leaves the old one and some files nobody reads.  The version before the newest
stays for readers that have begun; what only older ones hold is deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from terrace.sources.files import file_system, listed, read_small, remove_directory, write_new

LISTS = "_versions"
#: The column of the version directories.
VERSION = "version"


class TableChanged(Exception):
    """Another run has replaced the table since this one looked at it."""


@dataclass(frozen=True)
class Version:
    """``directories`` are relative to the table, ``schema`` is that of its rows."""

    number: int
    schema: T.StructType
    directories: tuple[str, ...]
    partition: str


def _list_path(table: str, number: int) -> str:
    return f"{table.rstrip('/')}/{LISTS}/{number:010d}.json"


def _numbers(spark: SparkSession, table: str) -> list[int]:
    names = (s.getPath().getName() for s in listed(spark, f"{table.rstrip('/')}/{LISTS}"))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read(spark: SparkSession, table: str, number: int) -> Version:
    found = json.loads(read_small(spark, _list_path(table, number)))
    return Version(number, T.StructType.fromJson(found["schema"]), tuple(found["directories"]), found["partition"])


def current(spark: SparkSession, table: str) -> Version | None:
    """The newest version; None if the table has none."""
    numbers = _numbers(spark, table)
    return _read(spark, table, numbers[-1]) if numbers else None


def stage(df: DataFrame, table: str, partition: str) -> str:
    """Write ``df`` where no reader looks; the name of its directory."""
    name = f"{VERSION}={uuid.uuid4().hex}"
    df.write.option("compression", "snappy").partitionBy(partition).parquet(f"{table.rstrip('/')}/{name}")
    return name


def publish(
    spark: SparkSession, table: str, staged: str, schema: T.StructType, partition: str, since: Version | None, *, whole: bool = True
) -> Version:
    """Make what was staged the table, or with ``whole=False`` the partitions it has, and say what the table is now.

    ``since`` is the version this run has looked at; TableChanged if it is not the newest any more.
    """
    table = table.rstrip("/")
    written = [s.getPath().getName() for s in listed(spark, f"{table}/{staged}") if s.isDirectory()]
    fresh = {n: f"{staged}/{n}" for n in written if n.startswith(f"{partition}=")}
    kept = {} if whole or since is None else {d.rsplit("/", 1)[-1]: d for d in since.directories}
    if kept:
        known = {f.name for f in schema}
        schema = T.StructType(schema.fields + [f for f in since.schema if f.name not in known])
    number = since.number + 1 if since else 1
    directories = sorted((kept | fresh).values())
    content = {"schema": schema.jsonValue(), "directories": directories, "partition": partition}
    if not write_new(spark, _list_path(table, number), json.dumps(content, indent=1)):
        remove_directory(spark, f"{table}/{staged}")
        raise TableChanged(f"{table} has a version {number} already")
    _forget(spark, table, number)
    return Version(number, schema, tuple(directories), partition)


def _forget(spark: SparkSession, table: str, newest: int) -> None:
    """Delete the lists before the last two, and the directories that are only in them."""
    numbers = _numbers(spark, table)
    old = [n for n in numbers if n < newest - 1]
    held = {d for n in numbers if n not in old for d in _read(spark, table, n).directories}
    for number in old:
        for directory in set(_read(spark, table, number).directories) - held:
            remove_directory(spark, f"{table}/{directory}")
        remove_directory(spark, _list_path(table, number))
    heads = {d.split("/")[0] for d in held}
    _, fs = file_system(spark, table)
    for status in listed(spark, table):
        name = status.getPath().getName()
        if old and name.startswith(f"{VERSION}=") and name not in heads and not any(s.isDirectory() for s in listed(spark, f"{table}/{name}")):
            fs.delete(status.getPath(), True)


def paths(table: str, version: Version) -> Sequence[str]:
    return [f"{table.rstrip('/')}/{d}" for d in version.directories]


def read_version(spark: SparkSession, table: str, version: Version) -> DataFrame:
    """The rows of a version; partition values are text."""
    if not version.directories:
        return spark.createDataFrame([], version.schema)
    found = spark.read.option("basePath", table.rstrip("/")).schema(version.schema).parquet(*paths(table, version))
    return found.select(*[f"`{n}`" for n in version.schema.names])
