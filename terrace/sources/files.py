"""Looking at which files there are, without opening them."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from terrace.layout import SNAPSHOT


def files_under(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, length and modification time of every file below ``path``.

    The binary source reads no content when the content column is not asked for.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def file_system(spark: SparkSession, path: str):
    """A Hadoop path and the file system it is on."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def directory_exists(spark: SparkSession, path: str) -> bool:
    at, fs = file_system(spark, path)
    return fs.exists(at)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and host, absolute, without doubled or trailing slashes."""
    at, fs = file_system(spark, path)
    return fs.makeQualified(at).toString().rstrip("/")


def listed(spark: SparkSession, path: str) -> Iterator:
    """What is in a directory, one by one; nothing if there is no such directory."""
    at, fs = file_system(spark, path)
    if not fs.exists(at):
        return
    found = fs.listStatusIterator(at)
    while found.hasNext():
        yield found.next()


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a file of some kilobytes."""
    at, fs = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that is there as a whole or not at all; False if there is one already."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at, fs = file_system(spark, path)
    draft = hadoop.Path(at.getParent(), f"_{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not fs.exists(at):
        try:
            rename = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
            hadoop.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, at, rename)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
    fs.delete(draft, False)
    return False


def make_directory(spark: SparkSession, path: str) -> None:
    at, fs = file_system(spark, path)
    fs.mkdirs(at)


def remove_directory(spark: SparkSession, path: str) -> None:
    """Delete a directory and what is in it, if it is there."""
    at, fs = file_system(spark, path)
    fs.delete(at, True)


def visible(name: str) -> bool:
    return not name.startswith(("_", "."))


def first_lines(spark: SparkSession, directories: Sequence[str]) -> list[str]:
    """Per directory the first line of its first file that is not empty, else ``''``."""
    if not directories:
        return []
    java = spark.sparkContext._jvm.java.io
    buffered, decoded = java.BufferedReader, java.InputStreamReader
    _, fs = file_system(spark, directories[0])
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def first(directory: str) -> str:
        files = {s.getPath().getName(): s for s in fs.listStatus(path(directory))}
        for name in sorted(filter(visible, files)):
            if files[name].getLen() > 0:
                stream = fs.open(files[name].getPath())
                try:
                    return buffered(decoded(stream, "UTF-8")).readLine()
                finally:
                    stream.close()
        return ""

    with ThreadPoolExecutor(max_workers=8) as pool:
        return list(pool.map(first, directories))


def snapshots_newest_first(
    spark: SparkSession, source_path: str, suffix: str = ""
) -> Iterator[dt.date]:
    """Snapshots that hold a visible file ending in ``suffix``, the newest first.

    Lists directories only as far as the caller goes on, so finding the newest
    snapshot does not touch the others.
    """
    path, fs = file_system(spark, source_path)

    def below(parent):
        return {status.getPath().getName(): status for status in fs.listStatus(parent)}

    def newest_first(parent, key):
        named = {n.split("=")[1]: s for n, s in below(parent).items() if n.startswith(f"{key}=")}
        for value in sorted((v for v in named if v.isdigit()), key=int, reverse=True):
            yield int(value), named[value].getPath()

    if not fs.exists(path):
        return
    for year, year_path in newest_first(path, "year"):
        for month, month_path in newest_first(year_path, "month"):
            for day, day_path in newest_first(month_path, "day"):
                if any(visible(n) and n.endswith(suffix) for n in below(day_path)):
                    yield dt.date(year, month, day)


#: A scheme and the host after it.
_SCHEME = r"^[A-Za-z0-9+.-]+:(//[^/]*)?"


def relative(path: str, root: str) -> Column:
    """The part of ``path`` below ``root``, whatever the scheme."""
    start = len(re.sub(_SCHEME, "", root).rstrip("/")) + 2
    return F.substring(F.regexp_replace(path, _SCHEME, ""), start, 1 << 30)


def replace_snapshots(writer: DataFrameWriter) -> DataFrameWriter:
    """Set up to replace the snapshots present in the rows when the job has succeeded, and no others."""
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SNAPSHOT)


def remove_other_partitions(spark: SparkSession, table_path: str, column: str, kept: set[str | None]) -> None:
    """Delete the directories of ``column`` that belong to none of the ``kept`` values."""
    path, fs = file_system(spark, table_path)
    naming = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    names = {naming.getPartitionPathString(column, value) for value in kept}
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith(f"{column}=") and name not in names:
            fs.delete(status.getPath(), True)
