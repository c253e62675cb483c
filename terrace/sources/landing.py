"""Putting dropped raw files into the bronze zone, one snapshot per source and day.

Files of any size are read and written by many tasks, and the way is the same at every size.
JSON Lines are copied line by line.  CSV is too, and every file written begins with the
header, as a reader skips the first line of each; files of one source must agree on it.
JSON documents are cut into records, whose text stays as it is; each task writes its own
as a JSON array.  Records that cannot be read, and what surrounds them, go to
``<bronze root>/_rejected/<source>`` with the file they came from and the reason.

CSV whose records are not lines (``multiLine``, or an encoding other than UTF-8) is copied file by
file instead, and a file must then fit a row of Spark (2 GB).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.layout import run_day, ship_library, snapshot_dir, snapshot_keys, source_dir
from terrace.registry import SourceSpec
from terrace.sources.documents import as_arrays, read_documents
from terrace.sources.files import files_under, remove_directory, replace_snapshots
from terrace.sources.metrics import counted

log = logging.getLogger(__name__)

#: Folder of the bronze root for what could not be landed; readers pass over its name.
REJECTED = "_rejected"

RESULT = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in ("source", "status", "key", "error")]
)


@dataclass(frozen=True)
class Landing:
    """What became of one source: ``key`` on success, ``error`` on failure."""

    source: str
    status: str
    key: str | None = None
    error: str | None = None


def land_source(
    spark: SparkSession,
    spec: SourceSpec,
    drop_root: str,
    bronze_root: str,
    run_date: str | dt.date,
) -> str:
    """Land what lies under ``<drop_root>/<source>``; a rerun replaces the snapshot.

    The snapshot that was there stays until the new one is complete.
    """
    dropped = source_dir(drop_root, spec.name)
    if files_under(spark, dropped).isEmpty():
        raise FileNotFoundError(f"nothing dropped under {dropped}")
    keys = snapshot_keys(F.lit(run_day(run_date)))
    found = None
    if spec.file_format == "json" and spec.options.get("multiLine") == "true":
        records = read_documents(spark, dropped, options=spec.options)
        records, found = counted(records, "records landed", rejected=F.count_if(F.col("reason").isNotNull()))
        raw, per_file = as_arrays(records.where("reason IS NULL")), 0
    elif spec.file_format == "csv" and _by_line(spec):
        raw, per_file = _csv_lines(spark, dropped), 0
    elif spec.file_format == "csv":
        files = _nested(spark).format("binaryFile").load(dropped)
        raw, per_file = files.select(F.col("content").cast("string").alias("value")), 1
    else:
        raw, per_file = _nested(spark).text(dropped), 0
    replace_snapshots(
        raw.select("value").withColumns(keys).write.option("maxRecordsPerFile", per_file)
    ).text(source_dir(bronze_root, spec.name))
    if found:
        bad = rejected_dir(bronze_root, spec.name)
        if found()["rejected"]:
            wrong = records.where("reason IS NOT NULL").withColumns(keys)
            replace_snapshots(wrong.write).json(bad)
        else:
            remove_directory(spark, snapshot_dir(bronze_root, f"{REJECTED}/{spec.name}", run_date))
    return snapshot_dir(bronze_root, spec.name, run_date)


def rejected_dir(bronze_root: str, source: str) -> str:
    return source_dir(bronze_root, f"{REJECTED}/{source}")


def read_rejected(spark: SparkSession, bronze_root: str, source: str) -> DataFrame:
    """What could not be landed of ``source``: ``path, record, reason`` and the snapshot it came with."""
    schema = "path string, record string, reason string, year int, month int, day int"
    return spark.read.schema(schema).json(rejected_dir(bronze_root, source))


def _nested(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", "true")


def _by_line(spec: SourceSpec) -> bool:
    encoding = spec.options.get("encoding", spec.options.get("charset", "UTF-8"))
    return spec.options.get("multiLine") != "true" and encoding.upper() in ("UTF-8", "UTF8", "US-ASCII")


#: Byte order mark and white space around a header.
_AROUND = b"\xef\xbb\xbf \t\r\n"


def _csv_lines(spark: SparkSession, dropped: str) -> DataFrame:
    """Lines of all files in ``value``; every task's begin with the header the files have in common.

    The header is the first line of a file that is not blank.  Only one of them comes to the driver, the
    others are compared with it where they are read.
    """
    lines = _nested(spark).text(dropped)
    start = F.col("_metadata.file_block_start")
    filled = files_under(spark, dropped).where("length > 0").agg(F.min("path")).first()[0]
    first = None
    if filled is not None:
        top = spark.read.text(filled).where((start == 0) & F.col("value").rlike(r"\S"))
        first = top.select(F.col("value").cast("binary")).first()
    header = bytes(first[0]) if first else b""
    ship_library(spark)
    marked = lines.select(
        F.col("value").cast("binary").alias("value"),
        F.xxhash64("_metadata.file_path", start).alias("block"),
        (start == 0).alias("from_start"),
        F.col("_metadata.file_path").alias("path"),
    )

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ahead, begun = None, False, False
        for batch in batches:
            if not batch.num_rows:
                continue
            value, block = batch.column(0), batch.column(1).to_numpy()
            starts = np.flatnonzero(np.append(before is None or block[0] != before, block[1:] != block[:-1]))
            taken = []
            for i in [0, *starts] if ahead and (not len(starts) or starts[0]) else starts:
                ahead = ahead if i == 0 and block[0] == before else batch.column(2)[int(i)].as_py()
                at = int(i)
                while ahead and at < batch.num_rows and block[at] == block[i]:
                    line = value[at].as_py().strip(_AROUND)
                    taken.append(at)
                    at += 1
                    if line:
                        ahead = False
                        if line != header.strip(_AROUND):
                            raise ValueError(f"{batch.column(3)[int(i)].as_py()} has another header than the other files")
            before = block[-1]
            if not begun:
                begun = True
                yield pa.RecordBatch.from_arrays([pa.array([header])], ["value"])
            if taken:
                keep = np.ones(batch.num_rows, bool)
                keep[taken] = False
                value = pc.filter(value, pa.array(keep))
            yield pa.RecordBatch.from_arrays([value], ["value"])

    return marked.mapInArrow(with_header, "value binary").select(F.col("value").cast("string").alias("value"))


def land(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    drop_root: str,
    bronze_root: str,
    run_date: str | dt.date,
) -> DataFrame:
    """Land every source; one that cannot be read or written is recorded and the others go on.

    The result has one row per source.
    """
    results = []
    for spec in specs:
        try:
            key = land_source(spark, spec, drop_root, bronze_root, run_date)
            results.append(Landing(spec.name, "success", key=key))
        except (PySparkException, Py4JJavaError, OSError) as error:
            if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
                raise  # the cluster has failed, not the source
            log.warning("landing %s for %s failed: %s", spec.name, run_day(run_date), error)
            first_line = str(error).strip().splitlines()[0] if str(error).strip() else repr(error)
            results.append(Landing(spec.name, "failed", error=first_line))
    rows = [(r.source, r.status, r.key, r.error) for r in results]
    return spark.createDataFrame(rows, RESULT)


def missing_sources(expected: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Expected sources of which nothing has landed."""
    return expected.join(landed.select(key).distinct(), key, "left_anti")


def landing_status(expected: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Every expected source with ``status`` and ``error``.

    Landed rows are merged per source before the join, so a source with very
    many of them brings one row.
    """
    seen = landed.groupBy(key).agg(F.count(F.lit(1)).alias("landed_rows"))
    landed_rows = F.coalesce("landed_rows", F.lit(0))
    return expected.join(seen, key, "left").select(
        key,
        F.when(landed_rows > 0, "success").otherwise("failed").alias("status"),
        F.when(landed_rows == 0, "nothing landed").alias("error"),
        landed_rows.alias("landed_rows"),
    )
