"""Reading raw snapshots."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.layout import SNAPSHOT, run_days, snapshot_dir, source_dir, workspace
from terrace.registry import SourceSpec, raw_name
from terrace.sources.documents import read_documents
from terrace.sources.files import first_lines, snapshots_newest_first

CORRUPT = "_corrupt_record"


def read_bronze(
    spark: SparkSession,
    spec: SourceSpec,
    root: str,
    run_dates: str | dt.date | Sequence[str | dt.date] | None = None,
    *,
    declared: bool = False,
    corrupt: bool = False,
) -> DataFrame:
    """Raw rows of one run date, of several, or of all snapshots if None is given.

    All values are text, and ``year``, ``month``, ``day`` come from the path.
    Run dates are read from their own directories, so nothing else is listed.

    By default the columns are those found in the files: unregistered ones are
    kept and registered ones that are missing are not made up.  JSON is parsed once for
    that, into a staged table, from which the names are then taken; documents are cut
    among tasks whatever their size, and a value that is no text is its JSON.  ``declared``
    gives exactly the registered fields and stages nothing; ``corrupt`` then adds a column with
    the text of records that could not be parsed.  Without ``declared`` that column is there
    if any record has one.

    A raw field called year, month or day gets ``raw_`` before its name.
    """
    base = source_dir(root, spec.name)
    days = None if run_dates is None else run_days(run_dates)
    if spec.file_format == "csv":
        whole = days is None
        if whole:
            days = snapshots_newest_first(spark, base)
        paths = [snapshot_dir(root, spec.name, d) for d in days]
        return _read_csv(spark, spec, base, paths, whole, declared, declared and corrupt)

    paths = [base] if days is None else [snapshot_dir(root, spec.name, d) for d in days]
    if not declared and spec.file_format == "json":
        return _read_json(spark, spec, paths)
    # Names are taken from the data or the registry, values stay text either way.
    reader = spark.read.format(spec.file_format).options(**spec.options).option("primitivesAsString", "true")
    if not declared:
        return reader.option("basePath", base).load(paths)
    schema = _with_corrupt(spec.as_text, corrupt)
    if not any(_reserved(n) for n in schema.names):
        return reader.option("basePath", base).schema(schema).load(paths)
    rows = reader.option("recursiveFileLookup", "true").schema(schema).load(paths)
    return _beside_snapshot(rows, schema.names, F.col("_metadata.file_path"))


def _reserved(name: str) -> bool:
    return name.lower() in SNAPSHOT


def _beside_snapshot(rows: DataFrame, names: Sequence[str], path: Column) -> DataFrame:
    """The columns ``names``, none called like a part of the snapshot's date, and that of ``path``."""
    kept = [F.col(f"`{n}`").alias(raw_name(n)) for n in names]
    parts = [F.regexp_extract(path, rf"/{k}=(\d+)/", 1).cast("int").alias(k) for k in SNAPSHOT]
    return rows.select(*kept, *parts)


def _read_json(spark: SparkSession, spec: SourceSpec, paths: Sequence[str]) -> DataFrame:
    """All fields of JSON rows as text, from one pass over the files.

    The parsed rows are staged, each as a map; the names are the keys that occur in it.
    """
    if spec.options.get("multiLine") == "true":
        found = read_documents(spark, paths, options=spec.options)
        text, broken = F.col("record"), F.col("reason").isNotNull()
    else:
        lines = spark.read.option("recursiveFileLookup", "true").text(paths)
        found = lines.where(F.trim("value") != "").select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("path"))
        text, broken = F.col("record"), F.lit(False)
    one, many = (F.from_json(text, t, dict(spec.options)) for t in ("map<string,string>", "array<map<string,string>>"))
    rows = F.when(broken, F.lit(None)).when(F.ltrim(text).startswith("["), many).otherwise(F.array(one))
    staged = workspace(spark)
    found = found.select("path", "record", rows.alias("rows")).where("rows IS NULL OR size(rows) > 0")
    found.select("path", "record", F.explode_outer("rows").alias("fields")).select(
        "fields", F.when(F.col("fields").isNull(), F.col("record")).alias(CORRUPT), "path"
    ).write.parquet(staged)
    parsed = spark.read.parquet(staged)
    keys = parsed.select(F.explode(F.map_keys("fields")).alias("name")).distinct()
    names = sorted(r["name"] for r in keys.collect())
    rows = parsed.select(*[F.element_at("fields", F.lit(n)).alias(n) for n in names], CORRUPT, "path")
    if not rows.where(F.col(CORRUPT).isNotNull()).isEmpty():
        names.append(CORRUPT)
    return _beside_snapshot(rows, names, F.col("path"))


def _with_corrupt(schema: T.StructType, corrupt: bool) -> T.StructType:
    extra = [T.StructField(CORRUPT, T.StringType(), True)] if corrupt else []
    return T.StructType(schema.fields + extra)


def _read_csv(
    spark: SparkSession,
    spec: SourceSpec,
    base: str,
    paths: Sequence[str],
    whole: bool,
    declared: bool,
    corrupt: bool,
) -> DataFrame:
    """CSV snapshots by the names in their headers, which may change between snapshots.

    Spark takes the header of one file for all it reads, so snapshots are read in
    groups with the same header.  The headers are one line per snapshot.  ``whole``
    says that ``paths`` are all snapshots below ``base``.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for path, line in zip(paths, first_lines(spark, paths)):
        # A snapshot that starts with an empty line is looked at on its own.
        groups[line.strip() or path].append(path)
    frames = []
    for alike in groups.values():
        names = spark.read.options(**spec.options).csv(alike[0]).columns
        if not names:
            continue
        schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
        read = spark.read.options(**spec.options).schema(_with_corrupt(schema, corrupt))
        files = [base] if whole and len(groups) == 1 else alike
        if any(map(_reserved, names)):
            rows = read.option("recursiveFileLookup", "true").csv(files)
            frames.append(_beside_snapshot(rows, rows.columns, F.col("_metadata.file_path")))
        else:
            frames.append(read.option("basePath", base).csv(files))
    if not frames:
        raise FileNotFoundError(f"no CSV snapshot with a header under {base}")
    rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)
    if not declared:
        return rows
    present = {n.lower(): n for n in rows.columns}
    registered = map(raw_name, _with_corrupt(spec.as_text, corrupt).names)
    wanted = [
        (F.col(f"`{present[n.lower()]}`") if n.lower() in present else F.lit(None).cast("string"))
        .alias(n)
        for n in registered
    ]
    return rows.select(*wanted, *SNAPSHOT)
