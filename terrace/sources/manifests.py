"""Run manifests: one JSON record per run with the outcome of each source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.layout import run_day
from terrace.sources.landing import RESULT

FOLDER = "_manifests"
RUN = ("run_date", "run_timestamp", "env")

MANIFEST = T.StructType(
    [
        *(T.StructField(n, T.StringType(), True) for n in RUN),
        T.StructField("results", T.ArrayType(RESULT), True),
    ]
)


def manifests(results: DataFrame) -> DataFrame:
    """One row per run from one row per run and source.

    An array holds as many entries as a run has sources.
    """
    entry = F.struct(*RESULT.fieldNames())
    return results.groupBy(*RUN).agg(F.sort_array(F.collect_list(entry)).alias("results"))


def write_manifest(
    results: DataFrame,
    bronze_root: str,
    run_date: str | dt.date,
    run_timestamp: str,
    env: str = "dev",
) -> str:
    """Write the manifest of one run under ``_manifests/run=<run_date>`` and return the path.

    ``write_manifests`` uses the same directories, so a run counts once whoever wrote it.
    """
    day = run_day(run_date).isoformat()
    path = f"{bronze_root.rstrip('/')}/{FOLDER}/run={day}"
    stamped = results.withColumns(
        {"run_date": F.lit(day), "run_timestamp": F.lit(run_timestamp), "env": F.lit(env)}
    )
    manifests(stamped).write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)
    return path


def write_manifests(runs: DataFrame, bronze_root: str) -> str:
    """Write the manifests of many runs in one job, one file per run."""
    path = f"{bronze_root.rstrip('/')}/{FOLDER}"
    (
        runs.withColumn("run", F.col("run_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 1)
        .partitionBy("run")
        .json(path)
    )
    return path


def read_manifests(spark: SparkSession, bronze_root: str) -> DataFrame:
    """All manifests.  The glob reaches into the folder, whose name Spark treats as hidden."""
    glob = f"{bronze_root.rstrip('/')}/{FOLDER}/*/*.json"
    return spark.read.schema(MANIFEST).option("multiLine", "true").json(glob)


def manifest_entries(runs: DataFrame) -> DataFrame:
    """One row per run and source; a run without sources keeps a row of NULLs."""
    return runs.select(*RUN, F.explode_outer("results").alias("result")).select(
        *RUN, "result.*"
    )


def run_summary(entries: DataFrame) -> DataFrame:
    """Successes over sources per run date."""
    return entries.groupBy("run_date").agg(
        F.count_if(F.col("status") == "success").alias("succeeded"),
        F.count("status").alias("sources"),
    )
