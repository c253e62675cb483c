"""Row counts taken by the job that moves the rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def counted(
    df: DataFrame, name: str, **more: Column
) -> tuple[DataFrame, Callable[[], dict[str, Any]]]:
    """``df`` and a function for its number of ``rows`` and ``more`` aggregates.

    Call the function after the action on ``df``.  The values are metrics: tasks
    that run again after the loss of an executor may count twice.  If nothing of
    ``df`` reaches the end of the action, adaptive execution takes the empty
    branch out together with its metrics; they are then computed on their own.
    """
    seen = Observation(f"{name} {uuid.uuid4().hex}")
    wanted = [F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in more.items())]

    def values() -> dict[str, Any]:
        try:
            return seen.get
        except Py4JJavaError:
            return df.agg(*wanted).first().asDict()

    return df.observe(seen, *wanted), values


def written_rows(spark: SparkSession, *paths: str) -> int:
    """Rows in the Parquet files under ``paths``, by their footers: no column is read.

    Only committed files are there, so a task that ran twice counts once.
    """
    return spark.read.schema("_none int").option("recursiveFileLookup", "true").parquet(*paths).count()
