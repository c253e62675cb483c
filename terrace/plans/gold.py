"""The three gold tables, each a silver frame in and a gold frame out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import fraction, percentage
from terrace.layout import utc_now
from terrace.operators.quality import Check
from terrace.operators.rollup import (
    daily_totals,
    rolling_mean_days,
    rolling_mean_rows,
    running_total,
)
from terrace.plans.checks import QualityFailure, require_later
from terrace.sources.gold import stage_gold
from terrace.sources.silver import read_silver

INGESTED, PROCESSED = "_ingestion_date", "_gold_processed_at"


def _stamped(df: DataFrame, processed_at: str) -> DataFrame:
    return df.withColumn(PROCESSED, F.lit(processed_at))


def hospitalizations_summary(
    silver: DataFrame, processed_at: str, *, window: str = "rows"
) -> DataFrame:
    """Daily hospital load per region with a 7-row (or 7-day) mean of admissions.

    ``_ingestion_date`` is the newest one that went into the row; it is left out
    if the silver frame has none.
    """
    mean = {"rows": rolling_mean_rows, "days": rolling_mean_days}[window]
    totals = daily_totals(
        silver,
        "date",
        ["region"],
        sums={
            "total_hospitalized": "total_in",
            "total_icu": "total_in_icu",
            "new_admissions": "new_in",
            "new_discharges": "new_out",
        },
        maxima={INGESTED: INGESTED} if INGESTED in silver.columns else None,
        parse_groups=True,
    )
    series = mean(totals, "new_admissions", "7day_avg_admissions", by=["region"], date="date")
    rated = series.withColumn(
        "icu_rate", fraction(F.col("total_icu"), F.col("total_hospitalized"))
    )
    # Lineage columns come last.
    ordered = [c for c in rated.columns if c != INGESTED]
    ordered += [c for c in rated.columns if c == INGESTED]
    return _stamped(rated.select(*ordered), processed_at)


def vaccination_coverage(silver: DataFrame, processed_at: str) -> DataFrame:
    """Doses per day and their running total by region, age group and dose."""
    series = ["region", "agegroup", "dose"]
    totals = daily_totals(
        silver, "date", series, sums={"doses_administered": "count"}, parse_groups=True
    )
    totalled = running_total(
        totals, "doses_administered", "cumulative_doses", by=series, date="date"
    )
    return _stamped(totalled, processed_at)


def global_trends(silver: DataFrame, processed_at: str) -> DataFrame:
    """Daily cases and deaths per country with the case fatality rate in percent."""
    totals = daily_totals(
        silver,
        "date_reported",
        ["who_region", "country_code", "country"],
        sums={"new_cases": "new_cases", "new_deaths": "new_deaths"},
        maxima={
            "cumulative_cases": "cumulative_cases",
            "cumulative_deaths": "cumulative_deaths",
        },
    )
    rated = totals.withColumn(
        "case_fatality_rate",
        percentage(F.col("cumulative_deaths"), F.col("cumulative_cases")),
    )
    return _stamped(rated.withColumnRenamed("who_region", "region"), processed_at)


@dataclass(frozen=True)
class GoldTable:
    name: str
    source: str
    build: Callable[[DataFrame, str], DataFrame]
    date: str = "date"


# Names of the gold tables and the sources they are built from.
GOLD_TABLES = (
    GoldTable(
        "be_hospitalizations_summary",
        "sciensano/covid_hospitalizations",
        hospitalizations_summary,
    ),
    GoldTable(
        "be_vaccination_coverage", "sciensano/covid_vaccinations", vaccination_coverage
    ),
    GoldTable("who_global_trends", "who/global_covid", global_trends, "date_reported"),
)


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    processed_at: str | None = None,
    *,
    snapshot: str | dt.date = "latest",
    tables: Sequence[GoldTable] = GOLD_TABLES,
    suites: Mapping[str, Sequence[Check]] | None = None,
    merge_schema: bool | None = None,
) -> dict[str, int]:
    """Build and write the gold tables in order; rows written per table.

    Tables are written aside and then replaced in one step, see ``terrace.sources.versions``.
    With ``suites`` a silver frame must pass the checks of its source: counts of rows are taken by
    the job that builds the table, which is published only if they are in order.
    QualityFailure leaves the gold table of that source as it was.
    """
    rows = {}
    for table in tables:
        silver = read_silver(spark, silver_root, table.source, snapshot, merge_schema=merge_schema)
        silver, judge = require_later(silver, table.source, suites or {})
        gold = table.build(silver, processed_at or utc_now())
        staged = stage_gold(gold, gold_root, table.name, sort_by=[table.date])
        try:
            judge()
        except QualityFailure:
            staged.drop()
            raise
        rows[table.name] = staged.publish()
    return rows
