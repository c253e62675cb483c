"""Reports over the gold tables.  NULLs sort last in both directions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import days_before, months_before, week_start
from terrace.functions.dates import AsOf

# The countries compared by default.
NEIGHBOURS = ("BE", "NL", "DE", "FR", "LU")


def icu_trend(hospitalizations: DataFrame, as_of: AsOf = None, days: int = 30) -> DataFrame:
    """ICU share and mean admissions per region over the last ``days`` days."""
    return (
        hospitalizations.where(F.col("date") >= days_before(as_of, days))
        .select(
            "date",
            "region",
            "total_hospitalized",
            "total_icu",
            F.round(F.col("icu_rate") * 100, 2).alias("icu_rate_pct"),
            F.round("7day_avg_admissions", 1).alias("avg_daily_admissions_7d"),
        )
        .orderBy(F.desc_nulls_last("date"), F.asc_nulls_last("region"))
    )


def coverage_by_group(coverage: DataFrame, region: str = "Flanders") -> DataFrame:
    """Doses given and final running total per age group and dose in one region."""
    return (
        coverage.where(F.col("region") == region)
        .groupBy("agegroup", "dose")
        .agg(
            F.sum("doses_administered").alias("total_doses"),
            F.max("cumulative_doses").alias("cumulative_total"),
        )
        .orderBy(F.asc_nulls_last("agegroup"), F.asc_nulls_last("dose"))
    )


def country_comparison(
    trends: DataFrame,
    as_of: AsOf = None,
    months: int = 3,
    countries: Iterable[str] = NEIGHBOURS,
) -> DataFrame:
    """New cases, deaths and fatality rate of some countries over the last months."""
    return (
        trends.where(
            F.col("country_code").isin(list(countries))
            & (F.col("date_reported") >= months_before(as_of, months))
        )
        .select(
            "date_reported",
            "country",
            "new_cases",
            "new_deaths",
            F.round("case_fatality_rate", 3).alias("cfr_pct"),
        )
        .orderBy(F.desc_nulls_last("date_reported"), F.asc_nulls_last("country"))
    )


def weekly_by_region(hospitalizations: DataFrame) -> DataFrame:
    """Mean load and admissions per calendar week and region."""
    return (
        hospitalizations.groupBy(week_start(F.col("date")).alias("week_start"), "region")
        .agg(
            F.avg("total_hospitalized").alias("avg_hospitalized"),
            F.avg("total_icu").alias("avg_icu"),
            F.sum("new_admissions").alias("total_new_admissions"),
        )
        .orderBy(F.desc_nulls_last("week_start"), F.asc_nulls_last("region"))
    )


def freshness(hospitalizations: DataFrame) -> DataFrame:
    """Newest ingestion date, rows and regions; no row for an empty table.

    Rows are merged per region before the final step, so only one short row per
    region and task is shuffled.
    """
    per_region = hospitalizations.groupBy("region").agg(
        F.max("_ingestion_date").alias("newest"), F.count(F.lit(1)).alias("records")
    )
    return per_region.groupBy(F.lit("_ingestion_date").alias("metric")).agg(
        F.max("newest").alias("latest_ingestion"),
        F.sum("records").alias("total_records"),
        F.count("region").alias("regions_count"),
    )
