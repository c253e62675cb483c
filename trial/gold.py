"""Gold tables and the reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.rollup import (
    daily_totals,
    rolling_mean_days,
    rolling_mean_rows,
    running_total,
)
from terrace.plans import gold, reports
from trial.registry import query
from trial.standins import (
    GLOBAL_COVID_SQL,
    HOSPITALIZATIONS_SQL,
    PROCESSED_AT,
    VACCINATIONS_SQL,
    global_covid,
    hospitalizations,
    table,
    vaccinations,
)

HOSPITAL_GOLD = f"""
    SELECT *, avg(new_admissions) OVER (PARTITION BY region ORDER BY date
                  ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS "7day_avg_admissions",
           cast(total_icu AS double) / nullif(total_hospitalized, 0) AS icu_rate,
           '{PROCESSED_AT}' AS _gold_processed_at
    FROM (SELECT date, region, cast(sum(total_in) AS bigint) AS total_hospitalized,
                 cast(sum(total_in_icu) AS bigint) AS total_icu,
                 cast(sum(new_in) AS bigint) AS new_admissions,
                 cast(sum(new_out) AS bigint) AS new_discharges,
                 max(_ingestion_date) AS _ingestion_date
          FROM ({HOSPITALIZATIONS_SQL}) GROUP BY date, region)"""

COVERAGE_GOLD = f"""
    SELECT *, cast(sum(doses_administered) OVER (PARTITION BY region, agegroup, dose
                  ORDER BY date ROWS UNBOUNDED PRECEDING) AS bigint) AS cumulative_doses,
           '{PROCESSED_AT}' AS _gold_processed_at
    FROM (SELECT date, region, agegroup, dose, cast(sum(count) AS bigint) AS doses_administered
          FROM ({VACCINATIONS_SQL}) GROUP BY date, region, agegroup, dose)"""

TRENDS_GOLD = f"""
    SELECT date_reported, who_region AS region, country_code, country,
           cast(sum(new_cases) AS bigint) AS new_cases,
           cast(sum(new_deaths) AS bigint) AS new_deaths,
           max(cumulative_cases) AS cumulative_cases,
           max(cumulative_deaths) AS cumulative_deaths,
           CASE WHEN max(cumulative_cases) > 0
                THEN cast(max(cumulative_deaths) AS double) / max(cumulative_cases) * 100
           END AS case_fatality_rate,
           '{PROCESSED_AT}' AS _gold_processed_at
    FROM ({GLOBAL_COVID_SQL}) GROUP BY date_reported, who_region, country_code, country"""


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding of a double's shortest decimal text, which is what Spark does."""
    text = f"cast(cast({expression} AS varchar) AS decimal(38, 18))"
    return f"cast(round({text}, {digits}) AS double)"


def _hospital_gold(spark: SparkSession, sf: str) -> DataFrame:
    return gold.hospitalizations_summary(hospitalizations(spark, sf), PROCESSED_AT)


@query(HOSPITAL_GOLD)
def hospitalizations_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _hospital_gold(spark, sf)


@query(COVERAGE_GOLD)
def vaccination_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return gold.vaccination_coverage(vaccinations(spark, sf), PROCESSED_AT)


@query(TRENDS_GOLD)
def global_trends(spark: SparkSession, sf: str) -> DataFrame:
    return gold.global_trends(global_covid(spark, sf), PROCESSED_AT)


@query(HOSPITAL_GOLD.replace(
    "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW",
    "RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW",
))
def hospitalizations_summary_by_days(spark: SparkSession, sf: str) -> DataFrame:
    return gold.hospitalizations_summary(
        hospitalizations(spark, sf), PROCESSED_AT, window="days"
    )


# --- reports ----------------------------------------------------------------


@query(f"""
    SELECT date, region, total_hospitalized, total_icu,
           {rounded("icu_rate * 100", 2)} AS icu_rate_pct,
           {rounded('"7day_avg_admissions"', 1)} AS avg_daily_admissions_7d
    FROM ({HOSPITAL_GOLD}) WHERE date >= date '2000-06-30' - 30
    ORDER BY date DESC, region""")
def icu_trend_last_30d(spark: SparkSession, sf: str) -> DataFrame:
    return reports.icu_trend(_hospital_gold(spark, sf), as_of="2000-06-30")


@query(f"""
    SELECT agegroup, dose, cast(sum(doses_administered) AS bigint) AS total_doses,
           max(cumulative_doses) AS cumulative_total
    FROM ({COVERAGE_GOLD}) WHERE region = 'purchase'
    GROUP BY agegroup, dose ORDER BY agegroup, dose""")
def coverage_by_agegroup_dose(spark: SparkSession, sf: str) -> DataFrame:
    return reports.coverage_by_group(vaccination_coverage(spark, sf), region="purchase")


@query(f"""
    SELECT date_reported, country, new_cases, new_deaths,
           {rounded("case_fatality_rate", 3)} AS cfr_pct
    FROM ({TRENDS_GOLD})
    WHERE country_code IN ('F', 'O') AND date_reported >= date '2000-05-31' - INTERVAL 3 MONTH
    ORDER BY date_reported DESC, country""")
def country_comparison_3m(spark: SparkSession, sf: str) -> DataFrame:
    return reports.country_comparison(
        global_trends(spark, sf), as_of="2000-05-31", countries=["F", "O"]
    )


@query(f"""
    SELECT cast(date_trunc('week', date) AS date) AS week_start, region,
           avg(total_hospitalized) AS avg_hospitalized, avg(total_icu) AS avg_icu,
           cast(sum(new_admissions) AS bigint) AS total_new_admissions
    FROM ({HOSPITAL_GOLD}) GROUP BY 1, region ORDER BY week_start DESC, region""")
def weekly_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return reports.weekly_by_region(_hospital_gold(spark, sf))


@query(f"""
    SELECT '_ingestion_date' AS metric, max(_ingestion_date) AS latest_ingestion,
           count(*) AS total_records, count(DISTINCT region) AS regions_count
    FROM ({HOSPITAL_GOLD}) GROUP BY 1""")
def freshness(spark: SparkSession, sf: str) -> DataFrame:
    return reports.freshness(_hospital_gold(spark, sf))


# --- the parts of the gold tables -------------------------------------------

DAILY_EVENTS = """
    SELECT cast(ts AS date) AS date, event_type, user_id % 50 AS cohort,
           cast(sum(cast(floor(value) AS int)) AS bigint) AS total
    FROM events GROUP BY ALL"""


def _daily_events(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"),
        "event_type",
        (F.col("user_id") % 50).alias("cohort"),
        F.floor("value").cast("int").alias("units"),
    )
    return daily_totals(events, "date", ["event_type", "cohort"], sums={"total": "units"})


@query(DAILY_EVENTS)
def daily_sums(spark: SparkSession, sf: str) -> DataFrame:
    return _daily_events(spark, sf)


@query(f"""
    SELECT *, avg(total) OVER (PARTITION BY event_type, cohort ORDER BY date
               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean7
    FROM ({DAILY_EVENTS})""")
def rolling_avg_7rows(spark: SparkSession, sf: str) -> DataFrame:
    by = ["event_type", "cohort"]
    return rolling_mean_rows(_daily_events(spark, sf), "total", "mean7", by=by, date="date")


@query(f"""
    SELECT *, avg(total) OVER (PARTITION BY event_type, cohort ORDER BY date
               RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS mean7
    FROM ({DAILY_EVENTS})""")
def rolling_avg_7days(spark: SparkSession, sf: str) -> DataFrame:
    by = ["event_type", "cohort"]
    return rolling_mean_days(_daily_events(spark, sf), "total", "mean7", by=by, date="date")


@query(f"""
    SELECT *, cast(sum(total) OVER (PARTITION BY event_type, cohort ORDER BY date
               ROWS UNBOUNDED PRECEDING) AS bigint) AS running
    FROM ({DAILY_EVENTS})""")
def cumulative_sum(spark: SparkSession, sf: str) -> DataFrame:
    by = ["event_type", "cohort"]
    return running_total(_daily_events(spark, sf), "total", "running", by=by, date="date")
