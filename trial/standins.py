"""Silver and raw frames in the shapes of the registered sources, made from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.registry import CSV_WITH_HEADER, JSON_DOCUMENTS, SourceSpec, fields

PROCESSED_AT = "2024-02-01T00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_text(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def hospitalizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        day_text("l_shipdate").alias("date"),
        F.col("l_linestatus").alias("province"),
        F.col("l_returnflag").alias("region"),
        F.col("l_quantity").cast("int").alias("total_in"),
        F.col("l_linenumber").alias("total_in_icu"),
        F.round(F.col("l_discount") * 100).cast("int").alias("new_in"),
        F.round(F.col("l_tax") * 100).cast("int").alias("new_out"),
        F.date_add(F.col("l_shipdate").cast("date"), F.col("l_linenumber")).alias(
            "_ingestion_date"
        ),
    )


HOSPITALIZATIONS_SQL = """
    SELECT cast(l_shipdate AS date) AS date, l_linestatus AS province, l_returnflag AS region,
           cast(l_quantity AS int) AS total_in, l_linenumber AS total_in_icu,
           cast(round(l_discount * 100) AS int) AS new_in,
           cast(round(l_tax * 100) AS int) AS new_out,
           cast(l_shipdate AS date) + l_linenumber AS _ingestion_date
    FROM lineitem"""


def _age(user: str) -> Column:
    return (
        F.when(F.col(user) % 3 == 0, "18-34").when(F.col(user) % 3 == 1, "35-64").otherwise("65+")
    )


def _dose(user: str) -> Column:
    return (
        F.when(F.col(user) % 4 == 0, "A")
        .when(F.col(user) % 4 == 1, "B")
        .when(F.col(user) % 4 == 2, "C")
        .otherwise("E")
    )


def vaccinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        day_text("ts").alias("date"),
        F.col("event_type").alias("region"),
        _age("user_id").alias("agegroup"),
        _dose("user_id").alias("dose"),
        F.floor("value").cast("int").alias("count"),
    )


VACCINATIONS_SQL = """
    SELECT cast(ts AS date) AS date, event_type AS region,
           CASE user_id % 3 WHEN 0 THEN '18-34' WHEN 1 THEN '35-64' ELSE '65+' END AS agegroup,
           CASE user_id % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'E' END AS dose,
           cast(floor(value) AS int) AS count
    FROM events"""


def global_covid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as country reports; some dates are in the wrong format, some cases are zero."""
    day = day_text("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 50 == 0, F.replace(day, F.lit("-"), F.lit("/")))
        .otherwise(day)
        .alias("date_reported"),
        F.col("o_orderpriority").alias("who_region"),
        F.col("o_orderstatus").alias("country_code"),
        F.concat(F.lit("Country "), "o_orderstatus").alias("country"),
        F.col("o_totalprice").cast("int").alias("new_cases"),
        (F.col("o_custkey") % 100).cast("int").alias("new_deaths"),
        (F.col("o_orderkey") % 5 * F.col("o_custkey")).cast("int").alias("cumulative_cases"),
        (F.col("o_custkey") % 17).cast("int").alias("cumulative_deaths"),
    )


GLOBAL_COVID_SQL = """
    SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE cast(o_orderdate AS date) END
               AS date_reported,
           o_orderpriority AS who_region, o_orderstatus AS country_code,
           'Country ' || o_orderstatus AS country,
           cast(trunc(o_totalprice) AS int) AS new_cases,
           cast(o_custkey % 100 AS int) AS new_deaths,
           cast(o_orderkey % 5 * o_custkey AS int) AS cumulative_cases,
           cast(o_custkey % 17 AS int) AS cumulative_deaths
    FROM orders"""


# --- raw sources ------------------------------------------------------------

EVENTS = SourceSpec(
    "trial/events",
    fields(text="DATE REGION EVENT-ID USER-ID", whole="COUNT K"),
    date_column="date",
    options=JSON_DOCUMENTS,
)

ORDERS = SourceSpec(
    "trial/orders",
    fields(
        text="Date_reported Country_code Country WHO_region",
        whole="New_cases Cumulative_cases New_deaths Cumulative_deaths",
    ),
    date_column="date_reported",
    file_format="csv",
    options=CSV_WITH_HEADER,
)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text with everyday defects: decimals, junk, missing dates, and copies.

    Every third event comes twice.  One id in a hundred has no date.
    """
    events = table(spark, sf_dir, "events").withColumn(
        "copy", F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1)))
                          .otherwise(F.array(F.lit(0))))
    )
    whole = F.floor("value").cast("int").cast("string")
    return events.select(
        F.when(F.col("event_id") % 100 != 7, day_text("ts")).alias("DATE"),
        F.col("event_type").alias("REGION"),
        F.col("event_id").cast("string").alias("EVENT-ID"),
        F.col("user_id").cast("string").alias("USER-ID"),
        F.when(F.col("event_id") % 10 == 1, F.concat(whole, F.lit(".75")))
        .when(F.col("event_id") % 10 == 2, F.concat(F.lit(" "), whole, F.lit(" ")))
        .when(F.col("event_id") % 10 == 3, F.lit("n/a"))
        .when(F.col("event_id") % 10 == 4, F.lit("3000000000"))
        .otherwise(whole)
        .alias("COUNT"),
        F.get_json_object("props", "$.k").alias("K"),
        F.col("ts").cast("date").alias("run_date"),
    )


RAW_TEXT_SQL = """
    SELECT CASE WHEN event_id % 100 <> 7 THEN strftime(ts, '%Y-%m-%d') END AS "DATE",
           event_type AS "REGION", cast(event_id AS varchar) AS "EVENT-ID",
           cast(user_id AS varchar) AS "USER-ID",
           CASE event_id % 10 WHEN 1 THEN whole || '.75' WHEN 2 THEN ' ' || whole || ' '
                WHEN 3 THEN 'n/a' WHEN 4 THEN '3000000000' ELSE whole END AS "COUNT",
           json_extract_string(props, '$.k') AS "K",
           year(ts)::int AS year, month(ts)::int AS month, day(ts)::int AS day
    FROM (SELECT *, cast(cast(floor(value) AS int) AS varchar) AS whole FROM events
          UNION ALL
          SELECT *, cast(cast(floor(value) AS int) AS varchar) FROM events
          WHERE event_id % 3 = 0)"""

RAW_EVENTS_SQL = """
    SELECT CASE WHEN event_id % 100 <> 7 THEN strftime(ts, '%Y-%m-%d') END AS date,
           event_type AS region, cast(event_id AS varchar) AS event_id,
           cast(user_id AS varchar) AS user_id,
           CASE event_id % 10 WHEN 3 THEN NULL WHEN 4 THEN NULL
                ELSE cast(floor(value) AS int) END AS count,
           cast(json_extract_string(props, '$.k') AS int) AS k,
           cast(ts AS date) AS run_date
    FROM events"""


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as CSV country reports, one snapshot per month."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        day.cast("string").alias("Date_reported"),
        F.col("o_orderstatus").alias("Country_code"),
        F.concat(F.lit("Country, "), "o_orderkey").alias("Country"),
        F.col("o_orderpriority").alias("WHO_region"),
        F.col("o_totalprice").cast("string").alias("New_cases"),
        F.col("o_custkey").cast("string").alias("Cumulative_cases"),
        F.when(F.col("o_orderkey") % 4 != 0, (F.col("o_orderkey") % 9).cast("string")).alias(
            "New_deaths"
        ),
        F.lit("x").alias("Note"),
        F.trunc(day, "month").alias("run_date"),
    )
