"""Cleaning steps, casts and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import (
    days_before,
    fraction,
    iso_date,
    months_before,
    percentage,
    week_start,
    whole_number,
)
from terrace.operators.cleaning import (
    add_metadata,
    clean,
    distinct_rows,
    drop_undated,
    normalize_columns,
)
from trial.registry import query
from trial.standins import (
    EVENTS,
    PROCESSED_AT,
    RAW_EVENTS_SQL,
    raw_events,
    table,
)


@query("""
    SELECT event_id AS event_id_, user_id AS user_id, event_type AS event_type, value AS value_eur
    FROM events""")
def normalized_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "events").select(
        F.col("event_id").alias("EVENT-ID "),
        F.col("user_id").alias("User ID"),
        F.col("event_type").alias("Event-Type"),
        F.col("value").alias("VALUE eur"),
    )
    return normalize_columns(raw)


# Texts for the integer cast, one per remainder of a row number by 14.
INT_TEXTS = (
    "abc", "", "1.5", "-2.7", " 7 ", "1e3", "12d", "NaN", "1.5abc", "3000000000",
    "-2147483648", ".5", "+8", "2147483647.9",
)


def _int_text_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(INT_TEXTS))
    return f"CASE l_partkey % {len(INT_TEXTS) + 4} {cases} ELSE cast(l_quantity AS int)::varchar END"


@query(f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, t AS raw,
           CASE WHEN regexp_full_match(t, '\\s*[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)\\s*')
                THEN try_cast(trunc(try_cast(trim(t) AS double)) AS int) END AS parsed
    FROM (SELECT *, {_int_text_sql()} AS t FROM lineitem)""")
def safe_cast_ints(spark: SparkSession, sf: str) -> DataFrame:
    texts = F.element_at(
        F.array(*(F.lit(t) for t in INT_TEXTS)), (F.col("slot") + 1).cast("int")
    )
    raw = (
        table(spark, sf, "lineitem")
        .withColumn("slot", F.col("l_partkey") % (len(INT_TEXTS) + 4))
        .withColumn(
            "raw",
            F.when(F.col("slot") < len(INT_TEXTS), texts).otherwise(
                F.col("l_quantity").cast("int").cast("string")
            ),
        )
    )
    return raw.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "raw",
        whole_number(F.col("raw")).alias("parsed"),
    )


@query("""
    SELECT o_orderkey, cast(try_strptime(t, '%Y-%m-%d') AS date) AS parsed
    FROM (SELECT o_orderkey,
                 CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y/%m/%d')
                      WHEN 1 THEN '2024-13-01' WHEN 2 THEN '2023-02-29'
                      WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS t
          FROM orders)""")
def safe_parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    slot = F.col("o_orderkey") % 6
    text = (
        F.when(slot == 0, F.date_format(day, "yyyy/MM/dd"))
        .when(slot == 1, "2024-13-01")
        .when(slot == 2, "2023-02-29")
        .when(slot > 3, day.cast("string"))
    )
    return table(spark, sf, "orders").select("o_orderkey", iso_date(text).alias("parsed"))


@query(f"SELECT * FROM ({RAW_EVENTS_SQL}) WHERE date IS NOT NULL AND event_id::int % 3 <> 0 "
       f"UNION ALL SELECT * FROM ({RAW_EVENTS_SQL}) "
       "WHERE date IS NOT NULL AND event_id::int % 3 = 0 "
       f"UNION ALL SELECT * FROM ({RAW_EVENTS_SQL}) "
       "WHERE date IS NOT NULL AND event_id::int % 3 = 0")
def null_date_filter(spark: SparkSession, sf: str) -> DataFrame:
    named = normalize_columns(raw_events(spark, sf)).withColumns(
        {"count": whole_number(F.col("count")), "k": whole_number(F.col("k"))}
    )
    return drop_undated(named, "date")


@query("""
    SELECT DISTINCT l_suppkey, l_linenumber, l_returnflag, l_linestatus,
           cast(l_shipdate AS date) AS day FROM lineitem""")
def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_rows(
        table(spark, sf, "lineitem").select(
            "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
            F.col("l_shipdate").cast("date").alias("day"),
        )
    )


@query(f"""
    SELECT o_orderkey, o_orderstatus, date '2024-01-15' AS _ingestion_date,
           'trial/orders' AS _source, '{PROCESSED_AT}' AS _processed_at FROM orders""")
def lineage_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return add_metadata(orders, "trial/orders", "2024-01-15", PROCESSED_AT)


@query(f"""
    SELECT date, region, event_id, user_id, count, k, date '2024-01-31' AS _ingestion_date,
           '{EVENTS.name}' AS _source, '{PROCESSED_AT}' AS _processed_at
    FROM ({RAW_EVENTS_SQL}) WHERE date IS NOT NULL""")
def silver_clean(spark: SparkSession, sf: str) -> DataFrame:
    """All cleaning steps in a row on text columns; a third of the events are copies."""
    raw = raw_events(spark, sf).drop("run_date")
    return clean(raw, EVENTS, "2024-01-31", PROCESSED_AT)


@query("""
    SELECT o_orderkey,
           cast(o_custkey AS double) / nullif(o_orderkey % 7, 0) AS share,
           CASE WHEN o_orderkey % 7 > 0
                THEN cast(o_custkey AS double) / (o_orderkey % 7) * 100 END AS pct
    FROM orders""")
def guarded_ratios(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.col("o_orderkey") % 7
    return table(spark, sf, "orders").select(
        "o_orderkey",
        fraction(F.col("o_custkey"), whole).alias("share"),
        percentage(F.col("o_custkey"), whole).alias("pct"),
    )


@query("""
    SELECT o_orderkey, cast(date_trunc('week', o_orderdate) AS date) AS week_start,
           strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate, '%m') AS m,
           strftime(o_orderdate, '%d') AS d,
           cast(o_orderdate AS date) - 30 AS days_back,
           cast(cast(o_orderdate AS date) - INTERVAL 3 MONTH AS date) AS months_back
    FROM orders""")
def date_functions(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    parts = F.split(day.cast("string"), "-")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        week_start(day).alias("week_start"),
        *(parts[i].alias(n) for i, n in enumerate("ymd")),
        days_before(day, 30).alias("days_back"),
        months_before(day, 3).alias("months_back"),
    )
