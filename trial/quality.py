"""Data-quality checks over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.operators.quality import (
    AllowedValues,
    NoDuplicates,
    NotNull,
    ValueRange,
    not_allowed,
    out_of_range,
    quality_report,
    summarize,
)
from trial.registry import query
from trial.standins import HOSPITALIZATIONS_SQL, hospitalizations, table

KEYS = ["date", "province", "region"]
REGIONS = ("A", "N")

# Every seventh row of the frame that is checked has no region.
HOLED_SQL = f"""
    SELECT * REPLACE (CASE WHEN total_in % 7 = 0 THEN NULL ELSE region END AS region)
    FROM ({HOSPITALIZATIONS_SQL})"""

NOT_NULL_SQL = f"""
    SELECT 'not_null_region' AS "check", 0.95::double AS threshold,
           round(count(region)::decimal(20, 10) / count(*), 4)::double AS actual,
           count(region)::double / count(*) >= 0.95 AS passed
    FROM ({HOLED_SQL})"""
DUPLICATES_SQL = f"""
    SELECT 'no_duplicates' AS "check", (SELECT count(*) FROM ({HOLED_SQL})) AS total_rows,
           count(*) AS distinct_rows,
           (SELECT count(*) FROM ({HOLED_SQL})) = count(*) AS passed
    FROM (SELECT DISTINCT date, province, region FROM ({HOLED_SQL}))"""
RANGE_SQL = f"""
    SELECT 'value_range_total_in' AS "check",
           count(*) FILTER (total_in < 5 OR total_in > 40) AS out_of_range_rows,
           count(*) FILTER (total_in < 5 OR total_in > 40) = 0 AS passed
    FROM ({HOLED_SQL})"""
ALLOWED_SQL = f"""
    SELECT 'allowed_values_region' AS "check", 2::bigint AS allowed_count,
           count(*) FILTER (region NOT IN ('A', 'N')) AS invalid_rows,
           count(*) FILTER (region NOT IN ('A', 'N')) = 0 AS passed
    FROM ({HOLED_SQL})"""


def _holed(spark: SparkSession, sf: str) -> DataFrame:
    return hospitalizations(spark, sf).withColumn(
        "region", F.when(F.col("total_in") % 7 != 0, F.col("region"))
    )


def _report(spark: SparkSession, sf: str, *checks) -> DataFrame:
    return quality_report(_holed(spark, sf), "trial/hospitalizations", checks)


@query(NOT_NULL_SQL)
def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, NotNull("region")).select(
        "check", "threshold", "actual", "passed"
    )


@query(DUPLICATES_SQL)
def check_no_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, NoDuplicates(KEYS)).select(
        "check", "total_rows", "distinct_rows", "passed"
    )


@query(RANGE_SQL)
def check_value_range(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, ValueRange("total_in", 5, 40)).select(
        "check", "out_of_range_rows", "passed"
    )


@query(ALLOWED_SQL)
def check_allowed_values(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, AllowedValues("region", REGIONS)).select(
        "check", "allowed_count", "invalid_rows", "passed"
    )


SUITE = (
    NotNull("region"),
    NotNull("date"),
    NoDuplicates(KEYS),
    ValueRange("total_in", 5, 40),
    ValueRange("total_in_icu", 0, 100),
    AllowedValues("region", REGIONS),
)


@query(f"""
    SELECT "check", passed, actual, NULL::bigint AS total_rows, NULL::bigint AS distinct_rows,
           NULL::bigint AS out_of_range_rows, NULL::bigint AS invalid_rows FROM ({NOT_NULL_SQL})
    UNION ALL
    SELECT 'not_null_date', count(date) >= 0.95 * count(*), 1.0, NULL, NULL, NULL, NULL
    FROM ({HOLED_SQL})
    UNION ALL SELECT "check", passed, NULL, total_rows, distinct_rows, NULL, NULL
    FROM ({DUPLICATES_SQL})
    UNION ALL SELECT "check", passed, NULL, NULL, NULL, out_of_range_rows, NULL
    FROM ({RANGE_SQL})
    UNION ALL SELECT 'value_range_total_in_icu', count_if(total_in_icu NOT BETWEEN 0 AND 100) = 0,
           NULL, NULL, NULL, cast(count_if(total_in_icu NOT BETWEEN 0 AND 100) AS bigint), NULL
    FROM ({HOLED_SQL})
    UNION ALL SELECT "check", passed, NULL, NULL, NULL, NULL, invalid_rows
    FROM ({ALLOWED_SQL})""")
def quality_suite(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf, *SUITE).select(
        "check", "passed", "actual", "total_rows", "distinct_rows", "out_of_range_rows",
        "invalid_rows",
    )


KEY_SETS = (("l_orderkey", "l_linenumber"), ("l_partkey", "l_suppkey", "l_returnflag"), ("l_comment_key",))


@query("""
    WITH held AS (
        SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN l_partkey END AS l_comment_key FROM lineitem
    )
    SELECT 'l_orderkey,l_linenumber' AS key_columns, count(*) AS total_rows,
           (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM held)) AS distinct_rows,
           NULL::bigint AS out_of_range_rows FROM held
    UNION ALL SELECT 'l_partkey,l_suppkey,l_returnflag', count(*),
           (SELECT count(*) FROM (SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM held)), NULL FROM held
    UNION ALL SELECT 'l_comment_key', count(*),
           (SELECT count(*) FROM (SELECT DISTINCT l_comment_key FROM held)), NULL FROM held
    UNION ALL SELECT NULL, NULL, NULL, cast(count_if(l_quantity NOT BETWEEN 2 AND 40) AS bigint) FROM held""")
def quality_suite_of_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Three checks on keys, one of them with NULLs, and one on values, from a single scan."""
    held = table(spark, sf, "lineitem").withColumn("l_comment_key", F.when(F.col("l_orderkey") % 3 == 0, F.col("l_partkey")))
    checks = [*map(NoDuplicates, KEY_SETS), ValueRange("l_quantity", 2, 40)]
    return quality_report(held, "trial/items", checks).select(
        "key_columns", "total_rows", "distinct_rows", "out_of_range_rows"
    )


@query(f"""
    SELECT 'trial/hospitalizations' AS source, 6::bigint AS checks,
           2::bigint + (SELECT passed::int FROM ({NOT_NULL_SQL}))
               + (SELECT passed::int FROM ({DUPLICATES_SQL}))
               + (SELECT passed::int FROM ({RANGE_SQL}))
               + (SELECT passed::int FROM ({ALLOWED_SQL})) AS checks_passed,
           (SELECT passed FROM ({NOT_NULL_SQL})) AND (SELECT passed FROM ({DUPLICATES_SQL}))
               AND (SELECT passed FROM ({RANGE_SQL}))
               AND (SELECT passed FROM ({ALLOWED_SQL})) AS passed""")
def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarize(_report(spark, sf, *SUITE))


@query("""
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
    WHERE o_totalprice < 50000 OR o_totalprice > 400000""")
def rows_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .where(out_of_range("o_totalprice", 50000, 400000))
        .select("o_orderkey", "o_totalprice", "o_orderstatus")
    )


@query("""
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')""")
def rows_not_allowed(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .where(not_allowed("o_orderpriority", ["1-URGENT", "2-HIGH"]))
        .select("o_orderkey", "o_orderpriority")
    )
