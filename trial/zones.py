"""Files: bronze, silver and gold zones written from the given tables and read back.

Each query works in a new directory of the shared folder the session names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import SNAPSHOT, snapshot_dir, snapshot_keys, source_dir, workspace
from terrace.operators.quality import NotNull
from terrace.operators.snapshots import expired_snapshots, keep_recent, latest_of_table, latest_only
from terrace.plans import gold, reports
from terrace.plans.silver import backfill_silver, build_silver
from terrace.registry import JSON_LINES, lookup
from terrace.sources.bronze import CORRUPT, read_bronze
from terrace.sources.catalog import create_retained_view, register_zone
from terrace.sources.files import remove_directory, snapshots_newest_first
from terrace.sources.gold import read_gold, write_gold
from terrace.sources.landing import land, landing_status, missing_sources, read_rejected
from terrace.sources.manifests import (
    manifest_entries,
    manifests,
    read_manifests,
    run_summary,
    write_manifest,
    write_manifests,
)
from terrace.sources.retention import expire_snapshots
from terrace.sources.silver import read_silver, write_silver
from terrace.streaming import process_new_snapshots
from trial.gold import COVERAGE_GOLD, HOSPITAL_GOLD, TRENDS_GOLD, rounded
from trial.registry import query
from trial.standins import (
    EVENTS,
    ORDERS,
    PROCESSED_AT,
    RAW_EVENTS_SQL,
    RAW_TEXT_SQL,
    day_text,
    global_covid,
    hospitalizations,
    raw_events,
    raw_orders,
    table,
    vaccinations,
)


RECORDS_PER_DOCUMENT = 1 << 12


def documents(
    records: DataFrame, opening: str, separator: str, closing: str, *, by: Sequence[str] = ()
) -> DataFrame:
    """Records in ``value`` joined to documents of a bounded number, apart for each value of ``by``."""
    chunk = F.shiftright(F.monotonically_increasing_id(), RECORDS_PER_DOCUMENT.bit_length() - 1)
    body = F.array_join(F.collect_list("value"), separator)
    return (
        records.withColumn("chunk", chunk)
        .groupBy(*by, "chunk")
        .agg(F.concat(F.lit(opening), body, F.lit(closing)).alias("value"))
        .select(*by, "value")
    )


def _path_columns() -> list[Column]:
    return [c.alias(n) for n, c in snapshot_keys(F.col("run_date")).items()]


def write_json_snapshots(raw: DataFrame, root: str, source: str) -> None:
    """Raw rows as multi-line JSON arrays, several records to a document, by run date."""
    columns = [c for c in raw.columns if c != "run_date"]
    records = raw.select(F.to_json(F.struct(*columns)).alias("value"), "run_date")
    (
        documents(records, "[\n", ",\n", "\n]", by=["run_date"])
        .withColumns(snapshot_keys(F.col("run_date")))
        .drop("run_date")
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .partitionBy(*SNAPSHOT)
        .text(source_dir(root, source))
    )


def write_csv_snapshots(raw: DataFrame, root: str, source: str) -> None:
    (
        raw.withColumns(snapshot_keys(F.col("run_date")))
        .drop("run_date")
        .write.mode("append")
        .option("header", "true")
        .partitionBy(*SNAPSHOT)
        .csv(source_dir(root, source))
    )


@cache
def _zone(application: str, kind: str, sf: str) -> str:
    """A place for raw files that are only read: one per session, kind and tables."""
    spark = SparkSession.active()
    bronze = workspace(spark)
    if kind == "events":
        write_json_snapshots(raw_events(spark, sf), bronze, EVENTS.name)
    else:
        write_csv_snapshots(raw_orders(spark, sf), bronze, ORDERS.name)
    return bronze


def bronze_events(spark: SparkSession, sf: str) -> str:
    """The bronze zone with all snapshots of the events, written once per session."""
    return _zone(spark.sparkContext.applicationId, "events", sf)


def bronze_orders(spark: SparkSession, sf: str) -> str:
    return _zone(spark.sparkContext.applicationId, "orders", sf)


# --- bronze -----------------------------------------------------------------


@query(RAW_TEXT_SQL)
def bronze_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_bronze(spark, EVENTS, bronze_events(spark, sf))


@query(RAW_TEXT_SQL)
def bronze_json_scan_declared(spark: SparkSession, sf: str) -> DataFrame:
    return read_bronze(spark, EVENTS, bronze_events(spark, sf), declared=True)


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS "Date_reported", o_orderstatus AS "Country_code",
           'Country, ' || o_orderkey AS "Country", o_orderpriority AS "WHO_region",
           cast(o_totalprice AS varchar) AS "New_cases",
           cast(o_custkey AS varchar) AS "Cumulative_cases",
           CASE WHEN o_orderkey % 4 <> 0 THEN cast(o_orderkey % 9 AS varchar) END AS "New_deaths",
           'x' AS "Note", year(o_orderdate)::int AS year, month(o_orderdate)::int AS month,
           1::int AS day
    FROM orders""")
def bronze_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    return read_bronze(spark, ORDERS, bronze_orders(spark, sf))


@query(f"SELECT * FROM ({RAW_TEXT_SQL}) WHERE year = 2024 AND month = 1 AND day = 15")
def snapshot_scan(spark: SparkSession, sf: str) -> DataFrame:
    """One run date out of all that lie in bronze."""
    return read_bronze(spark, EVENTS, bronze_events(spark, sf), "2024-01-15")


LINES = replace(EVENTS, name="trial/event_lines", options=JSON_LINES)
ABSENT = replace(EVENTS, name="trial/absent")


@query(f"""
    WITH events_text AS ({RAW_TEXT_SQL})
    SELECT s AS source, "DATE" AS dated, "USER-ID" AS number, "COUNT" AS cell
    FROM events_text, (VALUES ('trial/events'), ('trial/event_lines')) AS t(s)
    UNION ALL SELECT 'trial/orders', strftime(o_orderdate, '%Y-%m-%d'), cast(o_custkey AS varchar),
                     cast(o_totalprice AS varchar) FROM orders""")
def landed_files(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of JSON documents, JSON Lines and CSV after landing, beside a source that never came."""
    base = workspace(spark)
    drop, bronze = f"{base}/drop", f"{base}/bronze"
    events = raw_events(spark, sf).drop("run_date")
    record = events.select(F.to_json(F.struct("*")).alias("value"))
    arrays = documents(record, "[\n", ",\n", "\n]").write.option("maxRecordsPerFile", 1)
    arrays.text(source_dir(drop, EVENTS.name))
    record.write.text(source_dir(drop, LINES.name))
    orders = raw_orders(spark, sf).drop("run_date")
    orders.write.option("header", "true").csv(source_dir(drop, ORDERS.name))

    land(spark, [EVENTS, LINES, ORDERS, ABSENT], drop, bronze, "2024-01-31")
    rows = [
        read_bronze(spark, spec, bronze, "2024-01-31", declared=spec is not ORDERS).select(
            F.lit(spec.name).alias("source"),
            F.col(f"`{date}`").alias("dated"),
            F.col(f"`{number}`").alias("number"),
            F.col(f"`{cell}`").alias("cell"),
        )
        for spec, date, number, cell in (
            (EVENTS, "DATE", "USER-ID", "COUNT"),
            (LINES, "DATE", "USER-ID", "COUNT"),
            (ORDERS, "Date_reported", "Cumulative_cases", "New_cases"),
        )
    ]
    return reduce(DataFrame.unionByName, rows)


@query("""
    SELECT CASE WHEN event_id % 7 <> 0 THEN event_type END AS region,
           CASE WHEN event_id % 7 <> 0 THEN cast(event_id AS varchar) END AS event_id,
           CASE WHEN event_id % 7 = 0 THEN '{"EVENT-ID": "' || event_id END AS broken
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 3 = 0)""")
def bronze_corrupt_records(spark: SparkSession, sf: str) -> DataFrame:
    """JSON Lines of which every seventh id breaks off; its text is kept."""
    bronze = workspace(spark)
    number = F.col("`EVENT-ID`")
    broken = F.concat(F.lit('{"EVENT-ID": "'), number)
    record = F.when(number % 7 == 0, broken).otherwise(F.to_json(F.struct("REGION", "EVENT-ID")))
    lines = raw_events(spark, sf).select(record.alias("value"), *_path_columns())
    lines.write.partitionBy(*SNAPSHOT).text(source_dir(bronze, LINES.name))
    read = read_bronze(spark, LINES, bronze, declared=True, corrupt=True)
    return read.select(
        F.col("REGION").alias("region"), number.alias("event_id"), F.col(CORRUPT).alias("broken")
    )


@query("""
    SELECT 'bronze' AS zone, cast(event_id AS varchar) AS record, NULL AS reason, count(*) AS copies
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 3 = 0)
    WHERE event_id % 7 <> 0 GROUP BY event_id
    UNION ALL
    SELECT 'rejected', CASE event_id % 2 WHEN 0 THEN '{"EVENT-ID": ' || event_id || ' 0}' ELSE '"' || event_id || '"' END,
           CASE event_id % 2 WHEN 0 THEN 'not valid JSON' ELSE 'not an object' END, count(*)
    FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 3 = 0)
    WHERE event_id % 7 = 0 GROUP BY event_id""")
def landing_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a broken or odd element for every seventh id: those lie apart, the others in bronze."""
    base = workspace(spark)
    drop, bronze = f"{base}/drop", f"{base}/bronze"
    number = F.col("`EVENT-ID`")
    odd = F.concat(F.lit('"'), number, F.lit('"'))
    broken = F.concat(F.lit('{"EVENT-ID": '), number, F.lit(" 0}"))
    record = F.when(number % 14 == 0, broken).when(number % 7 == 0, odd).otherwise(F.to_json(F.struct("EVENT-ID")))
    arrays = documents(raw_events(spark, sf).select(record.alias("value")), "[\n", ",\n", "\n]")
    arrays.write.option("maxRecordsPerFile", 1).text(source_dir(drop, EVENTS.name))
    land(spark, [EVENTS], drop, bronze, "2024-01-31")
    good = read_bronze(spark, EVENTS, bronze, "2024-01-31").select(
        F.lit("bronze").alias("zone"), number.alias("record"), F.lit(None).cast("string").alias("reason")
    )
    bad = read_rejected(spark, bronze, EVENTS.name).select(F.lit("rejected").alias("zone"), "record", "reason")
    return good.unionByName(bad).groupBy("zone", "record", "reason").agg(F.count(F.lit(1)).alias("copies"))


# --- run records ------------------------------------------------------------


@query("""
    SELECT c_custkey AS source, CASE WHEN n IS NULL THEN 'failed' ELSE 'success' END AS status,
           CASE WHEN n IS NULL THEN 'nothing landed' END AS error,
           coalesce(n, 0) AS landed_rows
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
         ON o_custkey = c_custkey""")
def landing_status_by_source(spark: SparkSession, sf: str) -> DataFrame:
    expected = table(spark, sf, "customer").select(F.col("c_custkey").alias("source"))
    landed = table(spark, sf, "orders").select(F.col("o_custkey").alias("source"))
    return landing_status(expected, landed, "source")


@query("""
    SELECT c_custkey AS source FROM customer
    WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def sources_without_data(spark: SparkSession, sf: str) -> DataFrame:
    expected = table(spark, sf, "customer").select(F.col("c_custkey").alias("source"))
    landed = table(spark, sf, "events").select(F.col("user_id").alias("source"))
    return missing_sources(expected, landed, "source")


def _run_results(spark: SparkSession, sf: str) -> DataFrame:
    """A landing outcome per day and event type: failed if every value was small."""
    failed = F.max("value") < 200
    key = F.concat_ws("/", "run_date", "source")
    return (
        table(spark, sf, "events")
        .groupBy(day_text("ts").alias("run_date"), F.col("event_type").alias("source"))
        .agg(F.when(failed, "failed").otherwise("success").alias("status"))
        .select(
            "run_date",
            F.concat("run_date", F.lit("T02:00:00")).alias("run_timestamp"),
            F.lit("trial").alias("env"),
            "source",
            "status",
            F.when(F.col("status") == "success", key).alias("key"),
            F.when(F.col("status") == "failed", "values too small").alias("error"),
        )
    )


RUN_RESULTS_SQL = """
    SELECT run_date, run_date || 'T02:00:00' AS run_timestamp, 'trial' AS env, source, status,
           CASE WHEN status = 'success' THEN run_date || '/' || source END AS key,
           CASE WHEN status = 'failed' THEN 'values too small' END AS error
    FROM (SELECT strftime(ts, '%Y-%m-%d') AS run_date, event_type AS source,
                 CASE WHEN max(value) < 200 THEN 'failed' ELSE 'success' END AS status
          FROM events GROUP BY ALL)"""


@query(RUN_RESULTS_SQL)
def manifest_scan(spark: SparkSession, sf: str) -> DataFrame:
    bronze = workspace(spark)
    write_manifests(manifests(_run_results(spark, sf)), bronze)
    return manifest_entries(read_manifests(spark, bronze))


@query(f"""
    SELECT run_date, cast(count_if(status = 'success') AS bigint) AS succeeded,
           count(*) AS sources FROM ({RUN_RESULTS_SQL}) GROUP BY run_date""")
def manifest_summary(spark: SparkSession, sf: str) -> DataFrame:
    bronze = workspace(spark)
    write_manifests(manifests(_run_results(spark, sf)), bronze)
    return run_summary(manifest_entries(read_manifests(spark, bronze)))


@query("""
    SELECT '2024-01-31' AS run_date, '2024-01-31T02:00:00' AS run_timestamp, 'dev' AS env,
           'type/' || event_type AS source,
           CASE WHEN max(value) < 100 THEN 'failed' ELSE 'success' END AS status,
           CASE WHEN max(value) >= 100 THEN 'events/' || count(*) END AS key,
           CASE WHEN max(value) < 100 THEN 'values too small' END AS error
    FROM events GROUP BY event_type""")
def manifest_of_one_run(spark: SparkSession, sf: str) -> DataFrame:
    """One run with a source per type of event, over all events."""
    bronze = workspace(spark)
    small = F.max("value") < 100
    results = (
        table(spark, sf, "events")
        .groupBy(F.concat(F.lit("type/"), "event_type").alias("source"))
        .agg(
            F.when(small, "failed").otherwise("success").alias("status"),
            F.when(~small, F.concat(F.lit("events/"), F.count(F.lit(1)))).alias("key"),
            F.when(small, "values too small").alias("error"),
        )
    )
    write_manifest(results, bronze, "2024-01-31", "2024-01-31T02:00:00")
    return manifest_entries(read_manifests(spark, bronze))


# --- silver -----------------------------------------------------------------

SILVER_SQL = f"""
    SELECT date, region, event_id, user_id, count, k, run_date AS _ingestion_date,
           '{EVENTS.name}' AS _source, '{PROCESSED_AT}' AS _processed_at,
           year(run_date)::int AS year, month(run_date)::int AS month, day(run_date)::int AS day
    FROM ({RAW_EVENTS_SQL}) WHERE date IS NOT NULL"""


def _silver(spark: SparkSession, sf: str) -> str:
    """All snapshots of the events cleaned; the path of the silver zone.

    The files hold registered fields only, so one pass over them will do.
    """
    silver, bronze = workspace(spark), bronze_events(spark, sf)
    backfill_silver(spark, EVENTS, bronze, silver, PROCESSED_AT, declared=True)
    return silver


@query(SILVER_SQL)
def silver_all_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return read_silver(spark, _silver(spark, sf), EVENTS.name, "all")


@query(f"SELECT * FROM ({SILVER_SQL}) WHERE (year, month, day) = "
       f"(SELECT max((year, month, day)) FROM ({SILVER_SQL}))")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return read_silver(spark, _silver(spark, sf), EVENTS.name)


@query(f"SELECT * FROM ({SILVER_SQL}) WHERE (year, month, day) = "
       f"(SELECT max((year, month, day)) FROM ({SILVER_SQL}))")
def latest_of_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """The newest snapshot of a registered table, found in the catalog alone."""
    silver = _silver(spark, sf)
    database = f"trial_{silver.rsplit('/', 1)[-1]}"
    register_zone(spark, database, silver, database_location=f"{silver}/_database")
    newest = latest_of_table(spark, f"{database}.events")
    return newest.withColumns({c: F.col(c).cast("int") for c in SNAPSHOT})


@query(f"SELECT * FROM ({SILVER_SQL}) WHERE (year, month, day) = (2024, 1, 20)")
def silver_of_one_date(spark: SparkSession, sf: str) -> DataFrame:
    return read_silver(spark, _silver(spark, sf), EVENTS.name, "2024-01-20")


@query(f"SELECT * FROM ({SILVER_SQL}) WHERE _ingestion_date >= date '2024-01-30' - 10")
def silver_retained(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots within retention, by the partition columns of the files."""
    silver = read_silver(spark, _silver(spark, sf), EVENTS.name, "all")
    return keep_recent(silver, "2024-01-30", 10)


@query(f"""
    SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS date_reported,
           o_orderstatus AS country_code, 'Country, ' || o_orderkey AS country,
           o_orderpriority AS who_region, cast(trunc(o_totalprice) AS int) AS new_cases,
           cast(o_custkey AS int) AS cumulative_cases,
           CASE WHEN o_orderkey % 4 <> 0 THEN cast(o_orderkey % 9 AS int) END AS new_deaths,
           'x' AS note, cast(date_trunc('month', o_orderdate) AS date) AS _ingestion_date,
           'who/global_covid' AS _source, '{PROCESSED_AT}' AS _processed_at,
           year(o_orderdate)::int AS year, month(o_orderdate)::int AS month, 1::int AS day
    FROM orders""")
def silver_csv_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """CSV snapshots of a registered source, looked up by name and cleaned."""
    base = workspace(spark)
    spec = lookup("who/global_covid")
    write_csv_snapshots(raw_orders(spark, sf), f"{base}/bronze", spec.name)
    backfill_silver(spark, spec.name, f"{base}/bronze", f"{base}/silver", PROCESSED_AT)
    return read_silver(spark, f"{base}/silver", spec.name, "all")


@query(f"""
    SELECT s.* EXCLUDE (count, k), count, k,
           CASE WHEN event_id::int % 5 = 0 THEN 'n' || event_id END AS note,
           CASE WHEN event_id::int % 2 = 0 THEN cast(year AS varchar) END AS raw_year,
           CASE WHEN event_id::int % 5 = 0 THEN '{{"id":' || event_id || '}}' END AS nested
    FROM ({SILVER_SQL}) s""")
def silver_unregistered_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with fields no one registered, one of them called like a part of the snapshot's date."""
    base = workspace(spark)
    number = F.col("`EVENT-ID`").cast("int")
    raw = raw_events(spark, sf).withColumns({
        "Note": F.when(number % 5 == 0, F.concat(F.lit("n"), "`EVENT-ID`")),
        "YEAR": F.when(number % 2 == 0, F.year("run_date")),
        "Nested": F.when(number % 5 == 0, F.struct(number.alias("id"))),
    })
    write_json_snapshots(raw, f"{base}/bronze", EVENTS.name)
    backfill_silver(spark, EVENTS, f"{base}/bronze", f"{base}/silver", PROCESSED_AT)
    return read_silver(spark, f"{base}/silver", EVENTS.name, "all")


@query("""
    SELECT o_orderkey, o_totalprice, year(o_orderdate)::int AS year,
           month(o_orderdate)::int AS month, day(o_orderdate)::int AS day
    FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def newest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return latest_only(_dated_orders(spark, sf))


def _dated_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_totalprice",
        *(f("o_orderdate").alias(n) for n, f in zip(SNAPSHOT, (F.year, F.month, F.day))),
    )


@query("""
    SELECT o_orderkey, o_totalprice, year(o_orderdate)::int AS year,
           month(o_orderdate)::int AS month, day(o_orderdate)::int AS day
    FROM orders WHERE cast(o_orderdate AS date) >= date '2000-12-31' - 365""")
def retention_keep(spark: SparkSession, sf: str) -> DataFrame:
    return keep_recent(_dated_orders(spark, sf), "2000-12-31", 365)


@query("""
    SELECT DISTINCT year(o_orderdate)::int AS year, month(o_orderdate)::int AS month,
           day(o_orderdate)::int AS day
    FROM orders WHERE cast(o_orderdate AS date) < date '2000-12-31' - 365""")
def retention_expired(spark: SparkSession, sf: str) -> DataFrame:
    return expired_snapshots(_dated_orders(spark, sf), "2000-12-31", 365)


@query(f"""
    SELECT 'removed' AS status, run_date AS snapshot, 0::bigint AS records FROM ({RAW_EVENTS_SQL})
    WHERE run_date < date '2024-01-30' - 15 GROUP BY run_date
    UNION ALL
    SELECT CASE WHEN _ingestion_date < date '2024-01-30' - 10 THEN 'in grace' ELSE 'kept' END, _ingestion_date, count(*)
    FROM ({SILVER_SQL}) WHERE _ingestion_date >= date '2024-01-30' - 15 GROUP BY ALL""")
def retention_applied(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots removed from silver, those about to go, and the rows that are left."""
    silver = _silver(spark, sf)
    done = expire_snapshots(spark, silver, [EVENTS.name], "2024-01-30", days=10, grace_days=5, dry_run=False)
    left = read_silver(spark, silver, EVENTS.name, "all").groupBy(F.col("_ingestion_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return done.join(left, F.col("snapshot") == F.col("day"), "left").select(
        "status", "snapshot", F.coalesce("n", F.lit(0).cast("bigint")).alias("records")
    )


@query(f"SELECT * FROM ({SILVER_SQL}) WHERE _ingestion_date >= date '2024-01-20'")
def retained_view(spark: SparkSession, sf: str) -> DataFrame:
    """The view of a registered silver table that moves with the day, set to reach back to one."""
    silver = _silver(spark, sf)
    database = f"trial_{silver.rsplit('/', 1)[-1]}"
    register_zone(spark, database, silver, database_location=f"{silver}/_database")
    reach = (dt.date.today() - dt.date(2024, 1, 20)).days
    create_retained_view(spark, f"{database}.recent", f"{database}.events", reach)
    text = {c: F.col(c).cast("int") for c in SNAPSHOT}
    return spark.table(f"{database}.recent").withColumns(text)


@query(f"""
    SELECT '{EVENTS.name}' AS source, (SELECT count(*) FROM ({RAW_TEXT_SQL})) AS rows_read,
           (SELECT count(*) FROM ({SILVER_SQL})) AS rows_written""")
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows read and written by the cleaning of all snapshots, as counted by that job."""
    bronze = bronze_events(spark, sf)
    run = backfill_silver(
        spark, EVENTS, bronze, workspace(spark), PROCESSED_AT, declared=True
    )
    return spark.createDataFrame(
        [(run.source, run.rows_read, run.rows_written)],
        "source string, rows_read bigint, rows_written bigint",
    )


@query(f"""
    SELECT * FROM ({SILVER_SQL})
    WHERE (year, month, day) = (SELECT max((year, month, day)) FROM ({SILVER_SQL}))""")
def silver_daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """The newest raw snapshot cleaned and written on its own, as a daily run does."""
    bronze, silver = bronze_events(spark, sf), workspace(spark)
    newest = next(snapshots_newest_first(spark, source_dir(bronze, EVENTS.name)))
    build_silver(spark, EVENTS, newest, bronze, silver, PROCESSED_AT)
    return read_silver(spark, silver, EVENTS.name)


@query(f"""
    SELECT * FROM ({SILVER_SQL})
    WHERE NOT (_ingestion_date = date '2024-01-10' AND region = 'click')""")
def incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Landings with a run after each: late files for old days, then one written anew and one taken away."""
    base = workspace(spark)
    bronze, silver = f"{base}/bronze", f"{base}/silver"
    raw = raw_events(spark, sf)
    early = (F.col("run_date") < "2024-01-16") & (F.col("REGION") != "error")

    def run() -> None:
        process_new_snapshots(spark, EVENTS, bronze, silver, f"{base}/checkpoint", PROCESSED_AT, declared=True)

    # The rows that will go, and those of a file with other content at first.
    day = F.col("run_date") == "2024-01-10"
    gone = snapshot_dir(bronze, f"{EVENTS.name}", "2024-01-10") + "/gone.json"
    again = snapshot_dir(bronze, EVENTS.name, "2024-01-11") + "/again.json"
    other = F.col("run_date") == "2024-01-11"
    write_json_snapshots(raw.where(early & ~(day & (F.col("REGION") == "click")) & ~other), bronze, EVENTS.name)
    write_file(raw.where(day & (F.col("REGION") == "click")), gone)
    write_file(raw.where(other).withColumn("COUNT", F.lit("0")), again)
    run()
    write_json_snapshots(raw.where(~early & ~(day & (F.col("REGION") == "click")) & ~other), bronze, EVENTS.name)
    run()
    remove_directory(spark, gone)
    remove_directory(spark, again)
    write_file(raw.where(other), again)
    run()
    return read_silver(spark, silver, EVENTS.name, "all")


def write_file(raw: DataFrame, path: str) -> None:
    """The rows as one JSON array in a directory that is named like a file."""
    records = raw.select(F.to_json(F.struct(*[c for c in raw.columns if c != "run_date"])).alias("value"))
    documents(records, "[\n", ",\n", "\n]").write.option("maxRecordsPerFile", 1).text(path)


# --- gold -------------------------------------------------------------------


@query(TRENDS_GOLD)
def gold_written(spark: SparkSession, sf: str) -> DataFrame:
    root = workspace(spark)
    write_gold(gold.global_trends(global_covid(spark, sf), PROCESSED_AT), root, "trends")
    return read_gold(spark, root, "trends")


@query(f"""
    SELECT * REPLACE (CASE WHEN region = 'click' THEN doses_administered * 10
                           ELSE doses_administered END AS doses_administered)
    FROM ({COVERAGE_GOLD})""")
def gold_regions_replaced(spark: SparkSession, sf: str) -> DataFrame:
    """One region of a gold table replaced; the others keep their files."""
    root = workspace(spark)
    coverage = gold.vaccination_coverage(vaccinations(spark, sf), PROCESSED_AT)
    write_gold(coverage, root, "coverage")
    tenfold = F.col("doses_administered") * 10
    click = coverage.where("region = 'click'").withColumn("doses_administered", tenfold)
    write_gold(click, root, "coverage", replace="regions")
    return read_gold(spark, root, "coverage")


@query(f"""
    SELECT 'be_hospitalizations_summary' AS gold, date AS day, region, NULL AS part, new_admissions::bigint AS number,
           total_hospitalized::bigint AS other FROM ({HOSPITAL_GOLD})
    UNION ALL SELECT 'be_vaccination_coverage', date, region, agegroup || ' ' || dose, doses_administered::bigint,
           cumulative_doses::bigint FROM ({COVERAGE_GOLD})
    UNION ALL SELECT 'who_global_trends', date_reported, region, country_code, new_cases::bigint, cumulative_cases::bigint
    FROM ({TRENDS_GOLD})""")
def gold_build_all(spark: SparkSession, sf: str) -> DataFrame:
    """The three gold tables from a silver zone that passes its checks, read by name."""
    base = workspace(spark)
    makers = dict(zip(gold.GOLD_TABLES, (hospitalizations, vaccinations, global_covid)))
    for one, make in makers.items():
        write_silver(make(spark, sf), f"{base}/silver", one.source, "2024-01-31")
    suites = {t.source: [NotNull(d)] for t, d in zip(makers, ("date", "date", "date_reported"))}
    gold.build_gold(spark, f"{base}/silver", f"{base}/gold", PROCESSED_AT, suites=suites)
    database = f"trial_{base.rsplit('/', 1)[-1]}"
    register_zone(spark, database, f"{base}/gold", database_location=f"{base}/_database")
    shown = (
        ("date", F.lit(None).cast("string"), "new_admissions", "total_hospitalized"),
        ("date", F.concat_ws(" ", "agegroup", "dose"), "doses_administered", "cumulative_doses"),
        ("date_reported", F.col("country_code"), "new_cases", "cumulative_cases"),
    )
    rows = [
        spark.table(f"{database}.{t.name}").select(
            F.lit(t.name).alias("gold"), F.col(day).alias("day"), "region", part.alias("part"),
            F.col(number).cast("bigint").alias("number"), F.col(other).cast("bigint").alias("other"),
        )
        for t, (day, part, number, other) in zip(makers, shown)
    ]
    return reduce(DataFrame.unionByName, rows)


@query(f"""
    SELECT 'whole' AS step, region, sum(doses_administered)::bigint AS doses FROM ({COVERAGE_GOLD}) GROUP BY region
    UNION ALL SELECT 'region', region, sum(CASE WHEN region = 'click' THEN 10 ELSE 1 END * doses_administered)::bigint
    FROM ({COVERAGE_GOLD}) GROUP BY region
    UNION ALL SELECT 'fewer', region, sum(doses_administered)::bigint
    FROM ({COVERAGE_GOLD}) WHERE region <> 'view' GROUP BY region""")
def gold_replaced_in_one_step(spark: SparkSession, sf: str) -> DataFrame:
    """A table with versions, as it was after each of three replacements; readers keep what they have begun with."""
    root = workspace(spark)
    coverage = gold.vaccination_coverage(vaccinations(spark, sf), PROCESSED_AT)
    seen = []

    def note(step: str) -> None:
        by_region = read_gold(spark, root, "coverage").groupBy("region").agg(F.sum("doses_administered").cast("bigint").alias("doses"))
        found = workspace(spark)
        by_region.select(F.lit(step).alias("step"), "region", "doses").write.parquet(found)
        seen.append(spark.read.parquet(found))

    write_gold(coverage, root, "coverage", versioned=True)
    note("whole")
    click = coverage.where("region = 'click'").withColumn("doses_administered", F.col("doses_administered") * 10)
    write_gold(click, root, "coverage", replace="regions")
    note("region")
    write_gold(coverage.where("region <> 'view'"), root, "coverage")
    note("fewer")
    return reduce(DataFrame.unionByName, seen)


@query("""
    SELECT 'before' AS run, 't' AS name, o_orderkey::bigint AS id, o_totalprice::varchar AS price, NULL AS note FROM orders
    UNION ALL SELECT 'after', 't', o_orderkey::bigint, (o_totalprice * 2)::varchar, o_orderstatus FROM orders""")
def registered_twice(spark: SparkSession, sf: str) -> DataFrame:
    """A zone registered by an odd spelling of its root, before and after a column has changed its type."""
    root = workspace(spark)
    database = f"trial_{root.rsplit('/', 1)[-1]}"
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("bigint").alias("id"), F.col("o_totalprice").alias("price"), "o_orderstatus")
    seen = []
    texts = (orders.select("id", "price"), orders.select("id", (F.col("price") * 2).cast("string").alias("price"), F.col("o_orderstatus").alias("note")))
    for run, rows in zip(("before", "after"), texts):
        rows.write.mode("overwrite").parquet(f"{root}/zone/t")
        register_zone(spark, database, f"{root}//zone/", database_location=f"{root}/_database")
        found, at = spark.table(f"{database}.t"), workspace(spark)
        note = F.col("note") if "note" in found.columns else F.lit(None).cast("string")
        found.select(F.lit(run).alias("run"), F.lit("t").alias("name"), "id", F.col("price").cast("string").alias("price"), note.alias("note")).write.parquet(at)
        seen.append(spark.read.parquet(at))
    return reduce(DataFrame.unionByName, seen)


@query(f"""
    SELECT date, region, total_hospitalized, total_icu,
           {rounded("icu_rate * 100", 2)} AS icu_rate_pct,
           {rounded('"7day_avg_admissions"', 1)} AS avg_daily_admissions_7d
    FROM ({HOSPITAL_GOLD}) WHERE date >= date '1997-03-01' - 30""")
def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A report over gold tables found in a zone and read by name from the catalog."""
    root = workspace(spark)
    database = f"trial_{root.rsplit('/', 1)[-1]}"
    summary = gold.hospitalizations_summary(hospitalizations(spark, sf), PROCESSED_AT)
    write_gold(summary, root, "be_hospitalizations_summary")
    register_zone(spark, database, root, database_location=f"{root}/_database")
    registered = spark.table(f"{database}.be_hospitalizations_summary")
    return reports.icu_trend(registered, as_of="1997-03-01")
