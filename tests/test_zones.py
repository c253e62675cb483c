import datetime as dt
import json
import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from terrace import lookup
from terrace.layout import snapshot_dir, workspace
from terrace.operators.snapshots import (
    drop_expired_partitions,
    expired_snapshots,
    keep_recent,
    latest_only,
)
from terrace.plans.checks import SUITES, QualityFailure, require
from terrace.plans.gold import GOLD_TABLES, build_gold
from terrace.plans.reports import coverage_by_group
from terrace.plans.silver import backfill_silver, build_silver
from terrace.registry import JSON_LINES, fields
from terrace.sources.bronze import read_bronze
from terrace.sources.catalog import create_retained_view, discover_tables, register_zone
from terrace.sources.gold import read_gold, write_gold
from terrace.sources.silver import read_silver, write_silver

HOSPITAL, VACCINATION, WORLD = (
    "sciensano/covid_hospitalizations",
    "sciensano/covid_vaccinations",
    "who/global_covid",
)
NOW = "2024-02-01T00:00:00"


def put(root, source, run_date, name, content):
    folder = snapshot_dir(str(root), source, run_date)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
        out.write(content)


def hospital(date="2024-01-15", province="Namur", region="Wallonia", **more):
    record = {
        "DATE": date, "PROVINCE": province, "REGION": region, "NR_REPORTING": 9, "TOTAL_IN": 64,
        "TOTAL_IN_ICU": 7, "TOTAL_IN_RESP": 4, "TOTAL_IN_ECMO": 0, "NEW_IN": 6, "NEW_OUT": 5,
    }
    return {k: v for k, v in {**record, **more}.items() if v != "absent"}


def put_hospital(root, run_date, *records, name="data.json", indent=None):
    text = json.dumps(records, ensure_ascii=False, indent=indent)
    put(root, HOSPITAL, run_date, name, text)


WORLD_CSV = (
    "Date_reported,Country_code,Country,WHO_region,"
    "New_cases,Cumulative_cases,New_deaths,Cumulative_deaths\n"
    "2024-01-15,PT,Portugal,EURO,41,812000,3,4060\n"
    "2024-01-15,LU,Luxembourg,EURO,,0,0,0\n"
)


# --- bronze -----------------------------------------------------------------


@pytest.mark.parametrize("indent", [None, 2])
def test_json_document_on_one_line_or_many(spark, tmp_path, indent):
    put_hospital(tmp_path, "2024-01-15", hospital(province="Liège"), hospital(), indent=indent)
    rows = read_bronze(spark, lookup(HOSPITAL), str(tmp_path), "2024-01-15")
    assert {t for c, t in rows.dtypes if c not in ("year", "month", "day")} == {"string"}
    assert sorted(r["PROVINCE"] for r in rows.collect()) == ["Liège", "Namur"]
    assert rows.select("year", "month", "day").distinct().collect() == [(2024, 1, 15)]


def test_mixed_values_stay_as_they_are(spark, tmp_path):
    put_hospital(tmp_path, "2024-01-15", hospital(NEW_IN="<5"), hospital(NEW_IN="8"),
                 hospital(NEW_IN=2.7), hospital(NEW_IN=None))
    rows = read_bronze(spark, lookup(HOSPITAL), str(tmp_path), "2024-01-15")
    assert sorted(str(r["NEW_IN"]) for r in rows.collect()) == ["2.7", "8", "<5", "None"]


def test_found_and_declared_columns(spark, tmp_path):
    put_hospital(tmp_path, "2024-01-15", hospital(NOTE="x", NEW_OUT="absent"))
    spec = lookup(HOSPITAL)
    found = read_bronze(spark, spec, str(tmp_path), "2024-01-15").columns
    assert "NOTE" in found and "NEW_OUT" not in found
    declared = read_bronze(spark, spec, str(tmp_path), "2024-01-15", declared=True)
    assert "NOTE" not in declared.columns and declared.first()["NEW_OUT"] is None


def test_broken_documents_are_kept_apart(spark, tmp_path):
    put_hospital(tmp_path, "2024-01-15", hospital())
    put(tmp_path, HOSPITAL, "2024-01-15", "broken.json", '[{"DATE": "2024-01-1')
    rows = read_bronze(
        spark, lookup(HOSPITAL), str(tmp_path), "2024-01-15", declared=True, corrupt=True
    )
    assert sorted((r["DATE"], r["_corrupt_record"]) for r in rows.collect() if r["DATE"]) == [
        ("2024-01-15", None)
    ]
    assert [r["_corrupt_record"] for r in rows.collect() if not r["DATE"]] == [
        '[{"DATE": "2024-01-1'
    ]


def test_csv_is_all_text_with_empty_as_null(spark, tmp_path):
    put(tmp_path, WORLD, "2024-01-15", "data.csv", WORLD_CSV)
    rows = read_bronze(spark, lookup(WORLD), str(tmp_path), "2024-01-15")
    got = {r["Country_code"]: r["New_cases"] for r in rows.collect()}
    assert got == {"PT": "41", "LU": None}


def test_csv_with_few_columns(spark, tmp_path):
    put(tmp_path, WORLD, "2024-01-15", "data.csv", "Date_reported,Country\n2024-01-15,Belgium\n")
    run = build_silver(spark, WORLD, "2024-01-15", str(tmp_path), str(tmp_path / "s"), NOW)
    assert (run.rows_read, run.rows_written) == (1, 1)
    silver = read_silver(spark, str(tmp_path / "s"), WORLD)
    assert silver.columns[:2] == ["date_reported", "country"] and "new_cases" not in silver.columns


def test_csv_headers_may_change_between_snapshots(spark, tmp_path):
    put(tmp_path, WORLD, "2024-01-15", "a.csv", "Date_reported,Country,New_cases\n2024-01-15,B,1\n")
    put(tmp_path, WORLD, "2024-01-16", "a.csv", "New_cases,Date_reported,Note\n2,2024-01-16,n\n")
    put(tmp_path, WORLD, "2024-01-17", "a.csv", "Date_reported,Country,New_cases\n2024-01-17,L,3\n")
    spec = lookup(WORLD)
    rows = read_bronze(spark, spec, str(tmp_path))
    columns = ["day", "Date_reported", "Country", "New_cases", "Note"]
    assert sorted(tuple(r) for r in rows.select(columns).collect()) == [
        (15, "2024-01-15", "B", "1", None),
        (16, "2024-01-16", None, "2", "n"),
        (17, "2024-01-17", "L", "3", None),
    ]
    declared = read_bronze(spark, spec, str(tmp_path), declared=True, corrupt=True)
    assert declared.columns == [*spec.schema.names, "_corrupt_record", "year", "month", "day"]
    assert sorted(r["New_cases"] for r in declared.collect()) == ["1", "2", "3"]
    run = backfill_silver(spark, WORLD, str(tmp_path), str(tmp_path / "s"), NOW)
    assert (run.rows_read, run.rows_written) == (3, 3)


def test_csv_snapshots_without_a_header_have_no_rows(spark, tmp_path):
    put(tmp_path, WORLD, "2024-01-15", "a.csv", "")
    put(tmp_path, WORLD, "2024-01-16", "a.csv", "Date_reported,Country\n2024-01-16,B\n")
    put(tmp_path, WORLD, "2024-01-17", "_SUCCESS", "")
    spec = lookup(WORLD)
    assert [r["day"] for r in read_bronze(spark, spec, str(tmp_path)).collect()] == [16]
    with pytest.raises(FileNotFoundError, match="who/global_covid"):
        read_bronze(spark, spec, str(tmp_path), "2024-01-15")


def test_csv_headers_that_differ_within_a_snapshot_are_an_error(spark, tmp_path):
    put(tmp_path, WORLD, "2024-01-15", "a.csv", "Date_reported,Country\n2024-01-15,B\n")
    put(tmp_path, WORLD, "2024-01-15", "b.csv", "Country,Date_reported\nB,2024-01-15\n")
    with pytest.raises(Exception, match="header"):
        read_bronze(spark, lookup(WORLD), str(tmp_path), "2024-01-15").collect()


def test_one_run_date_reads_only_its_directory(spark, tmp_path):
    put_hospital(tmp_path, "2024-01-15", hospital())
    put_hospital(tmp_path, "2024-01-16", hospital(), hospital(province="x"))
    spec = lookup(HOSPITAL)
    one = read_bronze(spark, spec, str(tmp_path), "2024-01-15", declared=True)
    assert one.count() == 1
    assert all("day=15" in f for f in one.inputFiles())
    found = read_bronze(spark, spec, str(tmp_path), "2024-01-15")
    assert [r["day"] for r in found.collect()] == [15]
    assert read_bronze(spark, spec, str(tmp_path)).count() == 3
    assert read_bronze(spark, spec, str(tmp_path), ["2024-01-15", "2024-01-16"]).count() == 3


def test_json_fields_come_from_one_pass_over_the_files(spark, tmp_path):
    """Names, values and counts do not need the raw files a second time."""
    put_hospital(tmp_path, "2024-01-15", hospital(NOTE="n", YEAR=1999, Day="x"), hospital(province="p", more={"a": [1, "b"]}))
    put_hospital(tmp_path, "2024-01-16", hospital(NOTE=None, flag=True))
    spec = lookup(HOSPITAL)
    rows = read_bronze(spark, spec, str(tmp_path))
    shutil.rmtree(tmp_path / HOSPITAL)
    assert {"NOTE", "raw_YEAR", "raw_Day", "more", "flag", "DATE", "year", "month", "day"} <= set(rows.columns)
    assert dict(rows.drop("year", "month", "day").dtypes).keys() and all(
        t == "string" for n, t in rows.dtypes if n not in ("year", "month", "day")
    )
    got = {(r["day"], r["NOTE"], r["raw_YEAR"], r["raw_Day"], r["more"], r["flag"]) for r in rows.collect()}
    assert got == {(15, "n", "1999", "x", None, None), (15, None, None, None, '{"a":[1,"b"]}', None), (16, None, None, None, None, "true")}


def test_raw_fields_named_like_a_snapshot_reach_silver(spark, tmp_path):
    put_hospital(tmp_path, "2024-01-15", hospital(YEAR=1999, extra="e"), hospital(YEAR=1999, extra="e"))
    put(tmp_path, WORLD, "2024-01-15", "a.csv", "Date_reported,New_cases,Year,month\n2024-01-15,2,1998,m\n")
    for source, names in ((HOSPITAL, ("extra", "raw_year")), (WORLD, ("raw_year", "raw_month"))):
        build_silver(spark, source, "2024-01-15", str(tmp_path), str(tmp_path / "s"), NOW)
        row = read_silver(spark, str(tmp_path / "s"), source).first()
        assert (row["year"], row["month"], row["day"]) == (2024, 1, 15)
        assert tuple(row[n] for n in names) == (("e", "1999") if source == HOSPITAL else ("1998", "m"))
    spec = replace(lookup(HOSPITAL), schema=fields(text="DATE", whole="YEAR"))
    rows = read_bronze(spark, spec, str(tmp_path), "2024-01-15", declared=True, corrupt=True)
    assert rows.columns == ["DATE", "raw_YEAR", "_corrupt_record", "year", "month", "day"]
    assert {tuple(r) for r in rows.collect()} == {(hospital()["DATE"], "1999", None, 2024, 1, 15)}
    assert spec.silver_types["raw_year"].simpleString() == "int"


def test_json_lines_with_arrays_blank_and_broken_lines(spark, tmp_path):
    spec = replace(lookup(HOSPITAL), options=JSON_LINES)
    text = '{"DATE": "a", "N": 1.50}\n\n[{"DATE": "b"}, {"DATE": "c", "X": "y"}]\n{"DATE": "d"\n  \n[]\n'
    put(tmp_path, HOSPITAL, "2024-01-15", "a.json", text)
    rows = read_bronze(spark, spec, str(tmp_path))
    assert rows.columns == ["DATE", "N", "X", "_corrupt_record", "year", "month", "day"]
    got = {(r["DATE"], r["X"], r["_corrupt_record"]) for r in rows.collect()}
    assert got == {("a", None, None), ("b", None, None), ("c", "y", None), (None, None, '{"DATE": "d"')}
    put(tmp_path, HOSPITAL, "2024-01-16", "a.json", "")
    assert read_bronze(spark, spec, str(tmp_path), "2024-01-16").columns == ["year", "month", "day"]


# --- silver -----------------------------------------------------------------


def test_silver_rows_types_and_counts(spark, tmp_path):
    put_hospital(
        tmp_path, "2024-01-15", hospital(), hospital(), hospital(date=None),
        hospital(province="Liège", TOTAL_IN="n/a", NEW_IN="1.5"),
    )
    run = build_silver(spark, HOSPITAL, "2024-01-15", str(tmp_path), str(tmp_path / "s"), NOW)
    assert (run.source, run.rows_read, run.rows_written) == (HOSPITAL, 4, 2)
    silver = read_silver(spark, str(tmp_path / "s"), HOSPITAL)
    types = dict(silver.dtypes)
    assert types["date"] == "string" and types["total_in"] == "int"
    row = silver.where("province = 'Liège'").first()
    assert (row["total_in"], row["new_in"], row["_ingestion_date"], row["_source"]) == (
        None, 1, dt.date(2024, 1, 15), HOSPITAL,
    )
    assert row["_processed_at"] == NOW


def test_rerun_leaves_the_same_rows_and_other_dates(spark, tmp_path):
    for day in ("2024-01-15", "2024-01-16"):
        put_hospital(tmp_path, day, hospital(date=day))
    for day in ("2024-01-15", "2024-01-16", "2024-01-15"):
        build_silver(spark, HOSPITAL, day, str(tmp_path), str(tmp_path / "s"), NOW)
    silver = read_silver(spark, str(tmp_path / "s"), HOSPITAL, "all")
    assert sorted(r["date"] for r in silver.collect()) == ["2024-01-15", "2024-01-16"]
    assert os.path.isdir(tmp_path / "s" / HOSPITAL / "year=2024" / "month=01" / "day=15")


def test_backfill_equals_single_runs(spark, tmp_path):
    days = [f"2024-01-{n:02d}" for n in range(9, 16)]
    for n, day in enumerate(days):
        put_hospital(tmp_path, day, hospital(), hospital(), hospital(province=f"p{n}"))
        build_silver(spark, HOSPITAL, day, str(tmp_path), str(tmp_path / "one"), NOW)
    run = backfill_silver(spark, HOSPITAL, str(tmp_path), str(tmp_path / "many"), NOW)
    assert (run.rows_read, run.rows_written) == (21, 14)
    one, many = (read_silver(spark, str(tmp_path / z), HOSPITAL, "all") for z in ("one", "many"))
    assert one.exceptAll(many.select(one.columns)).count() == 0 and many.count() == 14
    assert sorted(os.listdir(tmp_path / "many" / HOSPITAL / "year=2024" / "month=01"))[0] == "day=09"


def test_latest_snapshot_does_not_add_up_downloads(spark, tmp_path):
    for day in ("2023-12-31", "2024-01-02", "2024-01-10"):
        write_silver(spark.createDataFrame([(day, 5)], "date string, n int"), str(tmp_path), "s", day)
    os.makedirs(tmp_path / "s" / "year=2024" / "month=02" / "day=01")
    latest = read_silver(spark, str(tmp_path), "s")
    assert [r["date"] for r in latest.collect()] == ["2024-01-10"]
    assert all("/month=01/day=10/" in f for f in latest.inputFiles())
    everything = read_silver(spark, str(tmp_path), "s", "all")
    assert everything.agg(F.sum("n")).first()[0] == 15
    assert [r["date"] for r in read_silver(spark, str(tmp_path), "s", "2024-01-02").collect()] == [
        "2024-01-02"
    ]
    newest = latest_only(everything)
    assert [r["date"] for r in newest.collect()] == ["2024-01-10"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "ubquery" in plan[plan.index("PartitionFilters"):]


def test_retention_prunes_partitions(spark, tmp_path):
    for day in ("2023-10-01", "2023-11-01", "2024-01-10"):
        write_silver(spark.createDataFrame([(day,)], "date string"), str(tmp_path), "s", day)
    silver = read_silver(spark, str(tmp_path), "s", "all")
    kept = keep_recent(silver, "2024-01-30", 90)
    assert sorted(r["date"] for r in kept.collect()) == ["2023-11-01", "2024-01-10"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "make_date" in plan[plan.index("PartitionFilters"):]
    assert expired_snapshots(silver, "2024-01-30", 90).collect() == [(2023, 10, 1)]


# --- gold -------------------------------------------------------------------


def test_gold_overwrite_static_and_by_region(spark, tmp_path):
    def table(*rows):
        return spark.createDataFrame(list(rows), "n int, region string")

    assert write_gold(table((1, "a"), (2, "b")), str(tmp_path), "t") == 2
    write_gold(table((3, "b")), str(tmp_path), "t", replace="regions")
    assert sorted(map(tuple, read_gold(spark, str(tmp_path), "t").collect())) == [(1, "a"), (3, "b")]
    write_gold(table((4, "b")), str(tmp_path), "t")
    assert list(map(tuple, read_gold(spark, str(tmp_path), "t").collect())) == [(4, "b")]


def test_odd_region_names(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a/b=c d")], "n int, region string")
    write_gold(df, str(tmp_path), "t")
    got = {r["n"]: r["region"] for r in read_gold(spark, str(tmp_path), "t").collect()}
    assert got == {1: None, 2: None, 3: "a/b=c d"}


def test_all_gold_tables_from_bronze(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / z) for z in ("bronze", "silver", "gold"))
    for day in ("2024-01-15", "2024-01-16"):
        put_hospital(bronze, day, hospital(), hospital(province="x"))
        shots = [{"DATE": "2024-01-15", "REGION": "Flanders", "AGEGROUP": "25-34", "SEX": s,
                  "BRAND": "COM", "DOSE": "B", "COUNT": 1234} for s in "FM"]
        put(bronze, VACCINATION, day, "data.json", json.dumps(shots))
        put(bronze, WORLD, day, "data.csv", WORLD_CSV)
        for source in (HOSPITAL, VACCINATION, WORLD):
            build_silver(spark, source, day, bronze, silver, NOW)
    assert build_gold(spark, silver, gold, NOW) == {
        "be_hospitalizations_summary": 1, "be_vaccination_coverage": 1, "who_global_trends": 2,
    }
    summary = read_gold(spark, gold, "be_hospitalizations_summary").first()
    assert (summary["total_hospitalized"], summary["_ingestion_date"]) == (128, dt.date(2024, 1, 16))
    build_gold(spark, silver, gold, NOW, snapshot="all")
    assert read_gold(spark, gold, "be_hospitalizations_summary").first()["total_hospitalized"] == 256
    trends = {r["country_code"]: r for r in read_gold(spark, gold, "who_global_trends").collect()}
    assert trends["PT"]["case_fatality_rate"] == 0.5
    assert trends["LU"]["case_fatality_rate"] is None


def test_gold_is_not_built_from_silver_that_fails_its_checks(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / z) for z in ("bronze", "silver", "gold"))
    table = GOLD_TABLES[:1]
    put_hospital(bronze, "2024-01-15", hospital())
    build_silver(spark, HOSPITAL, "2024-01-15", bronze, silver, NOW)
    assert build_gold(spark, silver, gold, NOW, tables=table, suites=SUITES) == {
        "be_hospitalizations_summary": 1
    }
    put_hospital(bronze, "2024-01-16", hospital(TOTAL_IN=-1), hospital(region="Atlantis"))
    build_silver(spark, HOSPITAL, "2024-01-16", bronze, silver)
    with pytest.raises(QualityFailure, match="2/4 checks passed") as failure:
        build_gold(spark, silver, gold, NOW, tables=table, suites=SUITES)
    assert [c["check"] for c in failure.value.result.failed_checks] == [
        "value_range_total_in", "allowed_values_region",
    ]
    assert read_gold(spark, gold, table[0].name).first()["total_hospitalized"] == 64
    assert require(spark.range(1), "no/suite") is None
    build_gold(spark, silver, gold, tables=table)
    assert read_gold(spark, gold, table[0].name).count() == 2


# --- catalog ----------------------------------------------------------------


def test_zone_is_registered_and_updated_in_place(spark, tmp_path):
    root = str(tmp_path / "zone")
    gold = spark.createDataFrame([(1, "a"), (2, "b")], "n int, region string")
    write_gold(gold, root, "summary")
    for day in ("2024-01-05", "2024-01-15"):
        write_silver(spark.createDataFrame([(day,)], "date string"), root, "who/cases", day)
    found = {r["location"]: r["partition_columns"] for r in discover_tables(spark, root).collect()}
    assert found == {"summary": ["region"], "who/cases": ["year", "month", "day"]}

    assert register_zone(spark, "terrace_test", root) == ["summary", "cases"]
    assert spark.sql("SELECT sum(n) FROM terrace_test.summary WHERE region = 'b'").first()[0] == 2
    assert spark.table("terrace_test.cases").count() == 2

    wider = gold.where("n = 2").withColumn("extra", F.lit("x"))
    wider.write.mode("append").partitionBy("region").parquet(f"{root}/summary")
    write_silver(spark.createDataFrame([("c",)], "date string"), root, "who/cases", "2024-02-01")
    register_zone(spark, "terrace_test", root, merge_schema=True)
    assert spark.table("terrace_test.cases").count() == 3
    extra = spark.sql("SELECT extra FROM terrace_test.summary ORDER BY n, extra NULLS FIRST")
    assert [r[0] for r in extra.collect()] == [None, None, "x"]

    assert [r["date"] for r in latest_only(spark.table("terrace_test.cases")).collect()] == ["c"]
    assert keep_recent(spark.table("terrace_test.cases"), "2024-02-01", 20).count() == 2
    assert drop_expired_partitions(spark, "terrace_test.cases", "2024-02-01", 20) == 1
    assert sorted(r["date"] for r in spark.table("terrace_test.cases").collect()) == [
        "2024-01-15", "c",
    ]
    assert os.path.isdir(tmp_path / "zone" / "who/cases/year=2024/month=01/day=05")
    spark.sql("DROP DATABASE terrace_test CASCADE")


def test_retained_view_moves_with_the_day(spark, tmp_path):
    today = dt.datetime.now(dt.UTC).date()
    for age in (0, 29, 31):
        frame = spark.createDataFrame([(age,)], "age int")
        write_silver(frame, str(tmp_path), "cases", today - dt.timedelta(age))
    register_zone(spark, "retained_test", str(tmp_path))
    create_retained_view(spark, "retained_test.recent", "retained_test.cases", 30)
    recent = spark.table("retained_test.recent")
    assert sorted(r["age"] for r in recent.collect()) == [0, 29]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryFileIndex(2 paths)") == 1
    spark.sql("DROP DATABASE retained_test CASCADE")


def test_workspace_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master, applicationId = "yarn", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(Session())
    Session.sparkContext.master = "local[2]"
    assert "/terrace/app/" in workspace(Session())


def test_workspace_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark), workspace(spark)
    assert first.startswith(shared) and first != second


def test_broken_document_does_not_reach_silver(spark, tmp_path):
    put_hospital(tmp_path, "2024-01-15", hospital(), hospital(province="x"))
    put(tmp_path, HOSPITAL, "2024-01-15", "broken.json", '[{"DATE": "2024-01-1')
    for declared in (False, True):
        run = build_silver(spark, HOSPITAL, "2024-01-15", str(tmp_path), str(tmp_path / "s"),
                           NOW, declared=declared)
        assert run.rows_written == 2


def test_reports_prune_regions_and_push_dates_down(spark, tmp_path):
    gold = spark.createDataFrame(
        [(dt.date(2024, 1, n), r, "a", "A", 1, 1) for n in (1, 2) for r in ("Flanders", "Wallonia")],
        "date date, region string, agegroup string, dose string, "
        "doses_administered bigint, cumulative_doses bigint",
    )
    write_gold(gold, str(tmp_path), "coverage")
    plan = (
        coverage_by_group(read_gold(spark, str(tmp_path), "coverage"))
        ._jdf.queryExecution().executedPlan().toString()
    )
    filters = plan[plan.index("PartitionFilters"):]
    assert "Flanders" in filters.split("PushedFilters")[0]
    assert "date" not in plan[plan.index("ReadSchema"):]


# --- reruns and read-backs ---------------------------------------------------


def failing_late(df):
    """Rows that fail in the stage after a shuffle."""
    shuffled = df.repartition(2, *df.columns)
    return shuffled.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("no more")).cast("int")).otherwise(F.col("v")))


def test_a_failed_rerun_keeps_the_rows_of_silver_and_gold(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame([("a", 1)], "region string, v int")
    bad = failing_late(spark.createDataFrame([("a", 2), ("b", 3)], "region string, v int"))
    write_silver(good, root, "s", "2024-01-15")
    write_gold(good, root, "g")
    for write in (lambda: write_silver(bad, root, "s", "2024-01-15"), lambda: write_gold(bad, root, "g")):
        with pytest.raises(Exception, match="no more"):
            write()
    assert [r["v"] for r in read_silver(spark, root, "s").collect()] == [1]
    assert [tuple(r) for r in read_gold(spark, root, "g").select("region", "v").collect()] == [("a", 1)]


def test_regions_stay_text_and_those_without_rows_go(spark, tmp_path):
    root = str(tmp_path)
    write_gold(spark.createDataFrame([("007", 1), ("1e2", 2), (None, 3)], "region string, v int"), root, "g")
    assert {r["region"] for r in read_gold(spark, root, "g").collect()} == {"007", "1e2", None}
    write_gold(spark.createDataFrame([("a/b", 4)], "region string, v int"), root, "g")
    assert [tuple(r) for r in read_gold(spark, root, "g").select("region", "v").collect()] == [("a/b", 4)]


def test_all_snapshots_have_the_columns_of_any(spark, tmp_path):
    root = str(tmp_path)
    write_silver(spark.createDataFrame([(1,)], "v int"), root, "s", "2024-01-15")
    write_silver(spark.createDataFrame([(2, "x")], "v int, extra string"), root, "s", "2024-01-16")
    rows = read_silver(spark, root, "s", "all").select("v", "extra").collect()
    assert sorted(map(tuple, rows)) == [(1, None), (2, "x")]


def test_a_table_that_moved_or_changed_a_type_is_registered_anew(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{one}/t")
    spark.createDataFrame([(2.5,)], "v double").write.parquet(f"{two}/t")
    for root, value in ((one, 1), (two, 2.5)):
        register_zone(spark, "moved_test", root)
        assert spark.table("moved_test.t").first()["v"] == value
    spark.sql("DROP DATABASE moved_test CASCADE")


def test_paths_below_a_root_that_occurs_twice(spark):
    from terrace.sources.files import relative

    paths = spark.createDataFrame([("file:/data/x/data/y/p",), ("file:///data/q",)], "path string")
    assert [r[0] for r in paths.select(relative("path", "/data/")).collect()] == ["x/data/y/p", "q"]


def test_tables_that_would_share_a_name_are_refused(spark, tmp_path):
    for location in ("a_b/c", "a/b_c", "x/c", "x/b_c"):
        spark.createDataFrame([(1,)], "v int").write.parquet(f"{tmp_path}/{location}")
    with pytest.raises(ValueError, match="a_b_c"):
        register_zone(spark, "clash_test", str(tmp_path))
    assert [t.name for t in spark.catalog.listTables("clash_test") if not t.isTemporary] == []
    spark.sql("DROP DATABASE clash_test CASCADE")
