import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from terrace.operators.rollup import daily_totals
from terrace.plans.gold import global_trends, hospitalizations_summary, vaccination_coverage
from terrace.plans.reports import (
    country_comparison,
    coverage_by_group,
    freshness,
    icu_trend,
    weekly_by_region,
)

NOW = "2024-02-01T00:00:00"


def d(text):
    return dt.date.fromisoformat(text)


def test_hospital_summary_golden(tidy):
    rows = {r["region"]: r for r in hospitalizations_summary(tidy, NOW).collect()}
    assert {k: tuple(r)[2:6] for k, r in rows.items()} == {
        "Flanders": (97, 9, 17, 5),
        "Brussels": (58, 11, 4, 6),
        "Wallonia": (41, 6, 5, 7),
    }
    assert rows["Flanders"]["7day_avg_admissions"] == 17.0
    assert rows["Flanders"]["icu_rate"] == 9 / 97
    assert rows["Flanders"]["date"] == d("2024-01-22")
    assert {r["_gold_processed_at"] for r in rows.values()} == {NOW}


def test_hospital_summary_schema(tidy):
    silver = tidy.withColumn("_ingestion_date", F.lit("2024-01-16").cast("date"))
    out = hospitalizations_summary(silver, NOW)
    assert dict(out.dtypes) == {
        "date": "date", "region": "string", "total_hospitalized": "bigint",
        "total_icu": "bigint", "new_admissions": "bigint", "new_discharges": "bigint",
        "7day_avg_admissions": "double", "icu_rate": "double", "_ingestion_date": "date",
        "_gold_processed_at": "string",
    }
    assert out.first()["_ingestion_date"] == d("2024-01-16")


def admissions(hospital_rows, days, region="Flanders"):
    return hospital_rows([(day, "p", region, 1, 1, n, 0) for day, n in days])


def test_rolling_mean_by_rows_and_by_days(hospital_rows):
    silver = admissions(hospital_rows, [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-20", 3)])
    for window, want in (("rows", [1.0, 1.5, 2.0]), ("days", [1.0, 1.5, 3.0])):
        out = hospitalizations_summary(silver, NOW, window=window).orderBy("date")
        assert [r["7day_avg_admissions"] for r in out.collect()] == want


def test_undated_rows_have_a_calendar_mean_of_their_own(hospital_rows):
    silver = admissions(hospital_rows, [("bad", 9), ("2024-01-01", 1), ("2024-01-02", 2)])
    rows, days = (
        {r["date"]: r["7day_avg_admissions"]
         for r in hospitalizations_summary(silver, NOW, window=w).collect()}
        for w in ("rows", "days")
    )
    assert rows == {None: 9.0, d("2024-01-01"): 5.0, d("2024-01-02"): 4.0}
    assert days == {None: 9.0, d("2024-01-01"): 1.0, d("2024-01-02"): 1.5}


def test_rolling_mean_covers_seven_rows_and_skips_null(hospital_rows):
    days = [(f"2024-01-{n:02d}", n if n != 5 else None) for n in range(1, 11)]
    out = hospitalizations_summary(admissions(hospital_rows, days), NOW).orderBy("date")
    means = [r["7day_avg_admissions"] for r in out.collect()]
    assert means[6] == (1 + 2 + 3 + 4 + 6 + 7) / 6
    assert means[9] == (4 + 6 + 7 + 8 + 9 + 10) / 6


def test_zero_denominator_gives_null(hospital_rows):
    out = hospitalizations_summary(hospital_rows([("2024-01-01", "p", "F", 0, 3, 1, 1)]), NOW)
    assert out.first()["icu_rate"] is None


def test_measures_that_are_all_null_stay_null(hospital_rows):
    rows = [("2024-01-01", "p", "F", None, 3, 1, 1), ("2024-01-01", "q", "F", None, 3, None, 1)]
    first = hospitalizations_summary(hospital_rows(rows), NOW).first()
    assert first["total_hospitalized"] is None and first["new_admissions"] == 1


def test_unparseable_dates_form_one_null_group(hospital_rows):
    rows = [
        ("2024-13-01", "p", "F", 1, 1, 1, 1),
        ("2024/01/01", "p", "F", 2, 1, 1, 1),
        ("2024-01-01", "p", "F", 4, 1, 1, 1),
    ]
    out = {r["date"]: r["total_hospitalized"]
           for r in hospitalizations_summary(hospital_rows(rows), NOW).collect()}
    assert out == {None: 3, d("2024-01-01"): 4}


def test_dates_are_parsed_after_grouping_and_little_is_read(spark, tidy, tmp_path):
    tidy.write.parquet(str(tmp_path / "s"))
    plan = (
        hospitalizations_summary(spark.read.parquet(str(tmp_path / "s")), NOW)
        ._jdf.queryExecution().executedPlan().toString()
    )
    # By date text, by date, and by region for the window.
    assert plan.count("Exchange") == 3
    assert plan.count("HashAggregate") == 4
    read = plan[plan.index("ReadSchema"):]
    assert "province" not in read and "total_in_icu" in read


VACCINATIONS = "date string, region string, agegroup string, sex string, brand string, dose string, count int"


def doses(spark, rows):
    return spark.createDataFrame(rows, VACCINATIONS)


def test_cumulative_doses_collapse_sex_and_brand(spark):
    silver = doses(spark, [
        ("2024-01-01", "Flanders", "25-34", "F", "X", "A", 4),
        ("2024-01-01", "Flanders", "25-34", "M", "Y", "A", 6),
        ("2024-01-02", "Flanders", "25-34", "F", "X", "A", 0),
        ("2024-01-09", "Flanders", "25-34", "F", "X", "A", 5),
        ("2024-01-03", "Flanders", "25-34", "F", "X", "B", 1),
    ])
    out = vaccination_coverage(silver, NOW)
    got = [tuple(r) for r in out.where("dose = 'A'").orderBy("date")
           .select("doses_administered", "cumulative_doses").collect()]
    assert got == [(10, 10), (0, 10), (5, 15)]
    assert dict(out.dtypes)["cumulative_doses"] == "bigint"


def test_total_doses_equal_the_final_running_total(spark):
    rng = random.Random(7)
    silver = doses(spark, [
        (f"2024-01-{rng.randint(1, 28):02d}", rng.choice("FWB"), rng.choice(["a", "b"]), "F", "X",
         rng.choice("ABCE"), rng.randint(0, 50)) for _ in range(600)
    ])
    out = vaccination_coverage(silver, NOW).groupBy("region", "agegroup", "dose").agg(
        F.sum("doses_administered").alias("s"), F.max("cumulative_doses").alias("m")
    )
    assert out.where("s <> m").count() == 0


CASES = (
    "date_reported string, country_code string, country string, who_region string, "
    "new_cases int, cumulative_cases int, new_deaths int, cumulative_deaths int"
)


def test_fatality_rate(spark):
    silver = spark.createDataFrame([
        ("2024-01-15", "PT", "Portugal", "EURO", 41, 812_000, 3, 4_060),
        ("2024-01-15", "NL", "Netherlands", "EURO", 1, 0, 0, 5),
        ("2024-01-15", "DE", "Germany", "EURO", 1, None, 0, 5),
    ], CASES)
    out = {r["country_code"]: r for r in global_trends(silver, NOW).collect()}
    assert {k: r["case_fatality_rate"] for k, r in out.items()} == {
        "PT": 0.5, "NL": None, "DE": None,
    }
    assert out["PT"]["region"] == "EURO"
    assert dict(global_trends(silver, NOW).dtypes)["cumulative_cases"] == "int"


def test_gold_equals_brute_force(hospital_rows):
    rng = random.Random(3)
    rows = [
        (rng.choice([f"2024-01-{n:02d}" for n in range(1, 25)] + ["bad", "2024-02-30"]),
         rng.choice("pqr"), rng.choices(["F", "W", None], [6, 2, 1])[0],
         rng.randint(0, 9), rng.randint(0, 3), rng.choice([None, 1, 2, 3]), 1)
        for _ in range(800)
    ]
    groups = defaultdict(list)
    for row in rows:
        try:
            day = d(row[0])
        except ValueError:
            day = None
        groups[(row[2], day)].append(row)
    want = {}
    for region in {r for r, _ in groups}:
        days = sorted(
            (day for key, day in groups if key == region),
            key=lambda x: (x is not None, x or d("0001-01-01")),
        )
        sums = []
        for day in days:
            new = [r[5] for r in groups[(region, day)] if r[5] is not None]
            sums.append(sum(new) if new else None)
            last = [s for s in sums[-7:] if s is not None]
            want[(region, day)] = (
                sum(r[3] for r in groups[(region, day)]),
                sums[-1],
                sum(last) / len(last) if last else None,
            )
    got = {
        (r["region"], r["date"]): (r["total_hospitalized"], r["new_admissions"], r["7day_avg_admissions"])
        for r in hospitalizations_summary(hospital_rows(rows), NOW).collect()
    }
    assert got.keys() == want.keys()
    for key, row in got.items():
        assert row[:2] == want[key][:2]
        assert row[2] == pytest.approx(want[key][2])


def test_countless_texts_that_are_no_dates_merge(spark):
    silver = spark.range(0, 20_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "2024-01-01")
        .otherwise(F.concat(F.lit("2024-01-01T00:00:"), "id")).alias("date"),
        *(F.lit(v).alias(n) for n, v in (("province", "p"), ("region", "F"))),
        *(F.lit(1).alias(n) for n in ("total_in", "total_in_icu", "new_in", "new_out")),
    )
    out = hospitalizations_summary(silver, NOW).orderBy("date").collect()
    assert [(r["date"], r["total_hospitalized"]) for r in out] == [
        (None, 13_333), (d("2024-01-01"), 6_667),
    ]


def test_both_ways_of_parsing_agree(hospital_rows):
    rng = random.Random(5)
    df = hospital_rows([
        (rng.choice(["2024-01-01", "2024-01-02", "2024/01/02", None, "x"]), "p",
         rng.choice("FW"), rng.randint(0, 9), 1, 1, 1) for _ in range(200)
    ])
    plain = daily_totals(df, "date", ["region"], sums={"t": "total_in"}, maxima={"m": "total_in"})
    placed = daily_totals(
        df, "date", ["region"], sums={"t": "total_in"}, maxima={"m": "total_in"},
        parse_groups=True,
    )
    assert sorted(map(str, plain.collect())) == sorted(map(str, placed.collect()))


# --- reports ----------------------------------------------------------------


def test_icu_trend_bound_order_and_rounding(spark, hospital_rows):
    silver = hospital_rows([
        ("2024-01-01", "p", "B", 3, 1, 1, 0),
        ("2024-01-31", "p", "B", 3, 1, 2, 0),
        ("2024-01-31", "p", None, 3, 2, 2, 0),
        ("2024-01-31", "p", "A", 0, 0, 2, 0),
        ("2023-12-31", "p", "A", 1, 1, 9, 0),
    ])
    out = icu_trend(hospitalizations_summary(silver, NOW), as_of="2024-01-31").collect()
    assert [(r["date"], r["region"]) for r in out] == [
        (d("2024-01-31"), "A"), (d("2024-01-31"), "B"), (d("2024-01-31"), None),
        (d("2024-01-01"), "B"),
    ]
    assert [r["icu_rate_pct"] for r in out] == [None, 33.33, 66.67, 33.33]
    assert out[0]["avg_daily_admissions_7d"] == 5.5


def test_gold_is_open_to_sql(spark, tidy):
    hospitalizations_summary(tidy, NOW).createOrReplaceTempView("be_hospitalizations_summary")
    got = spark.sql(
        "SELECT region, round(7day_avg_admissions, 1) FROM be_hospitalizations_summary "
        "WHERE date >= date_add(date '2024-02-01', -30) "
        "AND date >= add_months(date '2024-02-01', -3) ORDER BY date DESC, region"
    )
    assert [tuple(r) for r in got.collect()] == [
        ("Brussels", 4.0), ("Flanders", 17.0), ("Wallonia", 5.0),
    ]
    spark.catalog.dropTempView("be_hospitalizations_summary")


def test_icu_trend_defaults_to_today(spark):
    gold = spark.range(1).select(
        F.current_date().alias("date"), F.lit("F").alias("region"),
        F.lit(1).alias("total_hospitalized"), F.lit(1).alias("total_icu"),
        F.lit(0.5).alias("icu_rate"), F.lit(1.0).alias("7day_avg_admissions"),
    )
    assert icu_trend(gold).count() == 1
    assert icu_trend(gold.withColumn("date", F.date_sub(F.current_date(), 31))).count() == 0


def test_coverage_of_one_region(spark):
    silver = doses(spark, [
        ("2024-01-01", "Flanders", "25-34", "F", "X", "B", 4),
        ("2024-01-02", "Flanders", "25-34", "F", "X", "B", 5),
        ("2024-01-01", "Flanders", "18-24", "F", "X", "A", 1),
        ("2024-01-01", "Wallonia", "18-24", "F", "X", "A", 8),
    ])
    out = [tuple(r) for r in coverage_by_group(vaccination_coverage(silver, NOW)).collect()]
    assert out == [("18-24", "A", 1, 1), ("25-34", "B", 9, 9)]


def test_country_comparison_clamps_at_the_end_of_a_month(spark):
    silver = spark.createDataFrame([
        ("2024-02-29", "BE", "Belgium", "EURO", 1, 3, 0, 1),
        ("2024-02-28", "BE", "Belgium", "EURO", 1, 3, 0, 1),
        ("2024-05-01", "US", "Elsewhere", "AMRO", 1, 3, 0, 1),
    ], CASES)
    out = country_comparison(global_trends(silver, NOW), as_of="2024-05-31").collect()
    assert [tuple(r) for r in out] == [(d("2024-02-29"), "Belgium", 1, 0, 33.333)]


def test_weeks_start_on_monday(hospital_rows):
    silver = admissions(hospital_rows, [("2024-01-14", 1), ("2024-01-15", 2), ("2024-01-21", 3)])
    out = weekly_by_region(hospitalizations_summary(silver, NOW)).collect()
    assert [(r["week_start"], r["total_new_admissions"]) for r in out] == [
        (d("2024-01-15"), 5), (d("2024-01-08"), 1),
    ]


def test_freshness(tidy):
    stamped = tidy.withColumn("_ingestion_date", F.lit("2024-01-16").cast("date"))
    out = freshness(hospitalizations_summary(stamped, NOW))
    assert [tuple(r) for r in out.collect()] == [("_ingestion_date", d("2024-01-16"), 3, 3)]
    assert out.columns == ["metric", "latest_ingestion", "total_records", "regions_count"]


def test_freshness_of_an_empty_table_has_no_row(tidy):
    stamped = tidy.where("false").withColumn("_ingestion_date", F.lit("2024-01-16").cast("date"))
    assert freshness(hospitalizations_summary(stamped, NOW)).count() == 0
