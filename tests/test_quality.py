import pytest
from pyspark.sql import functions as F

from terrace.operators.quality import (
    AllowedValues,
    NoDuplicates,
    NotNull,
    QualityResult,
    ValueRange,
    check_allowed_values,
    check_no_duplicates,
    check_not_null,
    check_value_range,
    observe_suite,
    quality_report,
    run_suite,
    summarize,
)

KEYS = ["date", "province", "region"]
REGIONS = {"Flanders", "Wallonia", "Brussels"}


def test_complete_column_passes(tidy):
    assert check_not_null(tidy, "date") == {
        "check": "not_null_date",
        "column": "date",
        "threshold": 0.95,
        "actual": 1.0,
        "passed": True,
    }


def test_too_many_nulls_fail(untidy):
    found = check_not_null(untidy, "date", threshold=0.95)
    assert (found["actual"], found["passed"]) == (0.75, False)


def test_threshold_is_compared_before_rounding(spark):
    df = spark.range(30_000).select(F.when(F.col("id") > 0, F.col("id")).alias("v"))
    found = check_not_null(df, "v", threshold=1.0)
    assert found["actual"] == 1.0 and found["passed"] is False


def test_unique_keys_pass(tidy):
    assert check_no_duplicates(tidy, KEYS) == {
        "check": "no_duplicates",
        "key_columns": KEYS,
        "total_rows": 4,
        "distinct_rows": 4,
        "passed": True,
    }


def test_copies_fail(untidy):
    found = check_no_duplicates(untidy, KEYS)
    assert (found["total_rows"], found["distinct_rows"], found["passed"]) == (4, 3, False)


def test_null_keys_count_and_equal_each_other(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", 1)], "k string, n int")
    assert check_no_duplicates(df, ["k", "n"])["distinct_rows"] == 3


def test_values_in_range_pass(tidy):
    assert check_value_range(tidy, "total_in", 0, 100_000) == {
        "check": "value_range_total_in",
        "column": "total_in",
        "min": 0,
        "max": 100_000,
        "out_of_range_rows": 0,
        "passed": True,
    }


def test_negative_value_fails(untidy):
    assert check_value_range(untidy, "total_in", 0, 100_000)["out_of_range_rows"] == 1


def test_bounds_are_inclusive_null_passes_and_nan_is_outside(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (None,), (float("nan"),)], "v double")
    assert check_value_range(df, "v", 0, 5)["out_of_range_rows"] == 1


def test_known_values_pass(tidy):
    assert check_allowed_values(tidy, "region", REGIONS) == {
        "check": "allowed_values_region",
        "column": "region",
        "allowed_count": 3,
        "invalid_rows": 0,
        "passed": True,
    }


def test_unknown_value_fails(hospital_rows):
    df = hospital_rows([("2024-01-22", "Nowhere", "Atlantis", 12, 1, 2, 0)])
    found = check_allowed_values(df, "region", REGIONS)
    assert (found["invalid_rows"], found["passed"]) == (1, False)


def test_nothing_allowed_makes_every_value_invalid_but_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert check_allowed_values(df, "v", set())["invalid_rows"] == 2


def test_empty_frame_fails_only_not_null(hospital_rows):
    empty = hospital_rows([])
    assert check_not_null(empty, "date")["passed"] is False
    assert check_not_null(empty, "date")["actual"] == 0.0
    assert check_no_duplicates(empty, KEYS)["passed"] is True
    assert check_value_range(empty, "total_in", 0, 1)["passed"] is True
    assert check_allowed_values(empty, "region", REGIONS)["passed"] is True


SUITE = [
    NotNull("date"),
    NoDuplicates(KEYS),
    ValueRange("total_in", 0, 100_000),
    AllowedValues("region", REGIONS),
    NoDuplicates(["region"]),
]


def test_suite_matches_single_checks(untidy):
    result = run_suite(untidy, "hospitals", SUITE)
    singles = [
        check_not_null(untidy, "date"),
        check_no_duplicates(untidy, KEYS),
        check_value_range(untidy, "total_in", 0, 100_000),
        check_allowed_values(untidy, "region", REGIONS),
        check_no_duplicates(untidy, ["region"]),
    ]
    assert result.checks == singles
    assert [c["check"] for c in result.failed_checks] == [
        "not_null_date", "no_duplicates", "value_range_total_in", "no_duplicates",
    ]
    assert result.passed is False
    assert result.summary() == "[hospitals] Quality: 1/5 checks passed"


def test_suite_runs_one_action_over_one_scan(spark, tidy, tmp_path):
    path = str(tmp_path / "silver")
    tidy.write.parquet(path)
    report = quality_report(spark.read.parquet(path), "hospitals", SUITE[:4])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("keys", [[["a"], ["b"], ["a", "b"]], [["b", "a"], ["c"], ["a", "b"], ["c"]], [["a"], ["c"]]])
def test_several_keys_are_checked_in_one_scan(spark, tmp_path, keys):
    rows = [(1, "x", None), (1, "y", None), (None, "x", None), (None, "x", 2.0), (3, None, 2.0)]
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "a int, b string, c double").write.parquet(path)
    frame = spark.read.parquet(path)
    checks = [ValueRange("a", 2, 9), *map(NoDuplicates, keys), NotNull("b", 0.5)]
    report = quality_report(frame, "s", checks)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    single = [run_suite(frame, "s", [c]).checks[0] for c in checks]
    assert list(run_suite(frame, "s", checks).checks) == single
    nothing = frame.limit(0)
    assert list(run_suite(nothing, "s", checks).checks) == [run_suite(nothing, "s", [c]).checks[0] for c in checks]


def test_a_suite_that_rides_along_gives_the_same_result(spark, untidy):
    for checks in (SUITE, SUITE[:2], [c for c in SUITE if isinstance(c, NoDuplicates)]):
        seen, result = observe_suite(untidy, "hospitals", checks)
        assert seen.groupBy("region").count().count() == 3
        assert list(result().checks) == list(run_suite(untidy, "hospitals", checks).checks)
    seen, result = observe_suite(untidy.limit(0), "hospitals", SUITE)
    seen.count()
    assert list(result().checks) == list(run_suite(untidy.limit(0), "hospitals", SUITE).checks)


def test_summary_frame(untidy):
    row = summarize(quality_report(untidy, "hospitals", SUITE)).first()
    assert row.asDict() == {
        "source": "hospitals", "checks": 5, "checks_passed": 1, "passed": False,
    }


def test_no_checks_is_an_error(tidy):
    with pytest.raises(ValueError):
        quality_report(tidy, "hospitals", [])


def test_summary_of_an_empty_result():
    assert QualityResult("x", []).summary() == "[x] Quality: 0/0 checks passed"
