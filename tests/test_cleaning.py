import datetime as dt
import re
from decimal import ROUND_DOWN, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import SourceSpec, lookup
from terrace.functions import iso_date, silver_name, silver_names, whole_number
from terrace.operators.cleaning import (
    add_metadata,
    cast_schema,
    clean,
    distinct_rows,
    drop_undated,
    normalize_columns,
)
from terrace.registry import fields


def values(df, column):
    return [r[column] for r in df.collect()]


def ints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return values(df.orderBy("i").select(whole_number(F.col("t")).alias("n")), "n")


def test_names():
    assert silver_name("Date Reported") == "date_reported"
    assert silver_names(["New-Cases", "WHO_region"]) == ["new_cases", "who_region"]


def test_names_are_normalised_in_the_frame(spark):
    df = spark.createDataFrame([(1, 2)], ["Date Reported", "new-cases"])
    assert normalize_columns(df).columns == ["date_reported", "new_cases"]


def test_colliding_names_are_refused(spark):
    with pytest.raises(ValueError, match="date"):
        silver_names(["DATE", "date"])


INTEGER_TEXTS = {
    "abc": None, "": None, "1.5": 1, "-2.7": -2, " 7 ": 7, "1e3": None, "12d": None,
    "NaN": None, "1.5abc": None, "3000000000": None, "-3000000000": None, "2147483647": 2147483647,
    "2147483648": None, "2147483647.9": 2147483647, "-2147483648": -2147483648, ".5": 0,
    "-.5": 0, "5.": 5, ".": None, "+8": 8, "+": None, "\t8\n": 8, "\t1.5\n": 1, "\t.5 ": 0,
    "1 2": None, "1.2.3": None, "0x10": None, "1.99999999999999999999999": 1, "007": 7,
    "3000000000.5": None, "\x018\x7f": 8, "\x0b1.5\x1f": 1,
}


def test_integer_texts(spark):
    texts = [*INTEGER_TEXTS, None]
    assert dict(zip(texts, ints(spark, texts))) == {**INTEGER_TEXTS, None: None}


def truncated(text):
    """The same rule in Python."""
    if not re.fullmatch(r"[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)", text.strip(" \t\n\r\f\v")):
        return None
    number = int(Decimal(text.strip()).quantize(Decimal(1), rounding=ROUND_DOWN))
    return number if -(2**31) <= number < 2**31 else None


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-. e\t", max_size=12), min_size=50, max_size=200))
def test_any_text_casts_like_the_rule(spark, texts):
    assert ints(spark, texts) == [truncated(t) for t in texts]


DATE_TEXTS = {
    "2024-01-15": dt.date(2024, 1, 15), "2024-02-29": dt.date(2024, 2, 29), "2023-02-29": None,
    "2024-13-01": None, "2024/01/01": None, "2024-1-15": None, " 2024-01-15": None,
    "2024-01-15 ": None, "2024-01-15T00:00:00": None, "2024-01-1T": None, "": None, "2024": None,
    "12024-01-15": None, "abc": None,
}


def test_iso_dates(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(DATE_TEXTS)], "i int, t string")
    got = values(df.orderBy("i").select(iso_date(F.col("t")).alias("d")), "d")
    assert dict(zip(DATE_TEXTS, got)) == DATE_TEXTS


def test_iso_date_equals_the_formatter(spark):
    df = spark.createDataFrame([(t,) for t in DATE_TEXTS], "t string")
    differ = df.where(~iso_date(F.col("t")).eqNullSafe(F.try_to_date("t", "yyyy-MM-dd")))
    assert differ.count() == 0


def test_only_registered_columns_are_cast_and_none_is_added(spark):
    df = spark.createDataFrame([("2024-01-15", "7", "keep 1")], ["date", "new_in", "note"])
    types = lookup("sciensano/covid_hospitalizations").silver_types
    out = cast_schema(df, types)
    assert out.dtypes == [("date", "string"), ("new_in", "int"), ("note", "string")]
    assert out.first() == ("2024-01-15", 7, "keep 1")


def test_numbers_out_of_range_become_null_not_wrapped(spark):
    df = spark.createDataFrame([(3_000_000_000, 2.7)], "a bigint, b double")
    out = cast_schema(df, {"a": T.IntegerType(), "b": T.IntegerType()})
    assert out.first() == (None, 2)


def test_undated_rows_go_unparseable_ones_stay(spark):
    df = spark.createDataFrame([("2024-01-15",), (None,), ("2024-13-01",)], "date string")
    assert drop_undated(df, "date").count() == 2
    assert drop_undated(df, "date", strict=True).count() == 1
    assert drop_undated(df, "date_reported").count() == 3


def test_equal_rows_merge_with_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None), (1, "a")], "a int, b string")
    assert distinct_rows(df).count() == 3


def test_lineage_columns(spark):
    out = add_metadata(spark.range(1), "who/global_covid", "2024-01-15", "2024-01-16T03:00:00")
    assert out.dtypes[1:] == [
        ("_ingestion_date", "date"), ("_source", "string"), ("_processed_at", "string"),
    ]
    assert out.first()[1:] == (dt.date(2024, 1, 15), "who/global_covid", "2024-01-16T03:00:00")


def test_untidy_rows_cleaned(untidy):
    spec = lookup("sciensano/covid_hospitalizations")
    rows = clean(untidy, spec, "2024-01-15", "now").collect()
    assert sorted(r["province"] for r in rows) == ["Capital", "Hainaut"]


RAW_ROWS = st.lists(
    st.fixed_dictionaries({
        "DATE": st.sampled_from(["2024-01-15", "2024-01-16", "2024-02-30", "", None]),
        "REGION": st.sampled_from(["F", "W", None]),
        "NEW_IN": st.sampled_from(["8", " 8", "8.0", "8.9", "n/a", "1e3", "3000000000", "-2", None]),
        "Note-1": st.sampled_from(["x", "X", None]),
    }),
    max_size=60,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(RAW_ROWS, st.booleans())
def test_cleaning_equals_brute_force(spark, raw, strict):
    spec = lookup("sciensano/covid_hospitalizations")
    good = {"2024-01-15", "2024-01-16"} if strict else {"2024-01-15", "2024-01-16", "2024-02-30", ""}
    want = {
        (r["DATE"], r["REGION"], None if r["NEW_IN"] is None else truncated(r["NEW_IN"]), r["Note-1"])
        for r in raw if r["DATE"] in good
    }
    names = ("DATE", "REGION", "NEW_IN", "Note-1")
    schema = ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in raw], schema)
    out = clean(df, spec, "2024-01-17", "now", strict_dates=strict)
    got = [tuple(r) for r in out.select("date", "region", "new_in", "note_1").collect()]
    assert len(got) == len(want) and set(got) == want


def test_cleaning_shuffles_once_and_merges_copies_before(untidy):
    spec = lookup("sciensano/covid_hospitalizations")
    plan = clean(untidy, spec, "2024-01-15", "now")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2


def test_one_normaliser_for_data_and_registry(spark):
    spec = SourceSpec("t", fields(text="Report-Date", whole="NEW-IN"), date_column="report_date")
    df = spark.createDataFrame([("2024-01-15", "7")], ["Report-Date", "NEW-IN"])
    out = clean(df, spec, "2024-01-15", "now")
    assert out.dtypes[:2] == [("report_date", "string"), ("new_in", "int")]
    assert out.first()["new_in"] == 7


def test_format_and_date_column_come_from_the_registry():
    world = lookup("who/global_covid")
    assert (world.file_format, world.date_column) == ("csv", "date_reported")
    assert lookup("sciensano/covid_vaccinations").date_column == "date"


def test_unknown_source_is_named():
    with pytest.raises(ValueError, match="sciensano/covid_mortality"):
        lookup("sciensano/covid_mortality")


def test_line_separators_are_no_whitespace(spark):
    assert ints(spark, ["8\u2028", "8\u0085", "\u20288", "٣"]) == [None] * 4
    df = spark.createDataFrame([("2024-01-15\u2028",), ("2024-01-15\n",)], "t string")
    assert values(df.select(iso_date(F.col("t")).alias("d")), "d") == [None, None]


def test_other_integer_widths(spark):
    texts = ["9223372036854775807", "9223372036854775808", "00000000000000000000000000127", "128", "-128.9"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    longs = values(df.select(whole_number(F.col("t"), T.LongType()).alias("n")), "n")
    assert longs == [9223372036854775807, None, 127, 128, -128]
    small = values(df.select(whole_number(F.col("t"), T.ByteType()).alias("n")), "n")
    assert small == [None, None, 127, None, -128]


def test_casts_need_no_ansi_setting(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        texts = list(INTEGER_TEXTS)
        assert dict(zip(texts, ints(spark, texts))) == INTEGER_TEXTS
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
