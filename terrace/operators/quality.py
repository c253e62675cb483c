"""Data-quality checks: compiled to one DataFrame, one row per check, one action.

Every check boils down to counts of rows, and counts can be added up.  Without a
key-uniqueness check they are one aggregate, of which each task returns one row.
With one, rows are counted per key, copies of a key being merged before the
shuffle, and the counts of all checks are then added up over the keys: still a
single scan.  With several, every row is expanded to one row per set of keys, which are
merged in the scanning task alike: again a single scan, whatever the number of checks.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.sources.metrics import counted

log = logging.getLogger(__name__)


# --- predicates -----------------------------------------------------------


def out_of_range(column: str, low: Any, high: Any) -> Column:
    """Below ``low`` or above ``high``; NULL for NULL, and NaN is above everything."""
    return ~F.col(column).between(low, high)


def not_allowed(column: str, allowed: Iterable[Any]) -> Column:
    """Not NULL and not one of ``allowed``, of which there may be none."""
    value = F.col(column)
    return ~value.isin(list(allowed)) & value.isNotNull()


# --- checks ---------------------------------------------------------------

# The names of the checks and of the entries of their results.

@dataclass(frozen=True)
class NotNull:
    column: str
    threshold: float = 0.95

    @property
    def name(self) -> str:
        return f"not_null_{self.column}"

    def measure(self) -> Column:
        return F.count(self.column)

    def report(self, present: Column, total: Column) -> dict[str, Column]:
        ratio = F.coalesce(F.try_divide(present, total), F.lit(0.0))
        return {
            "column": F.lit(self.column),
            "threshold": F.lit(float(self.threshold)),
            "actual": F.round(ratio, 4),
            "passed": ratio >= self.threshold,
        }


@dataclass(frozen=True)
class ValueRange:
    column: str
    low: Any
    high: Any

    @property
    def name(self) -> str:
        return f"value_range_{self.column}"

    def measure(self) -> Column:
        return F.count_if(out_of_range(self.column, self.low, self.high))

    def report(self, outside: Column, _total: Column) -> dict[str, Column]:
        return {
            "column": F.lit(self.column),
            "min": F.lit(str(self.low)),
            "max": F.lit(str(self.high)),
            "out_of_range_rows": outside,
            "passed": outside == 0,
        }


@dataclass(frozen=True)
class AllowedValues:
    column: str
    allowed: frozenset

    def __init__(self, column: str, allowed: Iterable[Any]):
        object.__setattr__(self, "column", column)
        object.__setattr__(self, "allowed", frozenset(allowed))

    @property
    def name(self) -> str:
        return f"allowed_values_{self.column}"

    def measure(self) -> Column:
        return F.count_if(not_allowed(self.column, self.allowed))

    def report(self, invalid: Column, _total: Column) -> dict[str, Column]:
        return {
            "column": F.lit(self.column),
            "allowed_count": F.lit(len(self.allowed)).cast("bigint"),
            "invalid_rows": invalid,
            "passed": invalid == 0,
        }


@dataclass(frozen=True)
class NoDuplicates:
    keys: tuple[str, ...]

    def __init__(self, keys: Sequence[str]):
        object.__setattr__(self, "keys", tuple(keys))

    name = "no_duplicates"

    def report(self, distinct: Column, total: Column) -> dict[str, Column]:
        return {
            "key_columns": F.lit(",".join(self.keys)),
            "total_rows": total,
            "distinct_rows": distinct,
            "passed": total == distinct,
        }


Check = NotNull | ValueRange | AllowedValues | NoDuplicates

# The columns of a report.
_RESULT = {
    "position": "int",
    "check": "string",
    "column": "string",
    "threshold": "double",
    "actual": "double",
    "key_columns": "string",
    "total_rows": "bigint",
    "distinct_rows": "bigint",
    "min": "string",
    "max": "string",
    "out_of_range_rows": "bigint",
    "allowed_count": "bigint",
    "invalid_rows": "bigint",
    "passed": "boolean",
}


def count_rows(
    df: DataFrame, measures: dict[str, Column], keys: Sequence[str] | None = None
) -> DataFrame:
    """One row with ``total_rows`` and ``measures``, which are counts of rows.

    With ``keys`` also ``distinct_rows``, the number of distinct keys; NULLs in a
    key are equal to each other.
    """
    counts = {"total_rows": F.count(F.lit(1)), **measures}
    columns = [c.alias(n) for n, c in counts.items()]
    if not keys:
        return df.agg(*columns)
    return (
        df.groupBy(*keys)
        .agg(*columns)
        .agg(
            *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts),
            F.count(F.lit(1)).alias("distinct_rows"),
        )
    )


def count_rows_per_key(
    df: DataFrame, measures: dict[str, Column], key_sets: Sequence[Sequence[str]]
) -> DataFrame:
    """One row per set of keys with its place as ``key_set``, ``total_rows``, ``measures`` and ``distinct_rows``.

    Each row of ``df`` is expanded to one per set; the keys that are not in a set are NULL in it.
    """
    columns = list(dict.fromkeys(k for keys in key_sets for k in keys))
    # The bit of a column is set where it is not among the keys.
    marks = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for keys in key_sets]
    counts = {"total_rows": F.count(F.lit(1)), **measures}
    grouped = df.groupingSets([list(keys) for keys in key_sets], *columns).agg(
        F.grouping_id().alias("mark"), *[c.alias(n) for n, c in counts.items()]
    )
    place = F.element_at(F.create_map(*[F.lit(x) for i, m in enumerate(marks) for x in (m, i)]), F.col("mark").cast("int"))
    return (
        grouped.groupBy(place.alias("key_set"))
        .agg(*[F.sum(n).alias(n) for n in counts], F.count(F.lit(1)).alias("distinct_rows"))
    )


def _row(position: int, check: Check, values: dict[str, Column]) -> Column:
    values = {"position": F.lit(position), "check": F.lit(check.name), **values}
    return F.struct(
        *(values.get(c, F.lit(None)).cast(t).alias(c) for c, t in _RESULT.items())
    )


def quality_report(df: DataFrame, source: str, checks: Sequence[Check]) -> DataFrame:
    """One row per check; columns that do not belong to a check are NULL."""
    if not checks:
        raise ValueError("no checks given")
    by_row = {i: c for i, c in enumerate(checks) if not isinstance(c, NoDuplicates)}
    by_key = {i: c for i, c in enumerate(checks) if isinstance(c, NoDuplicates)}
    measures = {f"m{i}": c.measure() for i, c in by_row.items()}
    total = F.col("total_rows")
    rows = [_row(i, c, c.report(F.col(f"m{i}"), total)) for i, c in by_row.items()]
    sets = list(dict.fromkeys(tuple(sorted(set(c.keys))) for c in by_key.values()))
    if len(sets) < 2:
        rows += [_row(i, c, c.report(F.col("distinct_rows"), total)) for i, c in by_key.items()]
        totals = count_rows(df, measures, sets[0] if sets else None)
        return totals.select(F.inline(F.array(*rows))).select(F.lit(source).alias("source"), "*")
    per_key = count_rows_per_key(df, measures, sets)
    # All sets are needed even if there are no rows to group.
    numbers = df.sparkSession.range(len(sets)).select(F.col("id").cast("int").alias("key_set"))
    nothing = {c: 0 for c in ("total_rows", "distinct_rows", *measures)}
    totals = numbers.join(per_key, "key_set", "left").fillna(nothing)
    own = {n: [_row(i, c, c.report(F.col("distinct_rows"), total)) for i, c in by_key.items() if tuple(sorted(set(c.keys))) == keys] for n, keys in enumerate(sets)}
    own[0] = rows + own[0]
    per_set = F.array().cast(f"array<struct<{', '.join(f'`{c}`: {t}' for c, t in _RESULT.items())}>>")
    for n, found in own.items():
        per_set = F.when(F.col("key_set") == n, F.array(*found)).otherwise(per_set)
    return totals.select(F.inline(per_set)).select(F.lit(source).alias("source"), "*")


# --- results on the driver ------------------------------------------------


@dataclass(frozen=True)
class QualityResult:
    """The results of a suite, one dict per check."""

    source: str
    checks: Sequence[dict]

    @property
    def failed_checks(self) -> list[dict]:
        return [c for c in self.checks if not c["passed"]]

    @property
    def passed(self) -> bool:
        return not self.failed_checks

    def summary(self) -> str:
        good = sum(c["passed"] for c in self.checks)
        # Fixed value: the wording of the summary line.
        return f"[{self.source}] Quality: {good}/{len(self.checks)} checks passed"


def run_suite(df: DataFrame, source: str, checks: Sequence[Check]) -> QualityResult:
    """Run all checks in one action.  What comes back is one row per check."""
    found = quality_report(df, source, checks).orderBy("position").collect()
    result = QualityResult(
        source, [_as_dict(row.asDict(), checks[row["position"]]) for row in found]
    )
    log.info(result.summary())
    return result


def observe_suite(
    df: DataFrame, source: str, checks: Sequence[Check]
) -> tuple[DataFrame, Callable[[], QualityResult]]:
    """``df`` and a function for the result of its suite, to be called after an action on ``df``.

    Counts of rows ride along with the action.  Keys must come together to be told apart, so all
    checks on keys take one scan of the key columns of their own, before.
    """
    by_key = [c for c in checks if isinstance(c, NoDuplicates)]
    by_row = {i: c for i, c in enumerate(checks) if not isinstance(c, NoDuplicates)}
    keyed = iter(run_suite(df, source, by_key).checks if by_key else [])
    found = [next(keyed) if isinstance(c, NoDuplicates) else {} for c in checks]
    if not by_row:
        return df, lambda: QualityResult(source, found)
    seen, values = counted(df, f"{source} checked", **{f"m{i}": c.measure() for i, c in by_row.items()})

    def result() -> QualityResult:
        numbers = values()
        one = df.sparkSession.range(1)
        rows = [_row(i, c, c.report(F.lit(numbers[f"m{i}"]), F.lit(numbers["rows"]))) for i, c in by_row.items()]
        for row in one.select(F.inline(F.array(*rows))).collect():
            found[row["position"]] = _as_dict(row.asDict(), checks[row["position"]])
        done = QualityResult(source, found)
        log.info(done.summary())
        return done

    return seen, result


def _as_dict(row: dict, check: Check) -> dict:
    """The values that belong to the check, with its parameters in their own types."""
    kept = {k: v for k, v in row.items() if v is not None and k not in ("source", "position")}
    if isinstance(check, NoDuplicates):
        kept["key_columns"] = list(check.keys)
    if isinstance(check, ValueRange):
        kept["min"], kept["max"] = check.low, check.high
    return kept


def _single(df: DataFrame, check: Check) -> dict:
    return run_suite(df, "", [check]).checks[0]


def check_not_null(df: DataFrame, column: str, threshold: float = 0.95) -> dict:
    return _single(df, NotNull(column, threshold))


def check_no_duplicates(df: DataFrame, key_columns: list[str]) -> dict:
    return _single(df, NoDuplicates(key_columns))


def check_value_range(df: DataFrame, column: str, min_val: Any, max_val: Any) -> dict:
    return _single(df, ValueRange(column, min_val, max_val))


def check_allowed_values(df: DataFrame, column: str, allowed: set) -> dict:
    return _single(df, AllowedValues(column, allowed))


def summarize(report: DataFrame) -> DataFrame:
    """Per source: checks run, checks passed, and whether all did."""
    return report.groupBy("source").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("checks_passed"),
        F.bool_and("passed").alias("passed"),
    )
