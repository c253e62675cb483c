"""Suites of quality checks for the silver zone, and the gate before gold."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from terrace.operators.quality import (
    AllowedValues,
    Check,
    NoDuplicates,
    NotNull,
    QualityResult,
    ValueRange,
    observe_suite,
    run_suite,
)

# Regions, dose codes and bounds the sources are expected to keep to.
REGIONS = ("Flanders", "Wallonia", "Brussels")
DOSES = ("A", "B", "C", "E")
MOST_PATIENTS = 100_000

SUITES: dict[str, tuple[Check, ...]] = {
    "sciensano/covid_hospitalizations": (
        NotNull("date"),
        NoDuplicates(["date", "province", "region"]),
        ValueRange("total_in", 0, MOST_PATIENTS),
        AllowedValues("region", REGIONS),
    ),
    "sciensano/covid_vaccinations": (
        NotNull("date"),
        AllowedValues("region", REGIONS),
        AllowedValues("dose", DOSES),
    ),
    "who/global_covid": (
        NotNull("date_reported"),
        NoDuplicates(["date_reported", "country_code", "country"]),
    ),
}


class QualityFailure(Exception):
    """A silver frame did not pass its suite; ``result`` has the details."""

    def __init__(self, result: QualityResult):
        failed = ", ".join(c["check"] for c in result.failed_checks)
        super().__init__(f"{result.summary()}; failed: {failed}")
        self.result = result


def require(
    silver: DataFrame, source: str, suites: Mapping[str, Sequence[Check]] = SUITES
) -> QualityResult | None:
    """Run the suite of ``source``; QualityFailure if a check fails, None without a suite."""
    checks = suites.get(source)
    if not checks:
        return None
    result = run_suite(silver, source, checks)
    if not result.passed:
        raise QualityFailure(result)
    return result


def require_later(
    silver: DataFrame, source: str, suites: Mapping[str, Sequence[Check]] = SUITES
) -> tuple[DataFrame, Callable[[], None]]:
    """``silver`` and a function that raises QualityFailure if it did not pass, to be called after an action on it."""
    checks = suites.get(source)
    if not checks:
        return silver, lambda: None
    seen, found = observe_suite(silver, source, checks)

    def judge() -> None:
        result = found()
        if not result.passed:
            raise QualityFailure(result)

    return seen, judge
