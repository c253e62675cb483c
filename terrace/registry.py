"""What each source looks like: raw fields, target types, file format, date column."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from terrace.functions.names import silver_name
from terrace.layout import SNAPSHOT


def raw_name(name: str) -> str:
    """The name a raw field is read under: one of a snapshot's directories is theirs alone."""
    return f"raw_{name}" if name.lower() in SNAPSHOT else name


@dataclass(frozen=True)
class SourceSpec:
    """One source of daily snapshots.

    ``schema`` carries the names as they arrive and the types wanted in silver.
    ``date_column`` is the silver name of the column that must not be NULL.
    ``options`` go to the Spark reader as they are.
    """

    name: str
    schema: T.StructType
    date_column: str
    file_format: str = "json"
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def as_text(self) -> T.StructType:
        """The same fields, all strings: what a raw file is read as."""
        return T.StructType([T.StructField(f.name, T.StringType(), True) for f in self.schema])

    @property
    def silver_types(self) -> dict[str, T.DataType]:
        return {silver_name(raw_name(f.name)): f.dataType for f in self.schema}


#: Whole JSON documents, one top-level array per file.
JSON_DOCUMENTS = {"multiLine": "true"}
#: One JSON value per line; such files can be split among tasks.
JSON_LINES = {"multiLine": "false"}
#: Names from the header line; a file whose header differs from its companions' is an error.
CSV_WITH_HEADER = {"header": "true", "enforceSchema": "false"}


def fields(*, text: str, whole: str = "") -> T.StructType:
    """Nullable string fields followed by nullable int fields."""
    columns = [T.StructField(n, T.StringType(), True) for n in text.split()]
    columns += [T.StructField(n, T.IntegerType(), True) for n in whole.split()]
    return T.StructType(columns)


# Source ids and field names as the data publishers ship them.
_KNOWN = (
    SourceSpec(
        "sciensano/covid_hospitalizations",
        fields(
            text="DATE PROVINCE REGION",
            whole="NR_REPORTING TOTAL_IN TOTAL_IN_ICU TOTAL_IN_RESP TOTAL_IN_ECMO NEW_IN NEW_OUT",
        ),
        date_column="date",
        options=JSON_DOCUMENTS,
    ),
    SourceSpec(
        "sciensano/covid_vaccinations",
        fields(text="DATE REGION AGEGROUP SEX BRAND DOSE", whole="COUNT"),
        date_column="date",
        options=JSON_DOCUMENTS,
    ),
    SourceSpec(
        "who/global_covid",
        fields(
            text="Date_reported Country_code Country WHO_region",
            whole="New_cases Cumulative_cases New_deaths Cumulative_deaths",
        ),
        date_column="date_reported",
        file_format="csv",
        options=CSV_WITH_HEADER,
    ),
)

# Sources that are landed raw but have no silver schema.
LANDED_ONLY = (
    "sciensano/covid_cases_by_age",
    "sciensano/covid_cases_by_province",
    "sciensano/covid_mortality",
)

_registry: dict[str, SourceSpec] = {spec.name: spec for spec in _KNOWN}


def register(spec: SourceSpec) -> SourceSpec:
    """Add or replace a source."""
    _registry[spec.name] = spec
    return spec


def lookup(source: str) -> SourceSpec:
    """The spec of ``source``; ValueError before anything is read if there is none."""
    try:
        return _registry[source]
    except KeyError:
        raise ValueError(f"No schema registered for source {source!r}") from None


def registered() -> tuple[str, ...]:
    return tuple(_registry)


def landing_specs() -> tuple[SourceSpec, ...]:
    """Every source that is landed each day, with or without a silver schema."""
    bare = (
        SourceSpec(name, T.StructType([]), date_column="date", options=JSON_DOCUMENTS)
        for name in LANDED_ONLY
    )
    return (*_registry.values(), *bare)
