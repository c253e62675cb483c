"""Report dates.  ``as_of`` is a date, an ISO string, a Column, or None for today."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = dt.date | str | Column | None


def _day(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def days_before(as_of: AsOf, days: int) -> Column:
    return F.date_sub(_day(as_of), days)


def months_before(as_of: AsOf, months: int) -> Column:
    """Calendar months back; the end of a shorter month is its last day."""
    return F.add_months(_day(as_of), -months)


def week_start(day: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.date_trunc("week", day).cast("date")
