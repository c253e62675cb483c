"""Ratios that are NULL where they are not defined."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fraction(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double; NULL for a zero or NULL denominator."""
    return F.try_divide(part, whole)


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` where ``whole`` is positive, else NULL."""
    return F.when(whole > 0, F.try_divide(part, whole) * 100)
