"""Column expressions; all built-in, all evaluated on the JVM."""

from terrace.functions.casting import iso_date, tolerant_cast, whole_number
from terrace.functions.dates import days_before, months_before, week_start
from terrace.functions.names import silver_name, silver_names
from terrace.functions.rates import fraction, percentage

__all__ = [
    "days_before",
    "fraction",
    "iso_date",
    "months_before",
    "percentage",
    "silver_name",
    "silver_names",
    "tolerant_cast",
    "week_start",
    "whole_number",
]
