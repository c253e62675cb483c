"""Terrace: bronze, silver and gold zones of daily statistics as Spark jobs.

Builders take and return DataFrames and run nothing; readers and writers are
kept apart from them.  Importing the package starts no Spark session.
"""

from terrace.registry import SourceSpec, lookup, register

__all__ = ["SourceSpec", "lookup", "register"]
