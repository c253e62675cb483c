"""The library's operators run over the given tables, each next to the SQL it must equal."""

from trial import gold, quality, silver, zones  # noqa: F401
from trial.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
