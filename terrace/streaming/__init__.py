"""Incremental processing of newly landed files."""

from terrace.streaming.incremental import process_new_snapshots

__all__ = ["process_new_snapshots"]
