"""Whole builds: silver snapshots, gold tables, reports."""
