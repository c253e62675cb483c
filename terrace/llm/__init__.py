"""Operators for building training data, each a Spark job over whole tables."""
