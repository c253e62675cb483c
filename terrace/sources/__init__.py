"""Readers and writers of the zones."""
