"""Incremental landing."""
