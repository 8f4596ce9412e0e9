"""Incremental versions of the time-based counts."""
