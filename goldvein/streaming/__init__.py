"""Incremental loads of what has landed since the last run."""
