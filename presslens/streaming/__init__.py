"""Incremental processing of newly arrived files."""
