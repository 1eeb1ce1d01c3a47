"""Incremental refresh as a stream over newly arrived files."""
