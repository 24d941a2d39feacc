"""Incremental runs over newly arrived files."""
