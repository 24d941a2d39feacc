"""Inputs, queries and SQL twins used by the driver entry, the benchmark and the tests."""
