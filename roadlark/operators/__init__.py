"""Table-in, table-out operators; every column name they read is an argument."""
