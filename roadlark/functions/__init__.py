"""Column expressions: text in, typed fields out. No UDF anywhere."""
