"""Readers and writers: post CSV files, timeline pages, clean Parquet, warehouse tables."""
