"""What the operators on embedding vectors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def usable(column: str) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    vector = F.col(f"`{column}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def lengths(vectors: DataFrame, column: str) -> list[int]:
    """The numbers of components that vectors of a table have. One row for each."""
    found = vectors.select(F.size(F.col(f"`{column}`")).alias("n")).distinct().orderBy("n")
    return [row["n"] for row in found.collect()]
