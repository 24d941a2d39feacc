"""Audits of the declared keys; every check is one pre-aggregated pass."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from roadlark import schemas


def key_copies(table: DataFrame, name: str, key: list[str]) -> DataFrame:
    """Keys that occur more than once, as (table_name, key_value, copies)."""
    value = F.concat_ws("|", *[F.col(k).cast("string") for k in key])
    return (
        table.groupBy(*key)
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .select(F.lit(name).alias("table_name"), value.alias("key_value"), "copies")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str) -> DataFrame:
    """Child keys without a parent, as (relation, key_value, child_rows).

    Children are counted per key before the join, so a hot key is one row in it.
    """
    return (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count("*").alias("child_rows"))
        .join(parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti")
        .select(F.lit(name).alias("relation"), F.col("_key").cast("string").alias("key_value"), "child_rows")
    )


def pk_audit(tables: dict[str, DataFrame], declared=schemas.TABLES) -> DataFrame:
    checks = [key_copies(tables[n], n, declared[n][1]) for n in declared if n in tables]
    return reduce(DataFrame.unionByName, checks)


def fk_audit(tables: dict[str, DataFrame], declared=schemas.FOREIGN_KEYS) -> DataFrame:
    checks = [
        orphans(tables[c], col, tables[p], pcol, f"{c}.{col}->{p}.{pcol}")
        for c, col, p, pcol in declared
        if c in tables and p in tables
    ]
    return reduce(DataFrame.unionByName, checks)
