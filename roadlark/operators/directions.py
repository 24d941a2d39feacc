"""Direction lookup: short and full names resolve to the short one."""

from pyspark.sql import DataFrame, functions as F

from roadlark import rules
from roadlark.functions import fields
from roadlark.operators.joins import lookup_join


def direction_lookup(events: DataFrame, dim_direction: DataFrame, **join_options) -> DataFrame:
    """Add ``direction_id``; ``direction IN (short, full)`` becomes an equi join on a
    table with one row per name, instead of a nested loop."""
    names = dim_direction.select(
        F.col("short_name").alias("direction_id"),
        F.explode(F.array_distinct(F.array("short_name", "full_name"))).alias("direction"),
    ).where(F.col("direction").isNotNull())
    joined = lookup_join(events, names, "direction", "left", **join_options)
    return joined.withColumn("direction_id", F.coalesce("direction_id", F.lit(rules.UNKNOWN)))


def fact_rows(
    events: DataFrame, dim_direction: DataFrame, carry: tuple[str, ...] = (), **join_options
) -> DataFrame:
    """Enriched events in the shape of the event fact table, plus columns to ``carry``."""
    return direction_lookup(events, dim_direction, **join_options).select(
        "event_id",
        "event_timestamp",
        "location_id",
        fields.event_type(F.col("type")).alias("event_type"),
        F.col("type").alias("event_type_details"),
        "direction_id",
        "lanes_blocked",
        "post",
        "link",
        *carry,
    )
