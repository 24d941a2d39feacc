"""Insert-if-absent: the rows of a staging table that a target does not have yet."""

from pyspark.sql import DataFrame, functions as F

from roadlark.functions import keys
from roadlark.operators.directions import fact_rows
from roadlark.operators.joins import one_row_per_key
from roadlark.operators.locations import with_location_id


def absent_rows(rows: DataFrame, existing: DataFrame, key: list[str], key_is_unique: bool = False) -> DataFrame:
    """One row per key that ``existing`` lacks; existing rows are never changed.

    Both sides arrive partitioned by the key and reduced to one row per key, so the anti
    join adds no shuffle and meets no skew. ``key_is_unique`` skips the reduction of
    ``existing`` where its key is already kept unique.
    """
    have = existing.select(*key)
    have = have if key_is_unique else have.distinct()
    return one_row_per_key(rows, key).join(have, key, "left_anti").select(*rows.columns)


def new_locations(staging: DataFrame, dim_locations: DataFrame, key_is_unique: bool = False) -> DataFrame:
    complete = staging.dropna(subset=["city", "location", "latitude", "longitude"])
    return absent_rows(with_location_id(complete), dim_locations, ["location_id"], key_is_unique)


def new_events(
    staging: DataFrame,
    dim_direction: DataFrame,
    fact_events: DataFrame,
    key_is_unique: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    rows = fact_rows(staging, dim_direction, carry)
    return absent_rows(rows, fact_events, ["event_id"], key_is_unique)


def new_vehicle_types(staging: DataFrame, dim_vehicles: DataFrame, key_is_unique: bool = False) -> DataFrame:
    types = staging.dropna(subset=["vehicle_type", "vehicle_group"]).select(
        "vehicle_type", "vehicle_group", "suggested_from", "is_verified"
    )
    return absent_rows(types, dim_vehicles, ["vehicle_type"], key_is_unique)


def new_event_vehicles(
    staging: DataFrame,
    fact_event_vehicles: DataFrame,
    key_is_unique: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    pairs = staging.dropna(subset=["event_id", "vehicle_type"]).select(
        "event_id", "vehicle_type", "vehicle_count", *carry
    )
    fresh = absent_rows(pairs, fact_event_vehicles, ["event_id", "vehicle_type"], key_is_unique)
    return fresh.select(
        keys.event_vehicle_id(F.col("event_id"), F.col("vehicle_type")).alias("fev_id"), *pairs.columns
    )
