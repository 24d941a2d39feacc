"""Clean rows into the star schema, insert-if-absent, in dependency order."""

from pyspark.sql import DataFrame

from roadlark import schemas
from roadlark.operators import upsert
from roadlark.operators.audit import fk_audit, pk_audit
from roadlark.sources.tables import Warehouse, staged_days


def load_locations(warehouse: Warehouse, staging: DataFrame, truncate_first: bool = False) -> int:
    """Resolved locations into the dimension; returns the rows inserted. ``truncate_first``
    passes them through the staging table, replacing what it holds, as the initial load
    does."""
    if truncate_first:
        staging = warehouse.replace_staging("staging_locations", staging)
    have = warehouse.read("dim_locations")
    return warehouse.append("dim_locations", upsert.new_locations(staging, have, key_is_unique=True))


def load_warehouse(warehouse: Warehouse, events: DataFrame, vehicles: DataFrame) -> dict[str, int]:
    """Enriched events and classified vehicles into facts and the vehicle dimension;
    returns the rows inserted per table.

    Each step inserts only absent keys, so a load that was interrupted is simply run
    again: nothing is inserted twice. The facts are compared with those of the same days.
    Both inputs are read several times, so they should be tables rather than long plans.
    ``vehicles`` carry the date of their event as ``event_date``, or else as ``date``;
    without either, all days are compared.
    """
    have, append = warehouse.read, warehouse.append
    event_days = staged_days(events)
    new_events = upsert.new_events(
        events, have("dim_direction"), have("fact_events", event_days), True, carry=("date",)
    )
    inserted = {"fact_events": append("fact_events", new_events, "date")}

    types = upsert.new_vehicle_types(vehicles, have("dim_vehicles"), key_is_unique=True)
    inserted["dim_vehicles"] = append("dim_vehicles", types)

    date = next((c for c in (schemas.EVENT_DATE, "date") if c in vehicles.columns), None)
    vehicle_days = staged_days(vehicles, date) if date else None
    new_pairs = upsert.new_event_vehicles(
        vehicles, have("fact_event_vehicles", vehicle_days), True, carry=(date,) if date else ()
    )
    inserted["fact_event_vehicles"] = append("fact_event_vehicles", new_pairs, date)
    return inserted


def audit(warehouse: Warehouse) -> tuple[DataFrame, DataFrame]:
    """(duplicate keys, orphans) of the whole warehouse; both empty when it is sound,
    but for events of no direction, whose UNKNOWN has no parent row."""
    tables = warehouse.tables()
    return pk_audit(tables), fk_audit(tables)

