"""Batches that break off anywhere, come twice or are read while they are written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadlark import schemas
from roadlark.operators.audit import fk_audit, pk_audit
from roadlark.plans.audits import audit_batch, audited_folders, merged_audit
from roadlark.plans.load import load_warehouse
from roadlark.sources.batches import BatchWarehouse

DAY = dt.date(2024, 1, 5)


class Died(Exception):
    pass


@pytest.fixture
def warehouse(spark, tmp_path):
    made = BatchWarehouse(spark, f"{tmp_path}/star")
    made.seed()
    return made


def event_rows(spark, ids, day=DAY, place="L1"):
    event = {name: None for name in schemas.EVENT_COLUMNS}
    rows = [{**event, "event_id": i, "date": day, "location_id": place, "direction": "NB", "type": "ROAD CRASH"} for i in ids]
    return spark.createDataFrame(
        rows, "event_id string, date date, time string, event_timestamp timestamp_ntz, location_id string, city string, "
        "location string, latitude double, longitude double, accuracy double, direction string, type string, "
        "lanes_blocked int, involved string, post string, link string",
    )


def vehicle_rows(spark, ids, day=DAY, kind="HOVERCRAFT"):
    rows = [(i, kind, 1, "OTHERS", "VAN", False, day, day) for i in ids]
    return spark.createDataFrame(
        rows, "event_id string, vehicle_type string, vehicle_count int, vehicle_group string, suggested_from string, "
        "is_verified boolean, date date, event_date date",
    )


def place_rows(spark, *names):
    return spark.createDataFrame(
        [("PASIG CITY", n, 14.5, 121.0, 1.0) for n in names], schemas.RESOLVED_LOCATIONS
    )


def stage(warehouse, batch_id, ids, day=DAY):
    spark = warehouse.spark
    warehouse.stage(
        batch_id, locations=place_rows(spark, "EDSA", batch_id), events=event_rows(spark, ids, day), vehicles=vehicle_rows(spark, ids, day)
    )


def ids(warehouse):
    return sorted(r.event_id for r in warehouse.read("fact_events").collect())


def pairs(warehouse):
    return sorted(r.event_id for r in warehouse.read("fact_event_vehicles").collect())


@pytest.mark.parametrize("step", ["fact_events", "fact_event_vehicles"])
def test_a_batch_that_dies_after_any_table_is_not_seen_and_then_replayed(warehouse, step):
    stage(warehouse, "a", ["1", "2"])
    warehouse.load("a")
    stage(warehouse, "b", ["2", "3"])

    def dies(table):
        if table == step:
            raise Died

    with pytest.raises(Died):
        warehouse.load("b", after=dies)
    again = BatchWarehouse(warehouse.spark, warehouse.root)
    assert ids(again) == ["1", "2"] == pairs(again)
    assert again.read("dim_locations").count() == 2 and again.unmarked() == ["b"]
    assert again.recover() == {"b": "replayed"} and again.unmarked() == []
    assert ids(again) == ["1", "2", "3"] == pairs(again)
    assert again.read("dim_locations").count() == 3
    assert again.recover() == {}


def test_recovery_may_clear_instead(warehouse):
    stage(warehouse, "b", ["3"])
    with pytest.raises(Died):
        warehouse.load("b", after=lambda table: (_ for _ in ()).throw(Died()))
    assert warehouse.recover(replay=False) == {"b": "cleared"}
    assert ids(warehouse) == [] and warehouse.load("b") is None
    stage(warehouse, "b", ["3"])
    warehouse.load("b")
    assert ids(warehouse) == ["3"]


def test_a_batch_staged_in_part_is_cleared(warehouse):
    event_rows(warehouse.spark, ["9"]).write.parquet(warehouse._home("half", "staging/events"))
    assert warehouse.staged("half") == {} and warehouse.load("half") is None
    assert warehouse.recover() == {"half": "cleared"} and ids(warehouse) == []


def test_a_death_between_the_mark_and_the_clearing_leaves_a_whole_batch(warehouse, monkeypatch):
    stage(warehouse, "a", ["1"])
    monkeypatch.setattr(warehouse, "_clear_staging", lambda batch_id: (_ for _ in ()).throw(Died()))
    with pytest.raises(Died):
        warehouse.load("a")
    again = BatchWarehouse(warehouse.spark, warehouse.root)
    assert ids(again) == ["1"] and again.staged("a")
    assert again.recover() == {} and not again.staged("a") and ids(again) == ["1"]


def test_loading_or_staging_a_committed_batch_again_changes_nothing(warehouse):
    stage(warehouse, "a", ["1"])
    first = warehouse.load("a")
    stage(warehouse, "a", ["1", "2"])
    assert warehouse.load("a") == first and ids(warehouse) == ["1"]


def test_of_two_attempts_the_first_one_marked_counts(warehouse):
    stage(warehouse, "a", ["1"])
    warehouse._write("fact_events", warehouse.read("fact_events").limit(0), "a", "late")
    first = warehouse.load("a")
    rows = event_rows(warehouse.spark, ["7"])
    from roadlark.operators.directions import fact_rows

    late = fact_rows(rows, warehouse.read("dim_direction"), ("date",))
    warehouse._write("fact_events", late, "a", "late", "date")  # a task that was thought dead
    assert ids(warehouse) == ["1"]
    assert warehouse._commit("a", "late") == first and ids(warehouse) == ["1"]


def test_counts_come_from_the_files(warehouse):
    stage(warehouse, "a", ["1", "2"])
    warehouse.load("a")
    stage(warehouse, "b", ["2", "3"], None)  # rows without a date are only compared with such
    warehouse.load("b")
    counts = {(r.table_name, r.event_date): r.rows for r in warehouse.counts().collect()}
    assert counts["fact_events", DAY] == 2 == counts["fact_events", None]
    assert counts["dim_locations", None] == 3
    for name in schemas.TABLES:
        assert sum(n for (table, _), n in counts.items() if table == name) == warehouse.read(name).count()


def test_other_plans_take_it_for_a_warehouse(warehouse):
    spark = warehouse.spark
    warehouse.append("dim_locations", place_rows(spark, "EDSA").select(F.lit("L1").alias("location_id"), "*"))
    events, vehicles = event_rows(spark, ["1", "2"]), vehicle_rows(spark, ["1", "2"])
    inserted = load_warehouse(warehouse, events, vehicles)
    assert inserted == {"fact_events": 2, "dim_vehicles": 1, "fact_event_vehicles": 2}
    assert load_warehouse(warehouse, events, vehicles) == dict.fromkeys(inserted, 0)


def test_names_of_batches_are_checked(warehouse):
    for name in ("", "a/b", "a.b", "a b", "../x"):
        with pytest.raises(ValueError):
            warehouse.load(name)
    with pytest.raises(ValueError):
        warehouse.stage("a", roads=warehouse.read("fact_events"))


def test_merged_audit_equals_the_full_one(warehouse):
    stage(warehouse, "a", ["1", "2"])
    warehouse.load("a")
    audit_batch(warehouse, "a")
    stage(warehouse, "b", ["3"], dt.date(2024, 1, 6))
    warehouse.load("b")
    folders = audited_folders(warehouse, "b")
    assert folders and all("event_date=2024-01-06" in f for f in folders)
    audit_batch(warehouse, "b")
    tables = warehouse.tables()
    full = {("orphan", r.relation, r.key_value, r.child_rows) for r in fk_audit(tables).collect()}
    full |= {("copies", r.table_name, r.key_value, r.copies) for r in pk_audit(tables).collect()}
    assert {tuple(r) for r in merged_audit(warehouse).collect()} == full and len(full) == 1
    # The parent that was missing comes with a later batch.
    warehouse.append("dim_locations", place_rows(warehouse.spark, "X").select(F.lit("L1").alias("location_id"), "*"))
    assert merged_audit(warehouse).count() == 0


def test_audit_finds_copies_in_touched_days(warehouse):
    stage(warehouse, "a", ["1"])
    warehouse.load("a")
    rows = warehouse.read("fact_events").withColumn("date", F.lit(DAY))
    warehouse._write("fact_events", rows, "b", "x", "date")  # an insert without its key check
    warehouse._commit("b", "x")
    audit_batch(warehouse, "b")
    found = merged_audit(warehouse).where("kind = 'copies'").collect()
    assert [(r.subject, r.key_value, r.found) for r in found] == [("fact_events", "1", 2)]
