import datetime as dt

from pyspark.sql import functions as F

from roadlark import schemas
from roadlark.sources import posts as raw
from roadlark.sources.tables import Warehouse
from roadlark.streaming.incremental import first_of_each_event, remembered_ids, run_ingest

TEXT = "MMDA ALERT: Road crash at EDSA Shaw NB involving car as of {}:00 AM"


def posts(spark, *hours):
    rows = [(TEXT.format(h), f"u{h}", dt.date(2025, 1, 1)) for h in hours]
    return spark.createDataFrame(rows, schemas.RAW_POSTS)


def test_growing_folder_is_read_once_per_file_and_loaded_once_per_event(spark, tmp_path):
    root, state = str(tmp_path / "raw"), str(tmp_path / "state")
    warehouse = Warehouse(spark, str(tmp_path / "star"))
    warehouse.seed()
    raw.write_day_folders(posts(spark, 1, 2), root)
    run_ingest(warehouse, root, state, clean_root=str(tmp_path / "clean"))
    assert warehouse.read("fact_events").count() == 2
    raw.write_day_folders(posts(spark, 2, 3), root, mode="append")
    run_ingest(warehouse, root, state, max_files=1)
    run_ingest(warehouse, root, state)
    assert warehouse.read("fact_events").count() == 3
    assert warehouse.read("fact_event_vehicles").count() == 3
    # A lost checkpoint reads every file again and still inserts nothing.
    run_ingest(warehouse, root, str(tmp_path / "state2"))
    assert warehouse.read("fact_events").count() == 3


def test_first_of_each_event_drops_repeats_in_a_stream(spark, tmp_path):
    rows = [("E1", dt.datetime(2025, 1, 1, 8)), ("E1", dt.datetime(2025, 1, 1, 8)), ("E2", dt.datetime(2025, 1, 1, 9))]
    path = str(tmp_path / "events")
    spark.createDataFrame(rows, "event_id string, event_timestamp timestamp_ntz").write.parquet(path)
    stream = spark.readStream.schema("event_id string, event_timestamp timestamp_ntz").parquet(path)
    query = (
        first_of_each_event(stream).writeStream.format("memory").queryName("once")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("once").groupBy("event_id").count().where(F.col("count") > 1).count() == 0
    assert spark.table("once").count() == 2


def test_late_repeated_and_untimed_rows_over_two_runs(spark, tmp_path):
    ddl = "event_id string, event_timestamp timestamp_ntz, date date"
    folder, state, out = (str(tmp_path / n) for n in ("events", "state", "out"))
    at = lambda day, hour: dt.datetime(2025, 1, day, hour)
    first = [("old", at(1, 8), at(1, 0)), ("new", at(9, 8), at(9, 0)), ("untimed", None, at(8, 0)), ("never", None, None)]
    second = first + [
        ("late", at(2, 8), at(2, 0)),
        ("late day", None, at(6, 0)),
        ("in time", at(7, 9), at(7, 0)),
        ("day in time", None, at(7, 0)),
        ("never 2", None, None),
        ("in time", at(7, 9), at(7, 0)),
    ]

    def run():
        stream = first_of_each_event(spark.readStream.schema(ddl).parquet(folder))
        sink = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        sink.format("parquet").start(out).awaitTermination()
        return sorted(r.event_id for r in spark.read.parquet(out).collect())

    def arrive(rows):
        dated = [(i, t, d and d.date()) for i, t, d in rows]
        spark.createDataFrame(dated, ddl).write.mode("append").parquet(folder)

    arrive(first)
    assert run() == ["never", "new", "old", "untimed"]
    # What is older than the delay is forgotten; it would be late.
    assert sorted(r.event_id for r in remembered_ids(spark, state).collect()) == ["never", "new", "untimed"]
    arrive(second)
    assert run() == ["day in time", "in time", "never", "never 2", "new", "old", "untimed"]
    assert run() == ["day in time", "in time", "never", "never 2", "new", "old", "untimed"]
