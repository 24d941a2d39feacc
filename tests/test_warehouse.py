import datetime as dt

import pytest

from roadlark import schemas
from roadlark.operators.locations import resolve_from_gazetteer, resolve_with
from roadlark.plans import ingest
from roadlark.plans.batch import enrich_locations, resolve_places
from roadlark.plans.load import audit, load_locations, load_warehouse
from roadlark.sources import posts as raw, tables
from roadlark.sources.tables import Warehouse

DAY1, DAY2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)

LINES = {
    DAY1: [
        "MMDA ALERT: Road crash at EDSA Shaw NB involving car and 2 vans as of 8:05 AM. 1 lane",
        "MMDA ALERT: Stalled jeepney due to rain at Makati Ave SB as of noon. two lanes",
        'MMDA ALERT: Rally at "Mendiola"\nmore or less 50 pax',
    ],
    DAY2: [
        "MMDA ALERT: Stalled bus due to flat at EDSA Shaw as of noon",
        "MMDA ALERT: Vehicular accident at C-5 Kalayaan EB involving SUV as of 1:00 PM",
    ],
}


def day_path(root, day):
    return f"{root}/{day:%Y/%m}/scrape_data_{day:%Y%m%d}.csv"


def write_raw(tmp_path):
    root = tmp_path / "scrape"
    for day, lines in LINES.items():
        path = day_path(str(root), day)
        (tmp_path / "scrape" / f"{day:%Y}" / f"{day:%m}").mkdir(parents=True, exist_ok=True)
        quoted = [f'"{line.replace(chr(34), chr(34) * 2)}",https://x/{i},{day} 00:00:00+08:00' for i, line in enumerate(lines)]
        open(path, "w").write("content,tweetlinkid,created_at\n" + "\n".join(quoted) + "\n")
    return str(root)


@pytest.fixture()
def star(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "star"))
    warehouse.seed()
    return warehouse


def gazetteer(spark):
    return lambda missing: resolve_from_gazetteer(
        missing,
        spark.createDataFrame(
            [("EDSA SHAW", "Mandaluyong", 1.0, 2.0, "High"), ("C-5 KALAYAAN", "Makati", 3.0, 4.0, "Low")],
            "location string, city string, latitude double, longitude double, confidence string",
        ),
    )


def test_range_ingest_load_and_audit(spark, star, tmp_path):
    root, clean = write_raw(tmp_path), str(tmp_path / "clean")
    # The range has days without a file; they are skipped.
    batch = ingest.ingest_range(star, root, clean, dt.date(2024, 12, 30), dt.date(2025, 1, 4), resolver=gazetteer(spark))
    events = {r.link[-1] + str(r.date): r for r in batch.events.collect()}
    assert batch.events.columns == schemas.EVENT_COLUMNS
    crash, stalled, rally = (events[f"{i}{DAY1}"] for i in range(3))
    assert (crash.location, crash.city, crash.time, crash.lanes_blocked) == ("EDSA SHAW", "MANDALUYONG", "08:05", 1)
    # Filled within the file, never across files.
    assert (stalled.time, rally.time) == ("08:05", "08:05")
    assert stalled.event_timestamp == dt.datetime(2025, 1, 1, 8, 5)
    assert events[f"0{DAY2}"].time is None and events[f"1{DAY2}"].time == "13:00"
    assert sorted(r.location for r in batch.unresolved.collect()) == ["MAKATI AVE", '"MENDIOLA"'][::-1]

    inserted = ingest.load_days(star, clean, DAY1, DAY2)
    assert inserted["fact_events"] == 5 and inserted["fact_event_vehicles"] == 6
    assert ingest.load_days(star, clean, DAY1, DAY2) == dict.fromkeys(inserted, 0)
    duplicates, orphans = audit(star)
    assert duplicates.count() == 0
    assert {(r.relation, r.key_value) for r in orphans.collect()} == {
        ("fact_events.direction_id->dim_direction.short_name", "UNKNOWN")
    }
    # A second run knows the resolved places and inserts nothing.
    again = ingest.ingest_range(star, root, None, DAY1, DAY2, resolver=gazetteer(spark))
    assert again.new_locations.count() == 0
    assert load_warehouse(star, again.events, again.vehicles) == dict.fromkeys(inserted, 0)


def test_daily_ingest_takes_the_day_before_and_only_that(spark, star, tmp_path):
    root, clean = write_raw(tmp_path), str(tmp_path / "clean")
    ingest.ingest_daily(star, root, clean, DAY2)
    assert ingest.load_daily(star, clean, DAY2)["fact_events"] == 3
    assert {r.event_type for r in star.read("fact_events").collect()} == {"ROAD CRASH", "STALLED VEHICLE", "RALLY"}
    assert ingest.load_daily(star, clean, dt.date(2030, 1, 1))["fact_events"] == 0


def test_replacing_days_does_not_double_the_clean_folders(spark, star, tmp_path):
    root, clean = write_raw(tmp_path), str(tmp_path / "clean")
    for replace in (True, True):
        ingest.ingest_range(star, root, clean, DAY1, DAY2, replace_days=replace)
    assert spark.read.parquet(f"{clean}/events").count() == 5
    ingest.ingest_range(star, root, clean, DAY1, DAY1)
    assert spark.read.parquet(f"{clean}/events").count() == 8


def test_no_input_is_an_empty_batch(star, tmp_path):
    batch = ingest.ingest_daily(star, str(tmp_path / "none"), str(tmp_path / "clean"), DAY2)
    assert batch.events.count() == 0 and batch.vehicles.count() == 0


def test_unresolved_places_enter_the_dimension_only_on_request(spark, star, tmp_path):
    posts = raw.with_file_order(raw.read_posts(spark, day_path(write_raw(tmp_path), DAY1)))
    for keep, count in ((False, 1), (True, 3)):
        batch = ingest.transform(posts, star, None, gazetteer(spark), keep_unresolved=keep)
        assert star.read("dim_locations").count() == count


def test_initial_locations_truncate_staging(spark, star, tmp_path):
    path = str(tmp_path / "initial")
    rows = [("PASIG CITY", "EDSA SHAW", 1.0, 2.0, 1.0), ("PASIG CITY", "EDSA SHAW", 1.0, 2.0, 1.0)]
    spark.createDataFrame(rows, schemas.RESOLVED_LOCATIONS).write.parquet(path)
    assert ingest.initial_locations(star, path) == 1
    assert ingest.initial_locations(star, path) == 0
    assert spark.read.parquet(star.path("staging_locations")).count() == 2
    other = spark.createDataFrame([("X", "Y", 1.0, 2.0, 0.0)], schemas.RESOLVED_LOCATIONS)
    assert load_locations(star, other) == 1


def test_seeding_twice_adds_nothing(star):
    star.seed()
    assert (star.read("dim_direction").count(), star.read("dim_vehicles").count()) == (4, 28)


def test_audit_reports_copies_and_orphans(spark, star):
    fact = spark.createDataFrame(
        [("E1", "nowhere", "NB"), ("E1", None, "NB"), ("E2", "nowhere", "XX")],
        "event_id string, location_id string, direction_id string",
    )
    for c, t in (("event_timestamp", "timestamp_ntz"), ("event_type", "string"), ("event_type_details", "string"),
                 ("lanes_blocked", "int"), ("post", "string"), ("link", "string")):
        fact = fact.selectExpr("*", f"cast(null as {t}) as {c}")
    star.append("fact_events", fact)
    duplicates, orphans = audit(star)
    assert [tuple(r) for r in duplicates.collect()] == [("fact_events", "E1", 2)]
    assert sorted(tuple(r)[1:] for r in orphans.collect()) == [("XX", 1), ("nowhere", 2)]


def test_date_mode_first(spark, star, tmp_path):
    root = write_raw(tmp_path)
    own = ingest.ingest_range(star, root, None, DAY1, DAY2)
    assert {r.date for r in own.vehicles.collect()} == {DAY1, DAY2}
    first = ingest.ingest_range(star, root, None, DAY1, DAY2, date_mode="first")
    assert {r.date for r in first.vehicles.collect()} == {DAY1}


def test_pairs_under_two_first_dates_are_loaded_once(spark, star, tmp_path):
    root, clean = write_raw(tmp_path), str(tmp_path / "clean")
    ingest.ingest_range(star, root, clean, DAY1, DAY2, date_mode="first")
    ingest.ingest_range(star, root, clean, DAY2, DAY2, date_mode="first")
    ingest.load_days(star, clean, DAY1)
    ingest.load_days(star, clean, DAY2)
    pairs = star.read("fact_event_vehicles")
    assert pairs.count() == pairs.select("event_id", "vehicle_type").distinct().count() > 0


def test_read_by_date_lists_only_the_range(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(DAY1, 1), (DAY2, 2), (DAY2, 3)], "date date, n int")
    tables.write_by_date(df, path)
    got = tables.read_by_date(spark, path, "n int, date date", DAY2)
    assert sorted(r.n for r in got.collect()) == [2, 3]
    assert got.inputFiles() and all(f"date={DAY2}" in p for p in got.inputFiles())


def test_loading_a_day_reads_only_that_day_of_the_facts(spark, star, tmp_path):
    root, clean = write_raw(tmp_path), str(tmp_path / "clean")
    ingest.ingest_range(star, root, clean, DAY1, DAY2)
    ingest.load_days(star, clean, DAY1, DAY2)
    files = star.read("fact_events", [DAY2]).inputFiles()
    assert files and all(f"event_date={DAY2}" in p for p in files)
    assert star.read("fact_events", [DAY2]).count() == 2
    assert star.read("fact_events").count() == 5
    assert star.read("fact_events").columns == [f.split()[0] for f in schemas.TABLES["fact_events"][0].split(", ")]


def test_rows_without_a_date_are_compared_with_all(spark, star, tmp_path):
    root = write_raw(tmp_path)
    batch = ingest.ingest_range(star, root, None, DAY1, DAY2)
    # Once without dates, then with: still no pair twice, in either order.
    first = load_warehouse(star, batch.events, batch.vehicles.drop("date"))
    assert first["fact_event_vehicles"] == 6
    assert load_warehouse(star, batch.events, batch.vehicles)["fact_event_vehicles"] == 0
    other = Warehouse(spark, str(tmp_path / "star2"))
    other.seed()
    assert load_warehouse(other, batch.events, batch.vehicles)["fact_event_vehicles"] == 6
    assert load_warehouse(other, batch.events, batch.vehicles.drop("date"))["fact_event_vehicles"] == 0
    assert tables.staged_days(batch.vehicles.selectExpr("cast(null as date) date")) == []


def test_rows_are_seen_without_a_marker_file(spark, tmp_path):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        warehouse = Warehouse(spark, str(tmp_path / "star"))
        for _ in range(2):
            warehouse.seed()
        assert warehouse.read("dim_direction").count() == 4
        batch = ingest.ingest_range(warehouse, write_raw(tmp_path), None, DAY1, DAY2)
        assert load_warehouse(warehouse, batch.events, batch.vehicles)["fact_events"] == 5
        assert set(load_warehouse(warehouse, batch.events, batch.vehicles).values()) == {0}
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_only_the_files_of_the_days_are_listed(spark, star, tmp_path):
    batch = ingest.ingest_range(star, write_raw(tmp_path), str(tmp_path / "clean"), DAY1, DAY2)
    undated = batch.events.where(f"date = '{DAY2}'").selectExpr(
        "concat(event_id, 'x') event_id", "cast(null as date) date", "* except (event_id, date)"
    )
    rows = batch.events.unionByName(undated)
    load_warehouse(star, rows, batch.vehicles)
    days = {p.rsplit("event_date=", 1)[1].split("/")[0] for p in star.read("fact_events", [DAY1]).inputFiles()}
    assert days == {str(DAY1), tables.NO_DATE}
    assert load_warehouse(star, rows, batch.vehicles)["fact_events"] == 0
    clean = tables.read_by_date(spark, str(tmp_path / "clean/events"), "event_id string, date date", DAY2)
    assert {p.rsplit("date=", 1)[1].split("/")[0] for p in clean.inputFiles()} == {str(DAY2)}


def test_places_without_an_answer_are_listed(spark, star):
    events = spark.createDataFrame([("A",), ("B",), ("C",)], "location string")
    short = lambda missing: resolve_with(
        missing.coalesce(1).orderBy("location"), lambda asked: [{"city": "X", "latitude": 1.0, "longitude": 2.0}]
    )
    places = resolve_places(events, star.read("dim_locations"), short)
    assert [r.location for r in places.new_locations.collect()] == ["A"]
    assert sorted(r.location for r in places.unresolved.collect()) == ["B", "C"]


def test_pages_straight_to_the_warehouse(spark, star, tmp_path):
    item = (
        '<div class="timeline-item "><span class="tweet-date"><a href="https://nitter.net/MMDA/status/{}" '
        'title="Jan 1, 2025 · 8:00 AM UTC">x</a></span><div class="tweet-content">{}</div></div>'
    )
    texts = [line for lines in LINES.values() for line in lines]
    pages = spark.createDataFrame(
        [(0, "".join(item.format(i, t) for i, t in enumerate(texts[:2]))),
         (1, "".join(item.format(i, t) for i, t in enumerate(texts[2:])))],
        "page_id long, html string",
    )
    batch = ingest.ingest_pages(star, pages, str(tmp_path / "clean"))
    assert {r.time for r in batch.events.collect()} == {"08:05", "13:00"}
    assert ingest.load_days(star, str(tmp_path / "clean"), DAY1)["fact_events"] == 5


def test_day_folders_can_be_ingested(spark, star, tmp_path):
    root, clean = str(tmp_path / "folders"), str(tmp_path / "clean")
    posts = raw.read_posts(spark, [day_path(write_raw(tmp_path), d) for d in LINES])
    raw.write_day_folders(posts, root)
    ingest.ingest_day_folders(star, root, clean, DAY2, DAY2)
    assert ingest.load_days(star, clean, DAY1, DAY2)["fact_events"] == 2


def test_enrich_locations(spark, star):
    events = spark.createDataFrame([(1, "EDSA SHAW"), (2, "NOWHERE"), (3, "")], "n int, location string")
    located, places = enrich_locations(events, star.read("dim_locations"), gazetteer(spark))
    assert sorted((r.n, r.city or "") for r in located.collect()) == [(1, "MANDALUYONG"), (2, ""), (3, "")]
    assert [r.location for r in places.new_locations.collect()] == ["EDSA SHAW"]
    assert sorted(r.location for r in places.unresolved.collect()) == ["", "NOWHERE"]
