"""One query per capability, over whole tables of a data folder."""

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import HELD_BACK, SECOND_LOAD, Inputs
from roadlark import schemas
from roadlark.functions import fields, keys
from roadlark.operators import locations, upsert, vehicles
from roadlark.operators.audit import fk_audit, pk_audit
from roadlark.operators.directions import direction_lookup, fact_rows
from roadlark.operators.fill import fill_event_time
from roadlark.operators.fuzzy import best_matches
from roadlark.operators.parse import parse_posts
from roadlark.plans.batch import process_batch
from roadlark.plans import ingest, resolving
from roadlark.plans.ingest import EVENTS_FOLDER, ingest_historical
from roadlark.plans.load import load_warehouse
from roadlark.plans.audits import audit_batch, merged_audit
from roadlark.session import empty_table, fresh_path, materialise
from roadlark.sources import pages as timeline, posts as raw, tables
from roadlark.sources.batches import BatchWarehouse, Files
from roadlark.sources.records import read_historical
from roadlark.sources.tables import Warehouse, seed_directions, seed_vehicles
from roadlark.streaming.clean import read_clean
from roadlark.streaming.incremental import first_of_each_event, run_ingest, start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Inputs(spark, folder))
    return build


def parsed(t: Inputs) -> DataFrame:
    return parse_posts(t.posts(), carry=("post_seq",))


def bronze(t: Inputs) -> DataFrame:
    """The parsed posts as a written table, for queries that read them several times."""
    return materialise(parsed(t), "parsed")


def located(t: Inputs) -> DataFrame:
    """Parsed posts with the best dimension row of their location."""
    return locations.known_locations(parsed(t), locations.one_row_per_location(t.dim_locations()))


def listed_vehicles(t: Inputs) -> DataFrame:
    return vehicles.explode_vehicles(bronze(t), ("date",))


def staged_vehicles(t: Inputs) -> DataFrame:
    return vehicles.classify_vehicles(listed_vehicles(t), seed_vehicles(t.spark))


def with_second_load(before: DataFrame, inserted: DataFrame) -> DataFrame:
    """The table after a second load; ``inserted`` marks its new rows."""
    return before.withColumn("inserted", F.lit(False)).unionByName(
        inserted.withColumn("inserted", F.lit(True))
    )


# ---- posts and their fields ------------------------------------------------------


@query
def posts(t):
    return t.posts()


@query
def parse_time(t):
    return parsed(t).select("post_seq", "time")


@query
def parse_lanes(t):
    return parsed(t).select("post_seq", "lanes_blocked")


@query
def parse_type(t):
    return parsed(t).select("post_seq", "type")


@query
def parse_direction(t):
    return parsed(t).select("post_seq", "direction")


@query
def parse_location(t):
    return parsed(t).select("post_seq", "location")


@query
def parse_participants(t):
    text = fields.participants_text(fields.post_text(F.col("content")))
    return t.posts().select("post_seq", F.nullif(text, F.lit("")).alias("participants"))


@query
def normalise_involved(t):
    return parsed(t).select("post_seq", "involved")


@query
def event_id(t):
    return parsed(t).select("post_seq", "event_id")


@query
def parse_dates(t):
    texts = t.date_texts()
    written = fields.post_date(F.col("written"), texts.schema["written"].dataType)
    return texts.select("event_id", "written", written.alias("date"))


@query
def parse_all_fields(t):
    return parsed(t)


@query
def forward_fill_time(t):
    filled = fill_event_time(bronze(t), "post_seq")
    return filled.select("post_seq", "time", "event_timestamp")


@query
def forward_fill_per_day(t):
    filled = fill_event_time(bronze(t), "post_seq", groups=("date",))
    return filled.select("post_seq", "date", "time", "event_timestamp")


# ---- locations -------------------------------------------------------------------


@query
def known_locations(t):
    known = locations.known_locations(parsed(t), t.dim_locations())
    return known.select("post_seq", *locations.DIM_COLUMNS)


@query
def missing_locations(t):
    return locations.missing_locations(parsed(t), t.dim_locations())


@query
def resolve_locations(t):
    missing = locations.missing_locations(parsed(t), t.dim_locations())
    return locations.resolve_from_gazetteer(missing, t.gazetteer(), t.city_points())


@query
def resolve_in_batches(t):
    """Thousands of places asked in batches of a service that fails for the first batch
    and has no answer for some places."""
    places = t.part_names().select(F.col("vehicle_type").alias("location"))
    first = places.agg(F.min("location")).first()[0]

    def service(asked):
        if first in asked:
            raise TimeoutError("too busy")
        answer = lambda p: {"city": "Pasig", "latitude": float(len(p)), "longitude": 121.0, "confidence": "Medium"}
        return [answer(p) if len(p) % 3 else None for p in asked]

    log = fresh_path(t.spark, "answers")
    done = resolving.resolve_in_batches(places, service, log, tries=2, round_batches=4)
    found = done.found.withColumn("attempts", F.lit(1))
    lost = done.unresolved.select(
        F.lit(None).cast("string").alias("city"), "location", *[F.lit(None).cast("double").alias(c) for c in ("latitude", "longitude", "accuracy")],
        "attempts",
    )
    return found.unionByName(lost)


@query
def upsert_locations(t):
    missing = locations.missing_locations(parsed(t), t.dim_locations())
    resolved = locations.resolve_from_gazetteer(missing, t.gazetteer(), t.city_points())
    return with_second_load(t.dim_locations(), upsert.new_locations(resolved, t.dim_locations()))


# ---- vehicles --------------------------------------------------------------------


@query
def explode_vehicles(t):
    return vehicles.explode_vehicles(parsed(t), ("post_seq",))


@query
def vehicle_suggestions(t):
    verified = vehicles.verified_types(seed_vehicles(t.spark))
    unknown = vehicles.unknown_types(listed_vehicles(t), verified)
    found = vehicles.suggest_types(unknown, verified)
    return found.withColumn("match_score", F.round("match_score", 9))


@query
def suggest_large_dimension(t):
    """The best of thousands of types for thousands of names, by index."""
    names = t.part_names().select(F.col("vehicle_type").alias("name"))
    types = t.part_types().toDF("candidate", "candidate_group")
    found = best_matches(names, types, vehicles.match_score).found
    return found.select(
        F.col("name").alias("vehicle_type"), F.col("candidate").alias("suggested_from"),
        F.col("candidate_group").alias("vehicle_group"), F.round("score", 9).alias("match_score"),
    )


@query
def classify_vehicles(t):
    return staged_vehicles(t)


@query
def first_date_vehicles(t):
    """Vehicle rows all dated with the first date of the batch."""
    batch = process_batch(t.posts(), t.dim_locations(), seed_vehicles(t.spark), date_mode="first")
    return batch.vehicles


@query
def seed_coverage(t):
    """How often each seeded type occurs; the seeds are written twice and stay unique."""
    warehouse = Warehouse(t.spark, fresh_path(t.spark, "seeded"))
    warehouse.seed()
    warehouse.seed()
    seen = listed_vehicles(t).groupBy("vehicle_type").agg(
        F.count("*").alias("mentions"), F.sum("vehicle_count").alias("vehicles")
    )
    return (
        warehouse.read("dim_vehicles")
        .join(seen, "vehicle_type", "left")
        .select(
            "vehicle_type", "vehicle_group", "suggested_from", "is_verified",
            F.coalesce("mentions", F.lit(0)).alias("mentions"),
            F.coalesce("vehicles", F.lit(0)).alias("vehicles"),
        )
    )


# ---- facts -----------------------------------------------------------------------


@query
def event_type(t):
    return parsed(t).select("post_seq", fields.event_type(F.col("type")).alias("event_type"))


@query
def direction_ids(t):
    found = direction_lookup(parsed(t), seed_directions(t.spark))
    return found.select("post_seq", "direction", "direction_id")


def _events_before_and_new(t):
    """Facts of the first days, and what a second load of all posts, each of them twice,
    adds to them."""
    staged = locations.known_locations(bronze(t), t.dim_locations())
    directions = seed_directions(t.spark)
    first = staged.where(F.col("date") < SECOND_LOAD)
    empty = empty_table(t.spark, schemas.TABLES["fact_events"][0])
    before = upsert.new_events(first, directions, empty)
    return before, upsert.new_events(staged.unionByName(staged), directions, before)


@query
def upsert_events(t):
    return with_second_load(*_events_before_and_new(t))


@query
def upsert_dim_vehicles(t):
    seeds = seed_vehicles(t.spark)
    return with_second_load(seeds, upsert.new_vehicle_types(staged_vehicles(t), seeds))


@query
def upsert_event_vehicles(t):
    staged = materialise(staged_vehicles(t), "vehicles")
    empty = empty_table(t.spark, schemas.TABLES["fact_event_vehicles"][0])
    before = upsert.new_event_vehicles(staged.where(F.col("date") < SECOND_LOAD), empty)
    return with_second_load(before, upsert.new_event_vehicles(staged, before))


def _staged_star(t) -> dict[str, DataFrame]:
    """Star tables as plain staging rows, so that both audits have something to find."""
    rows = bronze(t)
    events = fact_rows(locations.known_locations(rows, t.dim_locations()), seed_directions(t.spark))
    listed = vehicles.explode_vehicles(rows)
    staged = materialise(vehicles.classify_vehicles(listed, seed_vehicles(t.spark)), "vehicles")
    return {
        "dim_locations": t.dim_locations(),
        "dim_direction": seed_directions(t.spark),
        "dim_vehicles": seed_vehicles(t.spark),
        "fact_events": events,
        "fact_event_vehicles": staged.select(
            keys.event_vehicle_id(F.col("event_id"), F.col("vehicle_type")).alias("fev_id"),
            "event_id", "vehicle_type", "vehicle_count",
        ),
    }


@query
def pk_violations(t):
    return pk_audit(_staged_star(t))


@query
def fk_violations(t):
    return fk_audit(_staged_star(t))


# ---- whole jobs ------------------------------------------------------------------


def _batch(t):
    resolver = lambda missing: locations.resolve_from_gazetteer(missing, t.gazetteer(), t.city_points())
    return process_batch(t.posts(), t.dim_locations(), seed_vehicles(t.spark), resolver=resolver)


@query
def batch_events(t):
    return _batch(t).events


@query
def batch_vehicles(t):
    return _batch(t).vehicles


@query
def fact_flow(t):
    """Flagship: raw posts to fact rows in one plan."""
    return fact_rows(located(t), seed_directions(t.spark))


@query
def load_star(t):
    """Event facts after a batch was loaded into an empty warehouse, twice."""
    warehouse = Warehouse(t.spark, fresh_path(t.spark, "star"))
    warehouse.seed()
    warehouse.append("dim_locations", t.dim_locations())
    batch = _batch(t)
    warehouse.append("dim_locations", batch.new_locations)
    events, vehicle_rows = materialise(batch.events, "events"), materialise(batch.vehicles, "vehicles")
    for _ in range(2):
        load_warehouse(warehouse, events, vehicle_rows)
    listed = warehouse.read("fact_event_vehicles").groupBy("event_id").agg(
        F.count("*").alias("vehicle_types"), F.sum("vehicle_count").alias("vehicles")
    )
    return warehouse.read("fact_events").join(listed, "event_id", "left")


# ---- batches ---------------------------------------------------------------------


class Killed(Exception):
    """Stands for a driver that dies."""


def _staged_batches(t) -> tuple[BatchWarehouse, Callable[[], BatchWarehouse]]:
    """A warehouse in which the first days are committed and all days are staged as a
    second batch, and how another process opens it."""
    root = fresh_path(t.spark, "star")
    open_again = lambda: BatchWarehouse(t.spark, root)
    warehouse = open_again()
    warehouse.seed()
    batch = _batch(t)
    events, rows = materialise(batch.events, "events"), materialise(batch.dated_vehicles, "vehicles")
    early = F.col("date") < SECOND_LOAD
    warehouse.stage("first", locations=t.dim_locations(), events=events.where(early), vehicles=rows.where(early))
    warehouse.load("first")
    warehouse.stage("second", locations=batch.new_locations, events=events, vehicles=rows)
    return warehouse, open_again


def _fact_keys(warehouse: BatchWarehouse, step: str) -> DataFrame:
    events = warehouse.read("fact_events").select(
        F.lit("fact_events").alias("table_name"), F.col("event_id").alias("key"), F.lit(None).cast("int").alias("vehicle_count")
    )
    pairs = warehouse.read("fact_event_vehicles").select(
        F.lit("fact_event_vehicles").alias("table_name"), F.col("fev_id").alias("key"), "vehicle_count"
    )
    return materialise(events.unionByName(pairs).withColumn("step", F.lit(step)), step)


@query
def replay_unmarked_batch(t):
    """What readers see when a load dies between its facts, and after its batch is replayed."""
    warehouse, open_again = _staged_batches(t)

    def dies(table):
        if table == "fact_events":
            raise Killed

    try:
        warehouse.load("second", after=dies)
    except Killed:
        pass
    broken = _fact_keys(open_again(), "broken")
    if open_again().recover() != {"second": "replayed"}:
        raise AssertionError("the batch without a mark was not replayed")
    return broken.unionByName(_fact_keys(open_again(), "replayed"))


@query
def staged_locations(t):
    """Resolved places staged by two batches, the second with those of the first again."""
    warehouse = BatchWarehouse(t.spark, fresh_path(t.spark, "star"))
    missing = locations.missing_locations(bronze(t), t.dim_locations())
    found = materialise(locations.resolve_from_gazetteer(missing, t.gazetteer(), t.city_points()), "resolved")
    for name, rows in (("first", found.where("location < 'D'")), ("second", found)):
        warehouse.stage(name, locations=rows)
    warehouse.load("first")
    before = materialise(warehouse.read("dim_locations"), "before")
    warehouse.load("second")
    after = warehouse.read("dim_locations")
    batch = F.when(F.col("_there"), "first").otherwise("second").alias("batch_id")
    known = before.select("location_id", F.lit(True).alias("_there"))
    return after.join(known, "location_id", "left").select(*after.columns, batch)


@query
def load_counts(t):
    """Rows by table and day as the manifests of two batches tell them."""
    warehouse, _ = _staged_batches(t)
    warehouse.load("second")
    return warehouse.counts()


@query
def audit_after_load(t):
    """Both audits, each batch's own part done when it was loaded, then merged."""
    warehouse, open_again = _staged_batches(t)
    audit_batch(warehouse, "first")
    warehouse.load("second")
    audit_batch(open_again(), "second")
    return merged_audit(open_again())


# ---- files and pages -------------------------------------------------------------


@query
def daily_paths(t):
    """The raw file of every day from the first post to the last, with its post count."""
    posts = t.posts()
    per_day = posts.groupBy(F.col("created_at").alias("day")).agg(F.count("*").alias("posts"))
    span = posts.agg(F.min("created_at").alias("first"), F.max("created_at").alias("last"))
    days = span.select(F.explode(F.sequence("first", "last")).alias("day"))
    return days.join(per_day, "day", "left").select(
        "day",
        raw.day_file("raw/scrape", F.col("day")).alias("path"),
        F.coalesce("posts", F.lit(0)).alias("posts"),
    )


@query
def csv_round_trip(t):
    """Posts through the per-day CSV folders and back, for a range of days."""
    root = fresh_path(t.spark, "csv")
    raw.write_day_folders(t.posts(), root)
    return raw.read_day_folders(t.spark, root, dt.date(2024, 1, 5), dt.date(2024, 1, 20))


def _historical_rows(posts: DataFrame) -> DataFrame:
    blank = F.lit(None)
    return posts.select(
        F.col("created_at").alias("Date"), blank.cast("string").alias("Time"),
        F.lit("Somewhere").alias("City"), blank.cast("string").alias("Location"),
        F.lit(0.5).alias("Latitude"), F.lit(0.5).alias("Longitude"), F.lit(1.0).alias("High_Accuracy"),
        F.lit("XX").alias("Direction"), blank.cast("string").alias("Type"), F.lit(9).alias("Lanes_Blocked"),
        blank.cast("string").alias("Involved"), F.col("content").alias("Tweet"),
        F.col("tweetlinkid").alias("Source"),
    )


@query
def historical_round_trip(t):
    """A historical file with pre-parsed columns through its own ingest, to clean rows."""
    path, clean = fresh_path(t.spark, "historical"), fresh_path(t.spark, "clean")
    file = _historical_rows(t.posts())
    file.write.options(**raw.WRITE_OPTIONS).csv(path)
    warehouse = Warehouse(t.spark, fresh_path(t.spark, "star"))
    warehouse.seed()
    ingest_historical(warehouse, f"{path}/part-*", clean)
    events = t.spark.read.parquet(f"{clean}/events")
    return events.select("event_id", "date", "location", "direction", "type", "lanes_blocked", "involved", "post", "link")


def _raw_days(t) -> tuple[Warehouse, str, str]:
    """A warehouse with known places, one raw file for each day in the order of its posts,
    and a root for clean folders."""
    spark = t.spark
    root, star, clean = (fresh_path(spark, n) for n in ("raw", "star", "clean"))
    warehouse = Warehouse(spark, star)
    warehouse.seed()
    warehouse.append("dim_locations", t.dim_locations())
    day = F.col("created_at")
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    rows = t.posts().withColumns({n: F.date_format(day, f) for n, f in parts.items()})
    # A day is in one task, so in one file, and no task has more than its days. In the order
    # the writer wants, so that it does not sort again and lose that of the posts.
    rows = rows.repartition(*parts).sortWithinPartitions(*parts, "post_seq")
    rows.select("content", "tweetlinkid", "created_at", *parts).write.options(**raw.WRITE_OPTIONS).partitionBy(*parts).csv(root)
    return warehouse, root, clean


@query
def daily_ingest(t):
    """All columns of the clean events of the day before a given one."""
    warehouse, root, clean = _raw_days(t)
    as_of = dt.date(2024, 1, 11)
    ingest.ingest_daily(warehouse, root, clean, as_of)
    day = raw.day_before(as_of)
    return tables.read_by_date(t.spark, f"{clean}/events", ingest._EVENT_DDL, day).select(*schemas.EVENT_COLUMNS)


@query
def range_ingest(t):
    """Clean events and their facts of a range most of whose days have no file."""
    warehouse, root, clean = _raw_days(t)
    start, end = dt.date(2023, 12, 1), dt.date(2024, 1, 15)
    ingest.ingest_range(warehouse, root, clean, start, end)
    ingest.load_days(warehouse, clean, start, end)
    events = tables.read_by_date(t.spark, f"{clean}/events", ingest._EVENT_DDL, start, end)
    facts = warehouse.read("fact_events").select("event_id", "event_type", "direction_id")
    return events.select(*schemas.EVENT_COLUMNS).join(facts, "event_id", "left")


@query
def initial_locations(t):
    """The dimension after its first load from a file of resolved places, loaded twice."""
    warehouse, path = Warehouse(t.spark, fresh_path(t.spark, "star")), fresh_path(t.spark, "places")
    missing = locations.missing_locations(bronze(t), t.dim_locations())
    locations.resolve_from_gazetteer(missing, t.gazetteer(), t.city_points()).write.parquet(path)
    for _ in range(2):
        ingest.initial_locations(warehouse, path)
    return warehouse.read("dim_locations")


@query
def historical_parallel(t):
    """One historical file whose fields hold quotes, commas and line breaks, by many tasks."""
    posts = t.posts()
    text = F.concat(F.lit('He said "stop",\n'), "content", F.lit('\n"'), F.col("post_seq").cast("string"))
    path = fresh_path(t.spark, "historical")
    rows = _historical_rows(posts.withColumn("content", F.when(F.col("post_seq") % 3 == 0, F.col("content")).otherwise(text)))
    rows.coalesce(1).write.options(**raw.WRITE_OPTIONS).csv(path)
    found = read_historical(t.spark, f"{path}/part-*", split_bytes=64 << 10)
    return found.select("content", "tweetlinkid", "created_at")


@query
def partition_round_trip(t):
    """Parsed events through the date folders: appended, replaced whole, a range read back."""
    path = fresh_path(t.spark, "clean")
    events = bronze(t)
    tables.write_by_date(events, path)
    tables.write_by_date(events, path, replace_days=True)
    ddl = ", ".join(f"{name} {kind}" for name, kind in events.dtypes)
    return tables.read_by_date(t.spark, path, ddl, dt.date(2024, 1, 5), dt.date(2024, 1, 20))


@query
def extract_posts(t):
    return timeline.extract_posts(t.pages())


@query
def extract_day(t):
    return timeline.extract_posts(t.pages(), day=dt.date(2024, 1, 10))


@query
def fill_over_pages(t):
    """Times filled over the posts of pages with very large numbers."""
    pages = t.pages().withColumn("page_id", F.col("page_id") + (1 << 60))
    posts = timeline.extract_posts(pages, order="page_id")
    filled = fill_event_time(materialise(parse_posts(posts, carry=("post_seq",)), "parsed"), "post_seq")
    return filled.select("post_seq", "link", "time")


@query
def resolve_links(t):
    pages = t.pages().select("page_id", timeline.next_link(F.col("html")).alias("link"))
    return pages.withColumn("next_url", timeline.resolve_link(F.col("link")))


@query
def incremental_ingest(t):
    """Facts after two incremental runs over a raw folder that grew in between."""
    spark = t.spark
    root, star, state = (fresh_path(spark, n) for n in ("raw", "star", "state"))
    warehouse = Warehouse(spark, star)
    warehouse.seed()
    posts = t.posts()
    raw.write_day_folders(posts.where(F.col("created_at") < SECOND_LOAD), root)
    run_ingest(warehouse, root, state)
    # The later days arrive, together with a second copy of every post.
    raw.write_day_folders(posts, root, mode="append")
    run_ingest(warehouse, root, state)
    return warehouse.read("fact_events").select(
        "event_id", "event_type", "event_type_details", "direction_id", "lanes_blocked", "post"
    )


@query
def repeated_batch(t):
    """Clean events of a stream whose one micro-batch is run a second time, as after a
    failure before its commit."""
    spark = t.spark
    root, star, state, clean = (fresh_path(spark, n) for n in ("raw", "star", "state", "clean"))
    warehouse = Warehouse(spark, star)
    warehouse.seed()
    raw.write_day_folders(t.posts(), root)
    start_ingest(warehouse, root, state, clean).awaitTermination()
    Files(spark).delete(f"{state}/commits/0")
    Files(spark).delete(f"{state}/commits/.0.crc")
    run_ingest(warehouse, root, state, clean)
    events = read_clean(spark, clean, "ingest", EVENTS_FOLDER)
    return events.select("event_id", "date", "location", "direction", "type", "lanes_blocked", "involved", "post", "link")


@query
def stream_first_of_each_event(t):
    """Events that a stream without a look-up lets through in two runs: the second brings
    every row again, and days that are late by then."""
    spark = t.spark
    folder, state, out = (fresh_path(spark, n) for n in ("arrived", "state", "out"))
    events = bronze(t).select("event_id", "event_timestamp", "date")
    held_back = F.day("date") % HELD_BACK == 0
    for rows in (events.where((F.col("date") < SECOND_LOAD) & ~held_back), events):
        rows.write.mode("append").parquet(folder)
        stream = first_of_each_event(spark.readStream.schema(events.schema).parquet(folder))
        sink = stream.writeStream.option("checkpointLocation", state).trigger(availableNow=True)
        sink.format("parquet").start(out).awaitTermination()
    return spark.read.schema(events.schema).parquet(out)
