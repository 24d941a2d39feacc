"""From raw files to clean date folders and the warehouse: daily, range, historical."""

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from roadlark import schemas
from roadlark.plans.batch import Batch, Resolver, process_batch
from roadlark.plans.load import load_locations, load_warehouse
from roadlark.session import materialise, spread
from roadlark.sources import posts as raw, records, tables
from roadlark.sources.pages import extract_posts
from roadlark.sources.tables import Warehouse

LARGE_FILE = 128 << 20  # bytes of a multi-line file that one task may read
EVENTS_FOLDER, VEHICLES_FOLDER = "events", "vehicles"

_EVENT_DDL = (
    "event_id STRING, date DATE, time STRING, event_timestamp TIMESTAMP_NTZ, location_id STRING, "
    "city STRING, location STRING, latitude DOUBLE, longitude DOUBLE, accuracy DOUBLE, "
    "direction STRING, type STRING, lanes_blocked INT, involved STRING, post STRING, link STRING"
)
_VEHICLE_DDL = (
    "event_id STRING, vehicle_type STRING, vehicle_count INT, vehicle_group STRING, "
    "suggested_from STRING, is_verified BOOLEAN, date DATE, event_date DATE"
)


def transform(
    posts: DataFrame, warehouse: Warehouse, clean_root: str | None, resolver: Resolver | None = None,
    replace_days: bool = False, groups: tuple[str, ...] = ("source_file",), **options,
) -> Batch:
    """Process raw posts against the warehouse's dimensions, add the locations it
    resolved to them, and write the clean folders."""
    batch = process_batch(
        posts, warehouse.read("dim_locations"), warehouse.read("dim_vehicles"),
        groups=groups, resolver=resolver, **options,
    )
    if resolver is not None:
        # The enriched rows are planned over the dimension as it was plus these rows.
        warehouse.append("dim_locations", batch.new_locations)
    if clean_root is not None:
        tables.write_by_date(batch.events, f"{clean_root}/{EVENTS_FOLDER}", replace_days)
        tables.write_by_date(batch.dated_vehicles, f"{clean_root}/{VEHICLES_FOLDER}", replace_days)
    return batch


def ingest_range(
    warehouse: Warehouse, raw_root: str, clean_root: str, start: dt.date, end: dt.date, **options
) -> Batch:
    """All day files of an inclusive range in one job; missing days are skipped. Times
    are filled inside each file."""
    found = raw.existing_days(warehouse.spark, raw_root, start, end)
    if raw.largest_file(warehouse.spark, found) > LARGE_FILE:
        posts = _written(records.read_posts(warehouse.spark, found))
    else:
        posts = _ordered(raw.read_days(warehouse.spark, raw_root, start, end))
    return transform(posts, warehouse, clean_root, **options)


def ingest_daily(
    warehouse: Warehouse, raw_root: str, clean_root: str, as_of: dt.date | None = None, **options
) -> Batch:
    """The day before ``as_of``, which is today in Manila if it is left out."""
    day = raw.day_before(as_of)
    return ingest_range(warehouse, raw_root, clean_root, day, day, **options)


def ingest_historical(
    warehouse: Warehouse, path: str, clean_root: str, multi_line: bool = True, **options
) -> Batch:
    """One large file with pre-parsed columns, of which only the text is used."""
    if multi_line and raw.largest_file(warehouse.spark, path) > LARGE_FILE:
        posts = _written(records.read_historical(warehouse.spark, path))
    else:
        posts = _ordered(raw.read_historical(warehouse.spark, path, multi_line))
    return transform(posts, warehouse, clean_root, **options)


def _ordered(posts: DataFrame) -> DataFrame:
    """Raw posts with their file order, written once.

    A multi-line file of no more than ``LARGE_FILE`` bytes is read by one task; larger ones
    are read by many (``records``).
    """
    if posts.isEmpty():
        return posts.select("*", F.lit("").alias("source_file"), F.lit(0).cast("bigint").alias("post_seq"))
    return _written(raw.with_file_order(posts))


def _written(posts: DataFrame) -> DataFrame:
    """Posts as a narrow table of their own, parsed by many tasks."""
    return spread(materialise(posts, "raw"))


def ingest_pages(
    warehouse: Warehouse, pages: DataFrame, clean_root: str, order: str = "page_id",
    day: dt.date | None = None, **options,
) -> Batch:
    """Timeline pages straight to clean rows, without CSV files between; times are filled
    in the order of pages and positions."""
    posts = extract_posts(pages, day=day, order=order)
    return transform(posts, warehouse, clean_root, groups=(), **options)


def ingest_day_folders(
    warehouse: Warehouse, raw_root: str, clean_root: str, start: dt.date, end: dt.date, **options
) -> Batch:
    """A date range of the folders that ``write_day_folders`` makes."""
    posts = _ordered(raw.read_day_folders(warehouse.spark, raw_root, start, end))
    return transform(posts, warehouse, clean_root, **options)


def load_days(
    warehouse: Warehouse, clean_root: str, start: dt.date, end: dt.date | None = None
) -> dict[str, int]:
    """Clean rows of a day or range into the warehouse, as one partition-pruned scan;
    returns the rows inserted per table. The clean folders are the staging area: their
    rows stay, and loading a day again inserts nothing, under whichever date a batch has
    written its vehicles."""
    spark = warehouse.spark
    events = tables.read_by_date(spark, f"{clean_root}/{EVENTS_FOLDER}", _EVENT_DDL, start, end)
    vehicles = tables.read_by_date(spark, f"{clean_root}/{VEHICLES_FOLDER}", _VEHICLE_DDL, start, end)
    return load_warehouse(warehouse, events, vehicles)


def load_daily(warehouse: Warehouse, clean_root: str, as_of: dt.date | None = None) -> dict[str, int]:
    return load_days(warehouse, clean_root, raw.day_before(as_of))


def initial_locations(warehouse: Warehouse, path: str) -> int:
    """First load of the location dimension from a Parquet file of resolved places."""
    found = warehouse.spark.read.schema(schemas.RESOLVED_LOCATIONS).parquet(path)
    return load_locations(warehouse, found, truncate_first=True)
