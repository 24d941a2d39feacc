"""Clean folders of a stream, in which a repeated micro-batch replaces itself.

A micro-batch may run again after a failure. Its rows first go to a folder of their own,
named after the query and the batch, which a repetition overwrites whole. Afterwards such
folders are compacted into the folders of days. Rows keep the query and batch they come
from, so a compaction that broke off is simply run again: what it had already added is
left out and added anew.

    <root>/_pending/<query>/<batch>/events, vehicles
    <root>/events/date=<day>/, <root>/vehicles/date=<day>/
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadlark.plans.batch import Batch
from roadlark.plans.ingest import _EVENT_DDL, _VEHICLE_DDL, EVENTS_FOLDER, VEHICLES_FOLDER
from roadlark.session import empty_table, materialise
from roadlark.sources.batches import Files, batch_name
from roadlark.sources.posts import existing_paths
from roadlark.sources.tables import NO_DATE, write_by_date

PENDING = "_pending"
ORIGIN = ["_query", "_batch"]
ORIGIN_DDL = "_query STRING, _batch BIGINT"
TABLES = {EVENTS_FOLDER: _EVENT_DDL, VEHICLES_FOLDER: _VEHICLE_DDL}


def pending_path(root: str, query: str, batch_id: int | str = "*") -> str:
    return f"{root}/{PENDING}/{batch_name(query)}/{batch_id}"


def write_pending(batch: Batch, root: str, query: str, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """Replaces what the micro-batch has written before; returns its events and vehicles as
    written."""
    home, spark, read = pending_path(root, query, batch_id), batch.parsed.sparkSession, []
    for name, rows in ((EVENTS_FOLDER, batch.events), (VEHICLES_FOLDER, batch.dated_vehicles)):
        rows.write.mode("overwrite").parquet(f"{home}/{name}")
        read.append(spark.read.schema(TABLES[name]).parquet(f"{home}/{name}"))
    # Only a batch with both tables is compacted.
    Files(spark).put(f"{home}/written", "")
    return read[0], read[1]


def whole_batches(spark: SparkSession, root: str, query: str) -> list[str]:
    """The folders of micro-batches that have been written as a whole."""
    return sorted(p.rsplit("/", 1)[0] for p in existing_paths(spark, [f"{pending_path(root, query)}/written"]))


def _pending(spark: SparkSession, folders: list[str], query: str, table: str) -> DataFrame:
    ddl = TABLES[table]
    if not folders:
        return empty_table(spark, f"{ddl}, {ORIGIN_DDL}")
    rows = spark.read.schema(ddl).parquet(*[f"{f}/{table}" for f in folders])
    number = F.regexp_extract(F.col("_metadata.file_path"), rf"/{PENDING}/[^/]+/(\d+)/", 1).cast("bigint")
    return rows.select("*", F.lit(query).alias("_query"), number.alias("_batch"))


def _days(spark: SparkSession, root: str, table: str, days: list[dt.date | None] | None) -> DataFrame:
    """Compacted rows of some days, or of all, with their origin."""
    names = ["date=*"] if days is None else [f"date={d or NO_DATE}" for d in days]
    found = existing_paths(spark, [f"{root}/{table}/{n}" for n in names])
    ddl = f"{TABLES[table]}, {ORIGIN_DDL}"
    if not found:
        return empty_table(spark, ddl)
    columns = [f.name for f in T.StructType.fromDDL(ddl)]
    return spark.read.option("basePath", f"{root}/{table}").schema(ddl).parquet(*found).select(*columns)


def _without(rows: DataFrame, query: str, folders: list[str]) -> DataFrame:
    """``rows`` but for those that come from these micro-batches."""
    numbers = [int(f.rsplit("/", 1)[1]) for f in folders]
    return rows.where(~F.coalesce((F.col("_query") == query) & F.col("_batch").isin(numbers), F.lit(False)))


def compact(spark: SparkSession, root: str, query: str) -> list[dt.date | None]:
    """Moves the micro-batches of a query into the folders of days and returns these days;
    only the days they have rows of are read and written."""
    folders, touched = whole_batches(spark, root, query), set()
    if not folders:
        return []
    for table in TABLES:
        fresh = _pending(spark, folders, query, table)
        days = [row["date"] for row in fresh.select("date").distinct().collect()]
        kept = _without(_days(spark, root, table, days), query, folders)
        # The days are read and replaced: what they will hold is written aside first.
        whole = materialise(kept.unionByName(fresh), f"compacted-{table}")
        write_by_date(whole, f"{root}/{table}", replace_days=True)
        touched.update(days)
    for folder in folders:
        Files(spark).delete(folder)
    return sorted(touched, key=lambda d: (d is None, d or dt.date.min))


def read_clean(spark: SparkSession, root: str, query: str, table: str) -> DataFrame:
    """All clean rows, compacted or not, each once, also while a compaction runs or after
    one has broken off."""
    folders = whole_batches(spark, root, query)
    compacted = _without(_days(spark, root, table, None), query, folders)
    return compacted.unionByName(_pending(spark, folders, query, table)).drop(*ORIGIN)
