"""New raw files, as they arrive, through the same batch job into the warehouse."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from roadlark import schemas
from roadlark.plans.batch import Resolver
from roadlark.plans.ingest import transform
from roadlark.plans.load import load_warehouse
from roadlark.session import materialise, spread
from roadlark.sources.posts import READ_OPTIONS
from roadlark.sources.tables import Warehouse
from roadlark.streaming.clean import compact, write_pending


def post_stream(spark: SparkSession, raw_root: str, max_files: int | None = None) -> DataFrame:
    """Raw posts of files that appear below ``raw_root``, at any folder depth."""
    reader = spark.readStream.schema(schemas.RAW_POSTS).options(**READ_OPTIONS)
    reader = reader.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(raw_root).select("*", F.col("_metadata.file_path").alias("source_file"))


def start_ingest(
    warehouse: Warehouse,
    raw_root: str,
    checkpoint: str,
    clean_root: str | None = None,
    resolver: Resolver | None = None,
    max_files: int | None = None,
    query: str = "ingest",
    **options,
) -> StreamingQuery:
    """Process every file not seen before, then stop.

    The checkpoint remembers the files. A micro-batch that is repeated after a failure,
    or a post that occurs in several files, inserts nothing twice because the load only
    inserts absent keys; that also holds for posts without an event time, which a
    watermark could not cover. The clean folders, if asked for, are keyed by ``query``, which
    names the checkpoint, and the batch: a repeated batch replaces its rows. ``run_ingest``
    compacts them into days.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn("post_seq", F.monotonically_increasing_id())
        posts = spread(materialise(ordered, f"raw-{batch_id}"))
        done = transform(posts, warehouse, None, resolver, **options)
        if clean_root is not None:
            events, vehicles = write_pending(done, clean_root, query, batch_id)
        else:
            events, vehicles = materialise(done.events, "events"), materialise(done.dated_vehicles, "vehicles")
        load_warehouse(warehouse, events, vehicles)

    return (
        post_stream(warehouse.spark, raw_root, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_ingest(
    warehouse: Warehouse, raw_root: str, checkpoint: str, clean_root: str | None = None, query: str = "ingest", **options
) -> None:
    """Processes what is new and compacts the clean folders, if there are any."""
    start_ingest(warehouse, raw_root, checkpoint, clean_root, query=query, **options).awaitTermination()
    if clean_root is not None:
        compact(warehouse.spark, clean_root, query)


def first_of_each_event(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Streaming rows without repeats of an event id, for sinks that cannot look up what
    they hold.

    A row counts at its ``event_timestamp``; without one at the last second of its ``date``,
    so that it is late only when its whole day is. Rows later than ``delay`` behind the
    newest of the batches before are dropped. As an id tells its event's time, a repeat is
    either late or still remembered, and the state holds ``delay`` worth of ids. Rows with
    neither are never late; their ids are remembered for good.
    """
    at = F.col("event_timestamp").cast("timestamp")
    if "date" in events.columns:
        day_end = F.col("date").cast("timestamp") + F.expr("interval 86399 seconds")
        at = F.coalesce(at, day_end)
    placed = events.withColumn("_at", at)
    timed = placed.where(F.col("_at").isNotNull()).withWatermark("_at", delay)
    undated = placed.where(F.col("_at").isNull()).dropDuplicates(["event_id"])
    return timed.dropDuplicatesWithinWatermark(["event_id"]).unionByName(undated).drop("_at")


def remembered_ids(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(event_id): what a stopped stream of ``first_of_each_event`` still knows, from its state."""
    states = [
        spark.read.format("statestore").option("operatorId", n).load(checkpoint).select("key.event_id") for n in (0, 1)
    ]
    return states[0].union(states[1])
