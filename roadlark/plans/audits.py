"""Audits that follow the loads: each batch is looked at once, when it is committed.

A key of a fact holds its date, so copies of it lie in the folders of one day: the keys of
the days a batch has touched are counted, and no others. Of the foreign keys a batch can
only break its own rows'. What a batch's audit finds lies beside its manifest. A later
batch may bring a parent that was missing, so found orphans are compared with the parents
again when they are merged.
"""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from roadlark import schemas
from roadlark.operators.audit import key_copies, orphans
from roadlark.session import empty_table
from roadlark.sources.batches import BATCHES, FOLDER, BatchWarehouse
from roadlark.sources.posts import existing_paths

FOUND = "kind string, subject string, key_value string, found bigint, event_date date"
ORPHAN, COPIES = "orphan", "copies"


def touched(warehouse: BatchWarehouse, batch_id: str) -> dict[str, list]:
    """Days by table that a committed batch has added rows to; [None] for undated tables."""
    manifest = warehouse.manifest(batch_id)
    if manifest is None:
        raise ValueError(f"batch {batch_id!r} is not committed")
    days: dict[str, list] = {}
    for part in manifest["tables"]:
        days.setdefault(part["table_name"], []).append(part["event_date"])
    return days


def audited_folders(warehouse: BatchWarehouse, batch_id: str) -> list[str]:
    """The fact folders whose keys a batch's audit counts: those of the days it touched."""
    committed = warehouse.committed().items()
    days = touched(warehouse, batch_id)
    return [
        path
        for name in schemas.DATED_TABLES
        if name in days
        for path in warehouse._folders(name, committed, [d for d in days[name] if d])
    ]


def audit_batch(warehouse: BatchWarehouse, batch_id: str) -> None:
    """Keeps what the audit of a batch finds; done once, also if it is asked for again."""
    path = warehouse._home(batch_id, "audit")
    if warehouse.files.exists(f"{path}/_SUCCESS"):
        return
    days, spark = touched(warehouse, batch_id), warehouse.spark
    own = {batch_id: warehouse.manifest(batch_id)["attempt"]}
    parts = [empty_table(spark, FOUND)]
    for name, (_, key) in schemas.TABLES.items():
        if name not in days:
            continue
        dated = name in schemas.DATED_TABLES
        rows = _dated(warehouse, name, warehouse.committed(), days[name] if dated else None)
        copies = key_copies(rows, name, [*key, schemas.EVENT_DATE] if dated else key)
        # The day is part of the key here only to say where the copies lie.
        plain = F.substring_index("key_value", "|", 1) if dated else F.col("key_value")
        day = F.substring_index("key_value", "|", -1).try_cast("date") if dated else F.lit(None).cast("date")
        parts.append(
            copies.select(
                F.lit(COPIES).alias("kind"), F.col("table_name").alias("subject"), plain.alias("key_value"),
                F.col("copies").alias("found"), day.alias(schemas.EVENT_DATE),
            )
        )
    for child, column, parent, parent_column in schemas.FOREIGN_KEYS:
        if child in days:
            rows = _dated(warehouse, child, own, None)
            name = f"{child}.{column}->{parent}.{parent_column}"
            lost = orphans(rows, column, warehouse.read(parent), parent_column, name)
            parts.append(
                lost.select(
                    F.lit(ORPHAN).alias("kind"), F.col("relation").alias("subject"), "key_value",
                    F.col("child_rows").alias("found"), F.lit(None).cast("date").alias(schemas.EVENT_DATE),
                )
            )
    # As many tasks as the checks have: their counts and joins run in the writing stage.
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(path)


def _dated(warehouse: BatchWarehouse, name: str, attempts: dict[str, str], days: list | None) -> DataFrame:
    """Rows of some attempts with the day of their folder, of all days or of some."""
    ddl = schemas.TABLES[name][0]
    dated = f", {schemas.EVENT_DATE} DATE" if name in schemas.DATED_TABLES else ""
    paths = warehouse._folders(name, attempts.items(), days)
    if not paths:
        return empty_table(warehouse.spark, ddl + dated)
    reader = warehouse.spark.read.option("basePath", warehouse.path(name))
    return reader.schema(f"{ddl}{dated}, {FOLDER} STRING").parquet(*paths).drop(FOLDER)


def merged_audit(warehouse: BatchWarehouse) -> DataFrame:
    """(kind, subject, key_value, found) over all batches that have been audited: orphans
    whose parent is still missing, with their rows of all batches, and copies of keys as
    the last audit of their day has counted them."""
    spark, found = warehouse.spark, existing_paths(warehouse.spark, [f"{warehouse.root}/{BATCHES}/*/audit"])
    if not found:
        return empty_table(spark, FOUND).drop(schemas.EVENT_DATE)
    all_found = spark.read.schema(FOUND).parquet(*found)
    lost = all_found.where(F.col("kind") == ORPHAN).groupBy("kind", "subject", "key_value").agg(F.sum("found").alias("found"))
    parts = []
    for child, column, parent, parent_column in schemas.FOREIGN_KEYS:
        own = lost.where(F.col("subject") == f"{child}.{column}->{parent}.{parent_column}")
        there = warehouse.read(parent).select(F.col(parent_column).cast("string").alias("key_value"))
        parts.append(own.join(there, "key_value", "left_anti").select(*lost.columns))
    # Rows are only ever added, so the last count of a key is its highest.
    copies = all_found.where(F.col("kind") == COPIES)
    parts.append(copies.groupBy("kind", "subject", "key_value").agg(F.max("found").alias("found")))
    return reduce(DataFrame.unionByName, parts)
