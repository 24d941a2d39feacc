"""A warehouse that grows by whole batches.

Each batch has a folder with its staged rows and, once all its tables are written, a
manifest. Data files lie in folders named after the batch and the attempt that wrote them,
and a reader takes the folders that a manifest names; whatever a broken attempt has left is
never seen. The manifest is put in place by one rename, so a batch is there or is not.

    <root>/_batches/<batch>/staging/<table>/        staged rows, cleared after the commit
    <root>/_batches/<batch>/staged.json             the batch is staged as a whole
    <root>/_batches/<batch>/manifest.json           the batch is committed
    <root>/<table>/[event_date=<day>/]batch=<batch>.<attempt>/

One writer at a time; any number of readers.
"""

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from roadlark import schemas
from roadlark.operators import upsert
from roadlark.session import empty_table
from roadlark.sources.posts import existing_paths
from roadlark.sources.tables import NO_DATE, Warehouse, seed_directions, seed_vehicles, staged_days

BATCHES = "_batches"
FOLDER = "batch"
MANIFEST_ROWS = "batch_id string, attempt string, table_name string, event_date date, files bigint, rows bigint"
STAGED_TABLES = ("locations", "events", "vehicles")


def batch_name(batch_id: str) -> str:
    """Checks the id, which becomes part of folder names."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", batch_id):
        raise ValueError(f"a batch id has letters, digits, - and _ only, not {batch_id!r}")
    return batch_id


class Files:
    """Small files and folders on any Hadoop file system."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self.jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.conf), found

    def exists(self, path: str) -> bool:
        system, found = self._at(path)
        return system.exists(found)

    def delete(self, path: str) -> None:
        system, found = self._at(path)
        system.delete(found, True)

    def read(self, path: str) -> str:
        system, found = self._at(path)
        stream = system.open(found)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> bool:
        """Writes a file that appears whole, by a rename; False if it is there already."""
        system, found = self._at(path)
        written = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
        stream = system.create(written, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if system.exists(found) or not system.rename(written, found):
            system.delete(written, False)
            return False
        return True


class BatchWarehouse(Warehouse):
    """The star schema, of which only committed batches are seen.

    ``stage`` keeps a batch's rows, ``load`` inserts those whose keys are absent and
    commits, ``recover`` finishes or clears what a broken run has left. Each may be called
    again after it broke off anywhere.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.files = Files(spark)

    # ---- the log -----------------------------------------------------------------

    def _home(self, batch_id: str, name: str = "") -> str:
        return f"{self.root}/{BATCHES}/{batch_name(batch_id)}" + (f"/{name}" if name else "")

    def _named(self, name: str) -> list[str]:
        """The batches that have a file or folder of this name: one listing."""
        found = existing_paths(self.spark, [f"{self.root}/{BATCHES}/*/{name}"])
        return sorted(p.rsplit("/", 2)[1] for p in found)

    def manifest(self, batch_id: str) -> dict | None:
        path = self._home(batch_id, "manifest.json")
        return json.loads(self.files.read(path)) if self.files.exists(path) else None

    def manifests(self) -> DataFrame:
        """(batch_id, attempt, table_name, event_date, files, rows) of all committed batches."""
        found = existing_paths(self.spark, [f"{self.root}/{BATCHES}/*/manifest.json"])
        if not found:
            return empty_table(self.spark, MANIFEST_ROWS)
        shape = T.StructType.fromDDL(
            "batch_id string, attempt string, tables array<struct<table_name: string, event_date: date, files: bigint, rows: bigint>>"
        )
        log = self.spark.read.schema(shape).option("multiLine", True).json(found)
        return log.select("batch_id", "attempt", F.explode("tables").alias("t")).select("batch_id", "attempt", "t.*")

    def committed(self) -> dict[str, str]:
        """batch id -> the attempt that counts. One small row for each batch."""
        rows = self.spark.read.schema("batch_id string, attempt string").option("multiLine", True)
        found = existing_paths(self.spark, [f"{self.root}/{BATCHES}/*/manifest.json"])
        return {r.batch_id: r.attempt for r in rows.json(found).collect()} if found else {}

    def unmarked(self) -> list[str]:
        """Batches that have been begun but not committed, in the order of their ids."""
        begun = {p.rstrip("/").rsplit("/", 1)[1] for p in existing_paths(self.spark, [f"{self.root}/{BATCHES}/*"])}
        return sorted(begun.difference(self._named("manifest.json")))

    # ---- reading -----------------------------------------------------------------

    def read(self, name: str, days: list[dt.date] | None = None) -> DataFrame:
        """A table as its committed batches make it; of a fact table, if ``days`` are given,
        only the rows a staging table of these days could meet again."""
        ddl = schemas.TABLES[name][0]
        paths = self._folders(name, self.committed().items(), days)
        if not paths:
            return empty_table(self.spark, ddl)
        dated = f", {schemas.EVENT_DATE} DATE" if name in schemas.DATED_TABLES else ""
        reader = self.spark.read.option("basePath", self.path(name)).schema(f"{ddl}{dated}, {FOLDER} STRING")
        return reader.parquet(*paths).drop(schemas.EVENT_DATE, FOLDER)

    def _folders(
        self, name: str, attempts: Iterable[tuple[str, str]], days: list[dt.date] | None = None
    ) -> list[str]:
        """The folders of the given attempts that a table has, from one listing."""
        top = self.path(name)
        if name not in schemas.DATED_TABLES:
            patterns = [f"{top}/{FOLDER}=*"]
        elif days is None:
            patterns = [f"{top}/{schemas.EVENT_DATE}=*/{FOLDER}=*"]
        else:
            patterns = [f"{top}/{schemas.EVENT_DATE}={d}/{FOLDER}=*" for d in [*map(str, days), NO_DATE]]
        wanted = {f"{FOLDER}={batch}.{attempt}" for batch, attempt in attempts}
        found = existing_paths(self.spark, patterns)
        return sorted(p for p in found if p.rstrip("/").rsplit("/", 1)[1] in wanted)

    # ---- writing -----------------------------------------------------------------

    def _write(self, name: str, rows: DataFrame, batch_id: str, attempt: str, date: str | None = None) -> None:
        columns = [f.name for f in T.StructType.fromDDL(schemas.TABLES[name][0])]
        folder = F.lit(f"{batch_id}.{attempt}").alias(FOLDER)
        if name in schemas.DATED_TABLES:
            day = (F.col(date) if date else F.lit(None).cast("date")).alias(schemas.EVENT_DATE)
            parts = [schemas.EVENT_DATE, FOLDER]
            rows = rows.select(*columns, day, folder).hint("rebalance", schemas.EVENT_DATE)
        else:
            parts, rows = [FOLDER], rows.select(*columns, folder)
        rows.write.mode("append").partitionBy(*parts).parquet(self.path(name))

    def _written(self, batch_id: str, attempt: str) -> list[dict]:
        """Rows and files by table and day, from the files that are there. No column is
        read, so the counts come from the files' footers."""
        found = []
        for name in schemas.TABLES:
            paths = self._folders(name, [(batch_id, attempt)])
            if not paths:
                continue
            dated = name in schemas.DATED_TABLES
            day = F.col(schemas.EVENT_DATE) if dated else F.lit(None).cast("date")
            parts = f"{schemas.EVENT_DATE} DATE, {FOLDER} STRING" if dated else f"{FOLDER} STRING"
            rows = self.spark.read.option("basePath", self.path(name)).schema(parts).parquet(*paths)
            each = rows.groupBy(day.alias("day"), F.col("_metadata.file_path").alias("file")).count()
            counts = each.groupBy("day").agg(F.count("*").alias("files"), F.sum("count").alias("rows"))
            found += [
                {"table_name": name, "event_date": r.day and str(r.day), "files": r.files, "rows": r.rows}
                for r in counts.orderBy("day").collect()
            ]
        return found

    def stage(self, batch_id: str, **tables: DataFrame) -> None:
        """Keeps the rows of a batch (``locations``, ``events``, ``vehicles``, each as the
        load takes it). Staging a batch again replaces what was staged, until it is
        committed; then it is left as it is."""
        if unknown := set(tables).difference(STAGED_TABLES):
            raise ValueError(f"no staging tables: {sorted(unknown)}")
        if self.manifest(batch_id):
            return
        self.files.delete(self._home(batch_id))
        for name, rows in tables.items():
            rows.write.parquet(self._home(batch_id, f"staging/{name}"))
        self.files.put(self._home(batch_id, "staged.json"), json.dumps(sorted(tables)))

    def staged(self, batch_id: str) -> dict[str, DataFrame]:
        """The staged rows of a batch; none if it was not staged as a whole."""
        path = self._home(batch_id, "staged.json")
        if not self.files.exists(path):
            return {}
        read = self.spark.read.parquet
        return {n: read(self._home(batch_id, f"staging/{n}")) for n in json.loads(self.files.read(path))}

    def load(self, batch_id: str, after: Callable[[str], None] | None = None) -> dict | None:
        """Inserts what a staged batch has and the warehouse lacks, and commits it; returns
        its manifest. A committed batch stays as it is; one that is not staged as a whole
        gives None. ``after`` is called with the name of each table that has been written.
        """
        batch_name(batch_id)
        if done := self.manifest(batch_id):
            self._clear_staging(batch_id)
            return done
        staged = self.staged(batch_id)
        if not staged:
            return None
        self._clear_data(batch_id)
        attempt = uuid.uuid4().hex[:12]

        def insert(name: str, rows: DataFrame, date: str | None = None) -> None:
            self._write(name, rows, batch_id, attempt, date)
            if after is not None:
                after(name)

        if "locations" in staged:
            insert("dim_locations", upsert.new_locations(staged["locations"], self.read("dim_locations"), True))
        if "events" in staged:
            events = staged["events"]
            have = self.read("fact_events", staged_days(events))
            insert("fact_events", upsert.new_events(events, self.read("dim_direction"), have, True, carry=("date",)), "date")
        if "vehicles" in staged:
            vehicles = staged["vehicles"]
            insert("dim_vehicles", upsert.new_vehicle_types(vehicles, self.read("dim_vehicles"), True))
            date = next((c for c in (schemas.EVENT_DATE, "date") if c in vehicles.columns), None)
            have = self.read("fact_event_vehicles", staged_days(vehicles, date) if date else None)
            pairs = upsert.new_event_vehicles(vehicles, have, True, carry=(date,) if date else ())
            insert("fact_event_vehicles", pairs, date)
        return self._commit(batch_id, attempt)

    def _commit(self, batch_id: str, attempt: str) -> dict:
        written = {"batch_id": batch_id, "attempt": attempt, "tables": self._written(batch_id, attempt)}
        self.files.put(self._home(batch_id, "manifest.json"), json.dumps(written))
        # Another attempt may have come first; then its manifest counts and ours is waste.
        done = self.manifest(batch_id)
        self._clear_data(batch_id, keep=done["attempt"])
        self._clear_staging(batch_id)
        return done

    def _clear_staging(self, batch_id: str) -> None:
        for name in ("staged.json", "staging"):
            self.files.delete(self._home(batch_id, name))

    def _clear_data(self, batch_id: str, keep: str | None = None) -> None:
        """Deletes the data of a batch's attempts, but for the one that counts."""
        for name in schemas.TABLES:
            inner = f"{schemas.EVENT_DATE}=*/" if name in schemas.DATED_TABLES else ""
            for path in existing_paths(self.spark, [f"{self.path(name)}/{inner}{FOLDER}={batch_id}.*"]):
                if keep is None or not path.rstrip("/").endswith(f"{FOLDER}={batch_id}.{keep}"):
                    self.files.delete(path)

    def recover(self, replay: bool = True) -> dict[str, str]:
        """Ends what a broken run has left: batch id -> ``replayed`` or ``cleared``.

        Of batches without a manifest those staged as a whole are loaded, if ``replay``; the
        data and the staged rows of all others are deleted.
        """
        done = {}
        for batch_id in self.unmarked():
            if replay and self.load(batch_id):
                done[batch_id] = "replayed"
            else:
                self._clear_data(batch_id)
                self.files.delete(self._home(batch_id))
                done[batch_id] = "cleared"
        for batch_id in {*self._named("staging"), *self._named("staged.json")}:
            self.load(batch_id)  # committed: only its staging is still to be cleared
        return done

    def append(self, name: str, rows: DataFrame, date: str | None = None) -> int:
        """Rows known to be absent, as a batch of their own; returns how many."""
        batch_id = f"{name}-{uuid.uuid4().hex}"
        attempt = uuid.uuid4().hex[:12]
        self._write(name, rows, batch_id, attempt, date)
        return sum(t["rows"] for t in self._commit(batch_id, attempt)["tables"])

    def seed(self) -> None:
        """Fixed directions and vehicle types, as one batch that is committed once."""
        if self.manifest("seed"):
            return
        self._clear_data("seed")
        attempt = uuid.uuid4().hex[:12]
        self._write("dim_direction", seed_directions(self.spark), "seed", attempt)
        self._write("dim_vehicles", seed_vehicles(self.spark), "seed", attempt)
        self._commit("seed", attempt)

    def counts(self) -> DataFrame:
        """(table_name, event_date, rows) of all committed batches, from the manifests."""
        return self.manifests().groupBy("table_name", "event_date").agg(F.sum("rows").alias("rows"))
