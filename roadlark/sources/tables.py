"""Clean Parquet folders by date, and the warehouse tables."""

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from roadlark import rules, schemas
from roadlark.operators.upsert import absent_rows
from roadlark.session import empty_table, literal_rows, observed
from roadlark.sources.posts import existing_paths


NO_DATE = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows whose date is null


def write_by_date(df: DataFrame, path: str, replace_days: bool = False) -> None:
    """Parquet partitioned by ``date``, appended or, with ``replace_days``, replacing each
    touched day whole. The rebalance hint writes a crowded day with several tasks."""
    (
        df.hint("rebalance", "date")
        .write.mode("overwrite" if replace_days else "append")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def data_children(spark: SparkSession, path: str) -> dict[str, str]:
    """Name and path of what a table's folder holds, without markers and work files: one
    listing, which does not look into the folders of days."""
    found = existing_paths(spark, [f"{path}/*"])
    names = {p.rstrip("/").rsplit("/", 1)[1]: p for p in found}
    return {name: p for name, p in names.items() if name[0] not in "_."}


def read_by_date(
    spark: SparkSession, path: str, schema: str, start: dt.date, end: dt.date | None = None
) -> DataFrame:
    """The rows of a day or of an inclusive range; the files of other days are not listed.

    ``schema`` (DDL) includes ``date``.
    """
    first, last = f"date={start}", f"date={end or start}"
    days = [p for name, p in sorted(data_children(spark, path).items()) if first <= name <= last]
    if not days:
        return empty_table(spark, schema)
    return spark.read.option("basePath", path).schema(schema).parquet(*days)


def seed_directions(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, rules.SEED_DIRECTIONS, schemas.TABLES["dim_direction"][0])


def seed_vehicles(spark: SparkSession) -> DataFrame:
    rows = [(t, g, rules.NO_SUGGESTION, True) for t, g in rules.SEED_VEHICLES]
    return literal_rows(spark, rows, schemas.TABLES["dim_vehicles"][0])


def staged_days(staging: DataFrame, date: str = "date") -> list[dt.date]:
    """The days of a staging table, of which the calendar has few."""
    days = staging.select(date).where(F.col(date).isNotNull()).distinct()
    return [row[0] for row in days.collect()]


class Warehouse:
    """The star schema as Parquet tables below one folder.

    Tables only grow, by rows whose key they lack. What counts are the data files, not a
    marker: whatever rows a write that broke off has left are seen, and running it again
    inserts those that are missing.

    The fact tables lie in folders by event date. The date is part of what the event id
    is a digest of, so a row can only be present already in the folder of its own date:
    loading a day compares with that day, not with all of history. The folder of rows
    without a date is always compared too.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, days: list[dt.date] | None = None) -> DataFrame:
        """A table; of a fact table, if ``days`` are given, only the rows a staging table
        of these days could meet again."""
        ddl, path = schemas.TABLES[name][0], self.path(name)
        children = data_children(self.spark, path)
        if name not in schemas.DATED_TABLES:
            return self.spark.read.schema(ddl).parquet(path) if children else empty_table(self.spark, ddl)
        if days is not None:
            values = [*map(str, days), NO_DATE]
            folders = {f"{schemas.EVENT_DATE}={value}" for value in values}
            children = {n: p for n, p in children.items() if n in folders}
        if not children:
            return empty_table(self.spark, ddl)
        paths = [path] if days is None else sorted(children.values())
        dated = self.spark.read.option("basePath", path).schema(f"{ddl}, {schemas.EVENT_DATE} DATE")
        return dated.parquet(*paths).drop(schemas.EVENT_DATE)

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in schemas.TABLES}

    def append(self, name: str, rows: DataFrame, date: str | None = None) -> int:
        """Append rows already known to be absent, as an ``upsert`` operator returns them,
        and count them on the way. ``date`` names their event date column, if they have one.
        """
        columns = [f.name for f in T.StructType.fromDDL(schemas.TABLES[name][0])]
        written = Observation()
        day = (F.col(date) if date else F.lit(None).cast("date")).alias(schemas.EVENT_DATE)
        dated = name in schemas.DATED_TABLES
        rows = rows.select(*columns, *([day] if dated else []))
        counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        if dated:
            counted = counted.hint("rebalance", schemas.EVENT_DATE)
        writer = counted.write.mode("append")
        (writer.partitionBy(schemas.EVENT_DATE) if dated else writer).parquet(self.path(name))
        return observed(written, "rows")

    def seed(self) -> None:
        """Fixed directions and vehicle types; seeding again adds nothing."""
        for name, rows in (
            ("dim_direction", seed_directions(self.spark)),
            ("dim_vehicles", seed_vehicles(self.spark)),
        ):
            self.append(name, absent_rows(rows, self.read(name), schemas.TABLES[name][1]))

    def replace_staging(self, name: str, rows: DataFrame) -> DataFrame:
        """Truncate-and-load of a staging table."""
        rows.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(rows.schema).parquet(self.path(name))
