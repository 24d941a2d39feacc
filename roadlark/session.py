"""Session settings and the shared working folder."""

import math
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types

T = TypeVar("T")

# Settings the jobs are written for; a cluster may set more (cores, memory, partitions).
SETTINGS = {
    "spark.sql.session.timeZone": "Asia/Manila",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods beyond this size; Spark then splits the code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(name: str = "roadlark", cores: int | str = "*", **extra: str) -> SparkSession:
    """Session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    local = {
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local session, whose one process is all there is, may do without the setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{tempfile.gettempdir()}/roadlark-work"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/roadlark/{name}-{uuid.uuid4().hex}"


def built_once(build: Callable[[], T]) -> Callable[[], T]:
    """Keep what ``build`` makes of column expressions for as long as the JVM lives.

    Large expressions take hundreds of calls into the JVM to put together; they hold only
    column names, so every plan can use the same ones.
    """
    kept: dict = {}

    def get() -> T:
        jvm = SparkContext._jvm
        if kept.get("jvm") is not jvm:
            kept.update(jvm=jvm, value=build())
        return kept["value"]

    return get


def literal_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few fixed rows (texts, numbers, truth values) as a local relation, which plans as
    one small task."""
    schema = types.StructType.fromDDL(ddl)
    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(0).select(*nothing)

    def written(value) -> str:
        return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)

    lines = ", ".join("(" + ", ".join(map(written, row)) + ")" for row in rows)
    table = spark.sql(f"select * from values {lines}")
    typed = [F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(table.columns, schema)]
    return table.select(*typed)


def empty_table(spark: SparkSession, ddl: str) -> DataFrame:
    return literal_rows(spark, [], ddl)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage at a table that outlives any executor, and lets every later use
    read only the columns and row groups it needs.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(counter: Observation, name: str) -> int:
    """A count observed during an action; 0 where Spark found the plan to be empty while
    it ran and left the counter out with it."""
    try:
        return counter.get[name] or 0
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        return 0


TASK_ROWS = 1 << 18  # rows that one task parses, about


def spread(scan: DataFrame) -> DataFrame:
    """Give the parser every core, and each task no more than about ``TASK_ROWS`` rows,
    when a scan has fewer splits than that takes: a few bytes in a file are many rows to
    parse. A scan with more splits is left as it is.

    For plain Parquet scans only: the splits of anything with a shuffle are not known in
    advance, and these count their rows by the files' footers.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(scan.count() / TASK_ROWS))
    return scan.repartition(tasks) if scan.rdd.getNumPartitions() < tasks else scan
