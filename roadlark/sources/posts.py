"""Raw posts in CSV files, one file or folder per day."""

import datetime as dt
import logging
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadlark import schemas
from roadlark.session import empty_table

log = logging.getLogger(__name__)

# Quoting that pandas and most tools write: a quote inside a quoted field is doubled.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}
READ_OPTIONS = {
    **CSV_OPTIONS,
    "multiLine": True,
    "ignoreLeadingWhiteSpace": True,
    "ignoreTrailingWhiteSpace": True,
}
WRITE_OPTIONS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def existing_paths(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the given paths or globs that name something, on any file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for path in paths:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        hits = hadoop_path.getFileSystem(conf).globStatus(hadoop_path)
        found += [hit.getPath().toString() for hit in hits or []]
    return found


def largest_file(spark: SparkSession, paths: str | list[str]) -> int:
    """Bytes of the largest file that the given paths or globs name or hold."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    most = 0
    for path in existing_paths(spark, [paths] if isinstance(paths, str) else paths):
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop_path.getFileSystem(conf).listFiles(hadoop_path, True)
        while files.hasNext():
            most = max(most, files.next().getLen())
    return most


def read_csv(spark: SparkSession, paths: str | list[str], schema: str, multi_line: bool = True) -> DataFrame:
    """CSV files as one scan; paths that do not exist are skipped, and with none left
    the result is empty.

    A file with line breaks inside quotes cannot be split, so it is one task. Pass
    ``multi_line=False`` for a large file known to have none.
    """
    found = existing_paths(spark, [paths] if isinstance(paths, str) else paths)
    if not found:
        return empty_table(spark, schema)
    options = {**READ_OPTIONS, "multiLine": multi_line}
    return spark.read.schema(schema).options(**options).csv(found)


def with_file_order(posts: DataFrame) -> DataFrame:
    """Add ``source_file`` and ``post_seq``, which follows the row order in each file.

    Take it directly on the scan and materialise it before use.
    """
    return posts.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.monotonically_increasing_id().alias("post_seq"),
    )


def read_posts(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    return read_csv(spark, paths, schemas.RAW_POSTS, multi_line)


def historical_as_posts(raw: DataFrame, *carry) -> DataFrame:
    """Only text, date and source of the historical file; its other columns are parsed anew."""
    return raw.select(
        F.col("Tweet").alias("content"), F.col("Date").alias("created_at"), F.col("Source").alias("tweetlinkid"), *carry
    )


def read_historical(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    return historical_as_posts(read_csv(spark, paths, schemas.RAW_HISTORICAL, multi_line))


def day_before(as_of: dt.date | None = None) -> dt.date:
    """The day before ``as_of``, or before today where the posts come from, whatever the
    clock of this machine says."""
    today = as_of or dt.datetime.now(ZoneInfo("Asia/Manila")).date()
    return today - dt.timedelta(days=1)


def days_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day, both ends included; empty if the range is."""
    day = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("day")
    return spark.range(1).where(F.lit(start <= end)).select(day)


def day_file(root, day):
    """Path column of a day's raw file: root/YYYY/MM/scrape_data_YYYYMMDD.csv."""
    return F.concat(
        F.lit(root), F.date_format(day, "/yyyy/MM/"),
        F.lit("scrape_data_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv"),
    )


def day_files(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> list[str]:
    rows = days_between(spark, start, end).select(day_file(root, F.col("day"))).collect()
    return [row[0] for row in rows]


def read_days(
    spark: SparkSession, root: str, start: dt.date, end: dt.date, multi_line: bool = True
) -> DataFrame:
    """All days of a range in one job, from day files and from the folders that
    ``write_day_folders`` makes; missing days are skipped, a range without any is logged."""
    found = existing_days(spark, root, start, end)
    if not found:
        log.warning("no raw posts below %s from %s to %s", root, start, end)
    return read_posts(spark, found, multi_line)


def existing_days(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> list[str]:
    """Day files and day folders of a range: two listings a month, none of other months."""
    days = [start + dt.timedelta(n) for n in range((end - start).days + 1)]
    months = sorted({d.replace(day=1) for d in days})
    patterns = [f"{root}/{m:%Y/%m}/scrape_data_*.csv" for m in months]
    patterns += [f"{root}/year={m:%Y}/month={m:%m}/day=*" for m in months]
    wanted = {f"{d:%Y/%m}/scrape_data_{d:%Y%m%d}.csv" for d in days}
    wanted |= {f"year={d:%Y}/month={d:%m}/day={d:%d}" for d in days}
    return [p for p in existing_paths(spark, patterns) if "/".join(p.rsplit("/", 3)[1:]) in wanted]


def write_day_folders(posts: DataFrame, root: str, mode: str = "overwrite") -> None:
    """CSV below root/year=/month=/day=, replacing only the days that have posts.

    The rebalance hint gives a day with very many posts several files and several tasks.
    """
    day = F.col("created_at")
    parts = posts.select(
        "content", "tweetlinkid", "created_at",
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    )
    (
        parts.hint("rebalance", "year", "month", "day")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .options(**WRITE_OPTIONS)
        .partitionBy("year", "month", "day")
        .csv(root)
    )


def read_day_folders(spark: SparkSession, root: str, start: dt.date, end: dt.date) -> DataFrame:
    """The posts of a date range, pruned to the folders of those days."""
    if not existing_paths(spark, [f"{root}/year=*"]):
        return empty_table(spark, schemas.RAW_POSTS)
    parts = schemas.RAW_POSTS + ", year STRING, month STRING, day STRING"
    folder_day = F.concat("year", "month", "day")
    return (
        spark.read.schema(parts)
        .options(**READ_OPTIONS)
        .csv(root)
        .where(folder_day.between(f"{start:%Y%m%d}", f"{end:%Y%m%d}"))
        .drop("year", "month", "day")
    )
