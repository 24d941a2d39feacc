"""Multi-line CSV files read by many tasks.

A line break inside quotes makes a file unsplittable for a reader that must know where a
quoted field began. Here every split is read as lines. A line that starts outside quotes
ends outside or inside them, and one that starts inside as well: so a line either leaves
that state alone, turns it, or sets it. Turns are counted in running sums and the last line
that sets it is carried forward over blocks, as missing times are (``fill``); lines are
then joined to records and parsed by ``from_csv``.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from roadlark import schemas
from roadlark.operators.fill import forward_fill
from roadlark.session import empty_table, materialise
from roadlark.sources.posts import READ_OPTIONS, existing_paths, historical_as_posts

SPLIT_SETTING = "spark.sql.files.maxPartitionBytes"
LINE_TASKS = 1024  # that read the lines of files, at most, unless there are more cores
POSITION_BITS = 34  # of a line in its split; the split's number stands before them


def quote_marks(line: Column) -> Column:
    """The quotes of a line that are not doubled: O where a field can begin with it, Q
    elsewhere. Outside of quotes an O opens a field, and whatever follows closes it."""
    single = F.regexp_replace(line, '""', "")
    opening = F.regexp_replace(single, r'(^|,)[ \t]*"', "\u0001")
    signs = F.regexp_replace(opening, '[^"\u0001]+', "")
    return F.translate(signs, '\u0001"', "OQ")


def ends_inside(marks: Column) -> Column:
    """Whether a line that starts outside of quotes ends inside."""
    return F.endswith(F.regexp_replace(marks, "Q*O[OQ]", ""), F.lit("O"))


def stays_inside(marks: Column) -> Column:
    """Whether a line that starts inside of quotes ends inside."""
    return (marks == "") | ends_inside(F.substring(marks, 2, 1 << 30))


def numbered_lines(spark: SparkSession, paths: list[str], split_bytes: int | None = None) -> DataFrame:
    """(source_file, line, no) of text files, written once; ``no`` is unique and follows the
    order of the lines in their file. ``split_bytes`` cuts the files, and nothing read
    later, into splits of that size instead of the session's.

    Rows come in the order of a split's lines, and a split knows where it begins. A task
    reads one split or several one after the other, so that the tasks, of which each
    reports to the driver, are no more than ``LINE_TASKS`` for a file of any size. There
    is one row for each split in the table that numbers them.
    """
    old = spark.conf.get(SPLIT_SETTING)
    if split_bytes:
        spark.conf.set(SPLIT_SETTING, str(split_bytes))
    try:
        lines = spark.read.option("lineSep", "\n").text(paths).select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("_begin"),
        )
        tasks = max(LINE_TASKS, spark.sparkContext.defaultParallelism)
        lines = lines.coalesce(tasks).withColumn("_id", F.monotonically_increasing_id())
        lines = materialise(lines, "lines")
    finally:
        spark.conf.set(SPLIT_SETTING, old)
    splits = lines.groupBy("source_file", "_begin").agg(F.min("_id").alias("_first"))
    before = Window.orderBy("source_file", "_begin")
    splits = splits.select("source_file", "_begin", "_first", (F.row_number().over(before) - 1).cast("long").alias("_split"))
    no = F.shiftleft("_split", POSITION_BITS) + F.col("_id") - F.col("_first")
    return lines.join(splits, ["source_file", "_begin"]).select("source_file", "line", no.alias("no"))


def with_state(lines: DataFrame) -> DataFrame:
    """``lines`` with ``inside``, whether they start inside of quotes, and ``open``, whether
    they end there. Written once."""
    marks = quote_marks(F.col("line"))
    marked = lines.withColumns({"_out": ends_inside(marks), "_in": stays_inside(marks)})
    block = F.shiftright("no", POSITION_BITS)
    turns = (F.col("_out") & ~F.col("_in")).cast("int")
    sets = F.col("_out") == F.col("_in")
    marked = marked.withColumns({"_turn": turns, "_block": block})
    # How often the state turns before and inside each split; then up to each line.
    sums = marked.groupBy("source_file", "_block").agg(F.sum("_turn").alias("_sum"))
    so_far = Window.partitionBy("source_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source_file").alias("_file"), F.col("_block").alias("_b"), F.coalesce(F.sum("_sum").over(so_far), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("source_file", "_block").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    counted = marked.withColumn("_run", F.sum("_turn").over(inside))
    counted = counted.join(sums, (counted["source_file"] == sums["_file"]) & (counted["_block"] == sums["_b"]))
    odd = (F.col("_before") + F.col("_run")) % 2 == 1
    # What a line sets, as it would be without the turns up to it.
    level = F.when(sets, F.col("_out") != F.col("_odd"))
    told = counted.withColumn("_odd", odd).withColumn("_level", level)
    told = materialise(told.select("source_file", "no", "line", "_odd", "_level", "_turn"), "told")
    carried = forward_fill(told, "_level", "no", groups=("source_file",), block_bits=16, order_bits=63)
    ends = F.coalesce(F.col("_level"), F.lit(False)) != F.col("_odd")
    # A line that sets the state says nothing of how it was before: that is the line before's.
    carried = materialise(carried.select("source_file", "no", "line", ends.alias("open")), "ends")
    first = F.shiftright("no", POSITION_BITS).alias("_block")
    edges = carried.groupBy("source_file", first).agg(F.max_by("open", "no").alias("_last"))
    edge = Window.partitionBy("source_file").orderBy("_block")
    edges = edges.select(
        F.col("source_file").alias("_file"), F.col("_block").alias("_b"), F.coalesce(F.lag("_last").over(edge), F.lit(False)).alias("_left")
    )
    by_line = Window.partitionBy("source_file", F.shiftright("no", POSITION_BITS)).orderBy("no")
    near = carried.withColumn("_near", F.lag("open").over(by_line))
    near = near.join(edges, (near["source_file"] == edges["_file"]) & (F.shiftright("no", POSITION_BITS) == edges["_b"]))
    return near.select("source_file", "no", "line", F.coalesce("_near", "_left").alias("inside"), "open")


def records(lines: DataFrame) -> DataFrame:
    """(source_file, no, record): the lines that belong together, joined; ``no`` is the
    first one's. Most records are one line, which is left where it is; only the lines of
    longer ones are shuffled. A field that is never closed takes its file's rest."""
    state = materialise(with_state(lines), "state")
    single = state.where(~F.col("inside") & ~F.col("open")).select("source_file", "no", F.col("line").alias("record"))
    parts = state.where(F.col("inside") | F.col("open"))
    start = F.when(~F.col("inside"), F.col("no"))
    owned = forward_fill(materialise(parts.withColumn("_start", start), "parts"), "_start", "no", groups=("source_file",))
    pieces = F.array_sort(F.collect_list(F.struct("no", "line")))
    joined = owned.groupBy("source_file", "_start").agg(F.array_join(F.transform(pieces, lambda p: p["line"]), "\n").alias("record"))
    return single.unionByName(joined.withColumnRenamed("_start", "no"))


def read_records(
    spark: SparkSession, paths: str | list[str], schema: str, split_bytes: int | None = None
) -> DataFrame:
    """The rows of CSV files with a header, as ``posts.read_csv`` reads them, with the file
    and the number of each (``source_file``, ``no``); paths that do not exist are skipped.

    Quotes may hold commas, line breaks and doubled quotes. Lines end with a line feed, or
    with a carriage return before it.
    """
    found = existing_paths(spark, [paths] if isinstance(paths, str) else paths)
    if not found:
        return empty_table(spark, f"{schema}, source_file STRING, no BIGINT")
    rows = records(numbered_lines(spark, found, split_bytes)).where(~F.col("record").rlike(r"^[ \t\r]*$"))
    head = rows.groupBy("source_file").agg(F.min("no").alias("_head"))
    body = rows.join(F.broadcast(head), "source_file").where(F.col("no") != F.col("_head"))
    text = F.regexp_replace("record", "\r$", "")
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in READ_OPTIONS.items() if k != "header"}
    parsed = F.from_csv(text, schema, options)
    return body.select(parsed.alias("_row"), "source_file", "no").select("_row.*", "source_file", "no")


def read_posts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Posts of large raw files in many tasks, with ``source_file`` and ``post_seq``."""
    return read_records(spark, paths, schemas.RAW_POSTS).withColumnRenamed("no", "post_seq")


def read_historical(
    spark: SparkSession, paths: str | list[str], split_bytes: int | None = None
) -> DataFrame:
    """Posts of a historical file in many tasks, with ``source_file`` and ``post_seq``."""
    rows = read_records(spark, paths, schemas.RAW_HISTORICAL, split_bytes)
    return historical_as_posts(rows, "source_file", F.col("no").alias("post_seq"))
