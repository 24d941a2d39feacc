"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.session import fresh_path, materialise

SAMPLE_BUCKETS = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500


def text_of(column: str = "text") -> Column:
    """The column's text; a null is an empty text."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def small_batches(rows: DataFrame) -> None:
    """Lets the session send whole texts to Python in batches of BATCH_ROWS at most, so
    that a worker holds few of them at a time."""
    conf = rows.sparkSession.conf
    if int(conf.get(BATCH_SETTING)) > BATCH_ROWS:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))


def lean(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that, when it ends, gives the memory it has
    freed back to the system. Workers outlive their tasks, and those of several stages
    otherwise keep what the largest of each has taken."""

    @functools.wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


class Shelf:
    """Written tables that an operator gives up once what it made of them is written too, so
    that they do not all lie on the disk to its end."""

    def __init__(self) -> None:
        self._held: dict[int, tuple[DataFrame, str]] = {}

    def write(self, rows: DataFrame, name: str) -> DataFrame:
        path = fresh_path(rows.sparkSession, name)
        rows.write.parquet(path)
        table = rows.sparkSession.read.schema(rows.schema).parquet(path)
        self._held[id(table)] = table, path
        return table

    def give_up(self, *tables: DataFrame) -> None:
        """Deletes tables; nothing that is not written yet may read them."""
        for table in tables:
            context = table.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(self._held.pop(id(table))[1])
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    written = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))
    return F.crc32(written.cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int
) -> DataFrame:
    """(text, label) of about ``bound`` labelled documents at most, all of them where
    there are fewer; written once.

    ``learn`` is a condition on doc_id. Which documents are taken depends on a hash of
    their id only. A document with several labels has the largest one, an id with several
    texts the smallest one; rows without id, label or a text count as unlabelled or as an
    empty text. Only the sampled texts are shuffled.
    """
    known = (
        labels.where(learn & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    share = min(1.0, bound / max(1, known.count()))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), SAMPLE_BUCKETS) < share * SAMPLE_BUCKETS
    texts = (
        docs.select("doc_id", text_of().alias("text"))
        .where(learn & drawn)
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
    )
    return materialise(texts.join(known.where(drawn), "doc_id").select("text", "label"), "sample")


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their position (from 0) in a total order as ``name``.

    Ranges of the order are sorted side by side and written once; the only rows that meet
    in one task are one count per range.
    """
    cut = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    kept = materialise(cut, "ranges")
    counts = kept.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = kept.join(F.broadcast(starts), "_range")
    return placed.withColumn(name, F.col("_start") + inside - 1).drop("_range", "_start")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it is
    linked to in any number of steps. Nodes are longs.

    Each round every node points at its smallest neighbour, pointers are followed twice,
    and the edges are moved to the roots, where copies and loops go; at least half of the
    nodes go each round. No task gets the edges of one node: minima are taken before the
    shuffle, and the joins are plain ones that the engine splits where they are skewed.
    """
    links = materialise(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct(), "links")
    state = None
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        hop = materialise(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "hop")
        for _ in range(2):
            step = hop.select(F.col("node").alias("root"), F.col("root").alias("next"))
            hop = materialise(hop.join(step, "root").select("node", F.col("next").alias("root")), "hop")
        if state is None:
            state = hop
        else:
            step = hop.select(F.col("node").alias("root"), F.col("root").alias("next"))
            state = state.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            state = materialise(state, "roots")
        for end in ("a", "b"):
            step = hop.select(F.col("node").alias(end), F.col("root").alias("_root"))
            links = links.join(step, end).drop(end).withColumnRenamed("_root", end)
        links = materialise(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0) if state is None else state
