"""Row numbers of a total order, without bringing the rows together."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.session import materialise


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place (from 0) in ``order`` as ``name``.

    Ranges of the order are sorted side by side and written once; what meets in one task
    is a count for each range. The order should be total; equal rows get places as they
    come, the same ones whenever the result is read. Other columns may have any names but
    ``_range`` and ``_start``.
    """
    cut = rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    kept = materialise(cut, "ranges")
    counts = kept.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = kept.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + inside - 1)
    return materialise(placed.drop("_range", "_start"), "numbered")
