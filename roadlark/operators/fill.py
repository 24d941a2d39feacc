"""Forward fill in row order, in parallel.

The last known value before a row may lie arbitrarily far back, yet no task ever sees
more than one block of the order column: the (integer, unique) order is cut into blocks
of ``2 ** block_bits`` positions, values run forward inside each block, and what enters
a block from the left comes from a table with one row per block - itself filled the
same way, level by level.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.functions import fields

BLOCK_BITS = 16
ORDER_BITS = 63


def _last_known(at: str) -> Column:
    return F.max_by("known", F.when(F.col("known").isNotNull(), F.col(at))).alias("known")


def _left_on(rows: DataFrame, blocks: DataFrame, groups: list[str], position: str) -> DataFrame:
    """Attach ``entering`` of the block of each row."""
    right = blocks.select(
        *[F.col(g).alias(f"_{g}") for g in groups], F.col("at").alias("_at"), F.col("entering")
    )
    on = rows[position] == right["_at"]
    for g in groups:
        on = on & (rows[g] == right[f"_{g}"])
    return rows.join(right, on, "left").drop("_at", *[f"_{g}" for g in groups])


def _entering(blocks: DataFrame, groups: list[str], bits: int, width: int) -> DataFrame:
    """(groups, at, entering): the last non-null ``known`` of the earlier blocks of the group.

    ``blocks`` has one row per (groups, ``at``); ``width`` is the bit width of ``at``.
    """
    before = (Window.unboundedPreceding, -1)
    known = F.last("known", ignorenulls=True)
    if width <= bits:
        w = Window.partitionBy(*groups).orderBy("at").rowsBetween(*before)
        return blocks.select(*groups, "at", known.over(w).alias("entering"))
    # Partitioned once; the window and the next level both read this exchange.
    upper = blocks.withColumn("up", F.shiftright("at", bits)).repartition(*groups, "up")
    w = Window.partitionBy(*groups, "up").orderBy("at").rowsBetween(*before)
    inside = upper.withColumn("near", known.over(w)).drop("known")
    parents = upper.groupBy(*groups, "up").agg(_last_known("at")).withColumnRenamed("up", "at")
    joined = _left_on(inside, _entering(parents, groups, bits, width - bits), groups, "up")
    return joined.select(*groups, "at", F.coalesce("near", "entering").alias("entering"))


def forward_fill(
    df: DataFrame,
    value: str,
    order: str,
    groups: tuple[str, ...] = (),
    block_bits: int = BLOCK_BITS,
    order_bits: int = ORDER_BITS,
) -> DataFrame:
    """Replace each null ``value`` by the last non-null one at a smaller ``order`` in the
    same group; leading nulls stay.

    ``order`` must be a unique, non-negative integer column. Only (groups, order, value)
    is shuffled, once, for the running fill; of the wide rows only those that lack a value
    are joined, the others pass through where they are. ``df`` is read three times, so it
    should be a table rather than a long computation. ``order_bits`` declares the width of
    the order values; wider values stay right but enlarge the topmost block.
    """
    # One struct as the key: never null itself, and null fields inside are equal, so plain
    # joins on it match null groups and keep the partitioning of the rows.
    keys = [F.struct(*groups).alias("_group")] if groups else []
    groups = ["_group"] if groups else []
    block = F.shiftright(F.col(order).cast("bigint"), block_bits)
    slim = df.select(
        *keys, F.col(order).alias("_order"), F.col(value).alias("known"), block.alias("at")
    ).repartition(*groups, "at")
    blocks = slim.groupBy(*groups, "at").agg(_last_known("_order"))
    w = (
        Window.partitionBy(*groups, "at").orderBy("_order")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = slim.withColumn("_run", F.last("known", ignorenulls=True).over(w)).where(
        F.col("known").isNull()
    )
    entering = _entering(blocks, groups, block_bits, order_bits - block_bits)
    fills = _left_on(running, entering, groups, "at").select(
        "_order", F.coalesce("_run", "entering").alias("_fill")
    )
    present = df.where(F.col(value).isNotNull())
    absent = df.where(F.col(value).isNull())
    filled = absent.join(fills, absent[order] == fills["_order"], "left").select(
        *[F.col("_fill").alias(value) if c == value else absent[c] for c in df.columns]
    )
    return present.unionByName(filled)


def fill_event_time(
    parsed: DataFrame, order: str, groups: tuple[str, ...] = (), **bits: int
) -> DataFrame:
    """Forward-fill ``time`` and rebuild ``event_timestamp`` from date and time."""
    filled = forward_fill(parsed, "time", order, groups, **bits)
    return filled.withColumn(
        "event_timestamp", fields.event_timestamp(F.col("date"), F.col("time"))
    )
