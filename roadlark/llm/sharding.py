"""Sharding by a k-d tree over metadata, with DataFrame functions only.

Equal texts are one unit; a unit has bytes and, in each metadata dimension, a place. The
tree is built level by level, all nodes of a level at once: a node is split along the
dimension in which its units lie widest apart, at the weighted median. The median is found
by histograms: bytes are summed by the leading digits of the place, the bin that holds the
median alone is dealt out anew by the next digits, until one place is left. What reaches
the driver is a row for each node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.llm.common import ranked, text_of
from roadlark.operators.joins import lookup_join
from roadlark.session import literal_rows, materialise

PLACE_BITS = 20  # of a place in a dimension
TIE_BITS = 40  # of the hash that orders units of one place
DIGIT_BITS = 12  # of a histogram
ROUNDS = (PLACE_BITS + TIE_BITS) // DIGIT_BITS
PIECES = 4  # a unit above 1 / PIECES of a shard is cut into pieces of that size
HEAVY = 256  # units above 1 / HEAVY of a node stay on their side of the median
STEP = 0x5DEECE66D  # parts the hashes of a unit's pieces


def hash60(column: Column) -> Column:
    return F.conv(F.substring(F.md5(column.cast("binary")), 1, 15), 16, 10).cast("long")


def place_of_name(column: Column) -> Column:
    """Equal texts have one place; a null has the lowest."""
    place = F.conv(F.substring(F.md5(column.cast("binary")), 1, PLACE_BITS // 4), 16, 10)
    return F.coalesce(place.cast("long"), F.lit(0))


def place_of_size(column: Column) -> Column:
    """The logarithm of a positive integer, made of straight lines between powers of two."""
    digits = F.length(F.bin(column))
    # 512 steps for each power of two; 64 powers fill the bits of a place.
    part = F.floor(column * 1024 / F.pow(F.lit(2.0), digits))  # 512 to 1023
    return ((digits - 1) * 512 + part - 512).cast("long") * 32


def metadata() -> dict[str, Column]:
    """Dimensions of documents: each a place from 0 to 2 ** PLACE_BITS - 1, never null."""
    return {
        "source": place_of_name(F.col("source")),
        "lang": place_of_name(F.col("lang")),
        "bytes": place_of_size(F.octet_length(text_of()).cast("long") + 1),
    }


@dataclass(frozen=True)
class Node:
    number: int
    first: int  # its first shard
    shards: int


def shard(
    docs: DataFrame,
    shards: int | None = 8,
    target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    A row's size is the UTF-8 bytes of its text (null: none) plus 1. The leaves of the tree
    are ``shards`` shards of nearly equal sizes (law ``bytes``), or as many as it takes for
    ``target_bytes`` a shard. ``dimensions`` are places of the rows (see ``metadata``); with
    none, ``metadata()``. ``slot`` numbers the rows of a shard without gaps, by doc_id, null
    last. ``grown_shard`` is null: under this law another shard moves rows everywhere.

    Rows of equal text share a shard, at the lowest place any of them has in each dimension,
    unless they make up more than a quarter of a shard: then pieces of about that size, by a
    hash of doc_id, are placed each for itself; what is equal in id and text stays in one
    piece. Null and empty texts are equal. An empty table gives no rows; other columns are
    not looked at.
    """
    places = metadata() if dimensions is None else dimensions
    names = [f"x{i}" for i in range(len(places))]
    text = text_of()
    slim = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        hash60(text).alias("digest"),
        hash60(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("spread"),
        *[p.cast("long").alias(n) for n, p in zip(names, places.values())],
    )
    rows = materialise(slim, "slim")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if target_bytes is not None:
        shards = max(1, -(-total // target_bytes))
    rows = _with_units(rows, total, shards)
    best = [F.min(n).alias(n) for n in names]
    units = materialise(rows.groupBy("unit").agg(F.sum("size").alias("weight"), *best), "units")
    tree = _leaves(units, names, shards)
    placed = lookup_join(rows.select("doc_id", "size", "text_crc32", "unit"), tree, "unit", "inner")
    return _with_slots(placed)


def _with_units(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """``rows`` with their unit. There are fewer texts above a quarter of a shard than four
    for each shard, so their table is small."""
    large = rows.groupBy("digest").agg(F.sum("size").alias("_bytes")).where(F.col("_bytes") * PIECES * shards > total)
    pieces = F.ceil(F.col("_bytes") * PIECES * shards / max(1, total)).cast("long")
    large = materialise(large.select("digest", pieces.alias("_pieces")), "large")
    piece = F.coalesce(F.pmod("spread", "_pieces"), F.lit(0))
    unit = F.pmod(F.col("digest") + piece * STEP, F.lit(1 << 60))
    return rows.join(F.broadcast(large), "digest", "left").withColumn("unit", unit).drop("_pieces", "spread", "digest")


def _leaves(units: DataFrame, names: list[str], shards: int) -> DataFrame:
    """(unit, shard)."""
    spark = units.sparkSession
    level, leaves = [Node(0, 0, shards)], {}
    placed = units.withColumn("node", F.lit(0).cast("long"))
    while level:
        leaves.update({n.number: n.first for n in level if n.shards == 1})
        level = [n for n in level if n.shards > 1]
        if not level:
            break
        axes, targets = _widest(placed, names, {n.number: n for n in level})
        table = literal_rows(spark, [(n, axes[n]) for n in axes], "node long, axis int")
        place = F.element_at(F.array(*names), F.col("axis") + 1)
        key = F.shiftleft(place, TIE_BITS) + F.shiftright("unit", 60 - TIE_BITS)
        keyed = placed.join(F.broadcast(table), "node", "left").withColumn("key", key).drop("axis")
        sides = _sides(materialise(keyed, "keyed"), targets)
        split = {n.number for n in level}
        there = F.col("node").isin(*split)
        placed = sides.withColumn(
            "node", F.when(there, F.col("node") * 2 + F.when(F.col("right"), 2).otherwise(1)).otherwise(F.col("node"))
        ).drop("right", "key")
        placed = materialise(placed, "level")
        halves = []
        for n in level:
            left = n.shards // 2
            halves += [Node(2 * n.number + 1, n.first, left), Node(2 * n.number + 2, n.first + left, n.shards - left)]
        level = halves
    shard_of = F.broadcast(literal_rows(spark, sorted(leaves.items()), "node long, shard int"))
    return placed.join(shard_of, "node").select("unit", "shard")


def _widest(placed: DataFrame, names: list[str], nodes: dict[int, Node]) -> tuple[dict[int, int], dict[int, tuple[int, int]]]:
    """Of each node that has units: the widest dimension (the first of several), and the
    bytes that go left and all its bytes."""
    spans = [(F.max(n) - F.min(n)).alias(n) for n in names]
    found = placed.where(F.col("node").isin(*nodes)).groupBy("node").agg(F.sum("weight").alias("weight"), *spans)
    axes, targets = {}, {}
    for row in found.collect():
        widths = [row[n] for n in names]
        node = nodes[row["node"]]
        axes[node.number] = widths.index(max(widths))
        targets[node.number] = (row["weight"] * (node.shards // 2) // node.shards, row["weight"])
    return axes, targets


def _sides(keyed: DataFrame, targets: dict[int, tuple[int, int]]) -> DataFrame:
    """``keyed`` with ``right``, whether a unit lies behind the median of its node.

    Few units may hold much of a node. Those above 1 / HEAVY of it go to their side of the
    median first; the cut among the light ones then makes up for what that leaves over.
    """
    spark = keyed.sparkSession
    heavy = F.col("weight") * HEAVY > F.col("_all")
    sizes = literal_rows(spark, [(n, w) for n, (_, w) in targets.items()], "node long, _all long")
    sized = keyed.join(F.broadcast(sizes), "node", "left")
    median = _cuts(keyed, {n: t for n, (t, _) in targets.items()})
    cut = literal_rows(spark, list(median.items()), "node long, _cut long")
    sized = sized.join(F.broadcast(cut), "node", "left")
    left = F.sum(F.when(F.col("key") < F.col("_cut"), F.col("weight")).otherwise(0)).alias("left")
    fixed = {r["node"]: r["left"] for r in sized.where(heavy).groupBy("node").agg(left).collect()}
    if not fixed:
        return sized.withColumn("right", F.col("key") >= F.col("_cut")).drop("_all", "_cut")
    rest = {n: targets[n][0] - fixed[n] for n in fixed}
    light = _cuts(sized.where(~heavy), rest)
    moved = literal_rows(spark, [(n, light.get(n, median[n])) for n in median], "node long, _light long")
    sized = sized.join(F.broadcast(moved), "node", "left")
    behind = F.when(heavy, F.col("key") >= F.col("_cut")).otherwise(F.col("key") >= F.col("_light"))
    return sized.withColumn("right", behind).drop("_all", "_cut", "_light")


def _cuts(keyed: DataFrame, targets: dict[int, int]) -> dict[int, int]:
    """For each node the key below which its units weigh nearest to the target; a unit that
    would overshoot it by more than half of its weight stays behind."""
    spark = keyed.sparkSession
    prefix, need = dict.fromkeys(targets, 0), dict(targets)
    cuts: dict[int, int] = {n: 0 for n, t in need.items() if t <= 0}
    need = {n: t for n, t in need.items() if t > 0}
    for step in range(1, ROUNDS + 1):
        if not need:
            break
        shift = PLACE_BITS + TIE_BITS - step * DIGIT_BITS
        asked = literal_rows(spark, [(n, prefix[n], t) for n, t in need.items()], "node long, _prefix long, _need long")
        inside = keyed.join(F.broadcast(asked), "node").where(F.shiftright("key", shift + DIGIT_BITS) == F.col("_prefix"))
        bins = inside.groupBy("node", "_need", F.shiftright("key", shift).alias("bin")).agg(F.sum("weight").alias("weight"))
        upto = F.sum("weight").over(Window.partitionBy("node").orderBy("bin"))
        running = bins.withColumn("_upto", upto)
        # The first bin that reaches the target; without one, all units are before it.
        at = F.min(F.when(F.col("_upto") >= F.col("_need"), F.struct("bin", "_upto", "weight"))).alias("at")
        for row in running.groupBy("node").agg(at).collect():
            node, found = row["node"], row["at"]
            if found is None:
                cuts[node] = 1 << (PLACE_BITS + TIE_BITS)
                del need[node]
                continue
            before = found["_upto"] - found["weight"]
            prefix[node], need[node] = found["bin"], need[node] - before
            if step == ROUNDS:
                cuts[node] = found["bin"] + (2 * need[node] >= found["weight"])
    return cuts


def _with_slots(placed: DataFrame) -> DataFrame:
    order = [F.col("shard"), F.col("doc_id").asc_nulls_last(), F.col("text_crc32"), F.col("size"), F.col("unit")]
    numbered = materialise(ranked(placed, order, "_rank"), "numbered")
    counts = numbered.groupBy("shard").agg(F.min("_rank").alias("_first"))
    return numbered.join(F.broadcast(counts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("_rank") - F.col("_first")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
