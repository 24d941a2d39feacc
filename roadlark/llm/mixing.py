"""Mixing sources to target weights by a hash threshold for each source.

Words are summed by source and hash bucket. Along the buckets the first one that reaches
the budget holds the threshold; its documents alone are dealt out anew by the next digits
of their hash, until one hash value is left. Which documents are taken then is a
comparison of two numbers for each row; nothing is sorted. A larger budget has a higher
threshold, so what a small mix takes, a larger one takes too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from roadlark.llm.common import ranked, text_of
from roadlark.operators.joins import lookup_join
from roadlark.session import materialise

HASH_BITS = 60
LEVEL_BITS = 12

# What a text's words are: runs of anything but a space and the five control characters.
WORD = r"[^\x20\x09-\x0D]+"


def source_key() -> Column:
    """The source as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))


def doc_hash() -> Column:
    """60 bits of a digest of id and text; the same for repeated rows."""
    written = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), text_of())
    return F.conv(F.substring(F.md5(written.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with _size (words), _key (source) and _hash."""
    return docs.withColumns(
        {"_size": F.regexp_count(text_of(), F.lit(WORD)).cast("long"), "_key": source_key(), "_hash": doc_hash()}
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(_key, source, source_size, target) for each source.

    The sources in code-point order (null last) weigh ``weights``, repeating. They share
    ``share`` times all words; a target stops at ``most`` times its source's words, and
    what is over is shared again by weight among the others until none is above. The
    driver sees three sums a round.
    """
    sources = sizes.groupBy("_key", "source").agg(F.sum("_size").alias("source_size"))
    placed = ranked(sources, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = materialise(placed.select("_key", "source", "source_size", weight.alias("_weight")), "sources")
    top = F.col("source_size") * most
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    unit, before = 0.0, -1
    while True:
        above = top < F.col("_weight") * unit
        full, rest, count = weighed.agg(
            F.coalesce(F.sum(F.when(above, top)), F.lit(0)),
            F.sum(F.when(~above, F.col("_weight"))),
            F.count(F.when(above, 1)),
        ).first()
        if count == before or not rest:
            break
        before, unit = count, max(unit, (total * share - full) / rest)
    target = F.least(top.cast("double"), F.col("_weight") * F.lit(unit))
    return weighed.select("_key", "source", "source_size", target.alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(_key, source_size, target, _times, _below): each document of the source is taken
    _times times, and once more if its hash is below _below.

    Documents are taken in the order of their hash as long as the words so far and the
    words with the next ones together come to less than twice the budget; those of one
    hash, repeated rows, stand or fall together.
    """
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("_times", times.cast("int")).select(
        "_key",
        "source_size",
        "target",
        "_times",
        (F.col("target") - F.col("_times") * F.col("source_size")).alias("_left"),
        F.lit(0).cast("long").alias("_prefix"),
    )
    state = materialise(state, "budgets")
    inside, keys = sizes.select("_key", "_hash", "_size"), ["_key"]
    for bits in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        # At most 2 ** LEVEL_BITS rows of a source meet in the window.
        histogram = inside.groupBy("_key", F.shiftright("_hash", bits).alias("_bucket")).agg(
            F.sum("_size").alias("_size")
        )
        order = Window.partitionBy("_key").orderBy("_bucket")
        summed = histogram.withColumn("_with", F.sum("_size").over(order))
        reached = (
            lookup_join(summed, state.select("_key", "_left"), "_key", "inner")
            .where(F.col("_with") >= F.col("_left"))
            .groupBy("_key")
            .agg(F.min(F.struct("_bucket", "_with", "_size")).alias("_cut"))
        )
        state = materialise(
            state.join(reached, keys, "left").select(
                "_key",
                "source_size",
                "target",
                "_times",
                (F.col("_left") - F.coalesce(F.col("_cut._with") - F.col("_cut._size"), F.lit(0))).alias("_left"),
                F.col("_cut._bucket").alias("_prefix"),
                F.col("_cut._size").alias("_last"),
            ),
            "budgets",
        )
        if bits:
            cut = state.where(F.col("_prefix").isNotNull()).select("_key", "_prefix")
            inside = lookup_join(inside, cut, "_key", "inner")
            inside = inside.where(F.shiftright("_hash", bits) == F.col("_prefix")).drop("_prefix")
            inside = materialise(inside, "boundary")
    # No bucket reached the budget: every document is taken.
    below = F.when(F.col("_prefix").isNull(), F.lit(1 << HASH_BITS)).otherwise(
        F.col("_prefix") + F.when(F.col("_last") < 2 * F.col("_left"), 1).otherwise(0)
    )
    return state.select("_key", "source_size", "target", "_times", below.alias("_below"))


def mixed(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """``docs``, measured, with source_size, target and _copies: how often a row is taken."""
    joined = lookup_join(docs, cuts, "_key")
    once_more = F.when(F.col("_hash") < F.col("_below"), 1).otherwise(0)
    return joined.withColumn("_copies", F.col("_times") + once_more).drop("_times", "_below")


def plan(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, _size, _key, _hash) of all documents, written, and the thresholds."""
    sizes = materialise(measured(docs.select("doc_id", "source", "text")).drop("text"), "sizes")
    return sizes, thresholds(sizes, source_targets(sizes, weights, share, most))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    A null text has no words, a null source is a source of its own and the last one, a
    null id is hashed as an empty one. Repeated rows have one hash and are taken alike. A
    document without words is taken by its hash like others and adds none. An empty table
    gives an empty result. Columns beside doc_id, source and text are not looked at.
    """
    sizes, cuts = plan(docs, weights, share, most)
    return mixed(sizes, cuts).select(
        "doc_id",
        "source",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def repeated(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """The documents of the mix, each row as often as it is taken, with their columns,
    whatever they are called. Nulls, repeated rows and empty tables are as in ``mix``."""
    _, cuts = plan(docs, weights, share, most)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = mixed(measured(docs.select("doc_id", "source", "text", row)), cuts).where(F.col("_copies") > 0)
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return rows.select("_row", copies.alias("_copy")).select("_row.*")
