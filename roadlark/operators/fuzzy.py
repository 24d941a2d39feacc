"""Best match of each name in a large dimension, without comparing it with all of it.

The score of a pair is ``match_score``: 1 - edit distance / longer length, plus a bonus if
one name contains the other. The dimension is cut into blocks along the order of names, and
along that of reversed names where these are searched from their ends. A task takes one
block and a slice of the names and looks them up in a tree of the block's prefixes
(``prefixes``), where names that begin alike are looked at once. It hands over the best it
meets for each name, which is scored here.

Names are looked up with few edits first. Where the best found is better than all with
more edits can be, it is the best of all; the others come again with more edits, and with
every candidate whose length can reach their best so far once most of their letters would
be edited. The winners are those of a comparison with every name.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from roadlark.operators.joins import lookup_join, measure
from roadlark.operators.numbering import numbered
from roadlark.operators.prefixes import best_nested, best_within
from roadlark.session import materialise, observed

EDITS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32)  # of the visits
LETTERS = 2  # of a name for each edit and one more, or it is compared with all that can be better
TASK_NAMES = 1 << 10  # compared by one task, where that makes enough tasks
BLOCK = 1 << 18  # candidates, or names, that a task holds at once
BLOCK_LETTERS = 1 << 23  # of these candidates
LEAST_SLICE = 1 << 6  # names for which a task takes a block
ROUNDING = 1e-9  # kept on the safe side of every bound


@dataclass(frozen=True)
class Matches:
    """``found``: (name, candidate, candidate_group, score); ``compared``: pairs scored."""

    found: DataFrame
    compared: int


def best_matches(names: DataFrame, dimension: DataFrame, score, edits: tuple[int, ...] = EDITS) -> Matches:
    """The best candidate of each ``name``; of equal scores the first in the order of names.

    ``names`` has a column ``name`` of distinct values, ``dimension`` (candidate,
    candidate_group) of distinct candidates, none null; ``score(name, candidate)`` is the
    score as a column. A null name has the first candidate, with score 1. An empty
    dimension gives no rows.
    """
    index = _Index(dimension)
    asked = _ranked(names.where(F.col("name").isNotNull()), index.frequency)
    waiting = materialise(asked.withColumn("best", F.lit(None).cast(_BEST)), "waiting")
    done, compared, met = [_of_null(names, index.known)], 0, 0

    def visited(pairs: DataFrame) -> DataFrame:
        """``waiting`` with the best of ``pairs`` too."""
        nonlocal compared
        seen = Observation()
        scored = pairs.observe(seen, F.count(F.lit(1)).alias("pairs")).select(
            "name", "rank", score(F.col("name"), F.col("candidate")).alias("value")
        )
        # Fixed-size keys and minima, which collapse in the task without being sorted.
        firsts = scored.groupBy("name", "value").agg(F.min("rank").alias("rank"))
        new = firsts.groupBy("name").agg(F.min(F.struct((-F.col("value")).alias("minus"), "rank")).cast(_BEST).alias("_new"))
        new = materialise(new, "best")
        compared += observed(seen, "pairs")
        joined = waiting.join(new, "name", "left")
        better = F.col("best").isNull() | (F.col("_new") < F.col("best"))
        best = F.when(F.col("_new").isNotNull() & better, F.col("_new")).otherwise(F.col("best"))
        return materialise(joined.withColumn("best", best).drop("_new"), "waiting")

    for most in (0, *edits, None):
        if most == 0:  # without an edit the names contain one another
            short = F.lit(False)
            pairs = index.nested(waiting)
        else:
            short = F.lit(True) if most is None else F.col("size") < LETTERS * (most + 1)
            pairs = index.reaching(waiting.where(short))
            if most is not None:
                pairs = pairs.unionByName(index.near(waiting.where(~short), most, met))
                met = most
        waiting = visited(pairs)
        # A candidate not met has more edits, and is at best by those longer.
        others = F.col("size") / (F.col("size") + ((most or 0) + 1)) + ROUNDING
        sure = short | F.coalesce(-F.col("best.minus") > others, F.lit(False))
        done.append(waiting.where(sure).select("name", "best"))
        waiting = waiting.where(~sure)
        if waiting.isEmpty():
            break
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    found = found.where(F.col("best").isNotNull()).select("name", "best.rank", (-F.col("best.minus")).alias("score"))
    named = found.join(index.known, "rank").select("name", "candidate", "candidate_group", "score")
    return Matches(named, compared)


_BEST = "struct<minus: double, rank: bigint>"


def _of_null(names: DataFrame, known: DataFrame) -> DataFrame:
    first = known.where(F.col("rank") == 0).select(F.struct(F.lit(-1.0).alias("minus"), "rank").cast(_BEST).alias("best"))
    return names.where(F.col("name").isNull()).select("name").join(F.broadcast(first))


def _ranked(names: DataFrame, frequency: DataFrame) -> DataFrame:
    """``names`` with their length and how far it is from that of any candidate."""
    lengths = frequency.agg(F.collect_list("long").alias("_longs"))
    apart = F.array_min(F.transform("_longs", lambda long: F.abs(long - F.col("size"))))
    sized = names.select("name", F.length("name").alias("size"))
    return sized.join(F.broadcast(lengths)).select("name", "size", apart.alias("apart"))


class _Index:
    """The dimension, numbered in the order of names and cut into blocks."""

    def __init__(self, dimension: DataFrame):
        placed = numbered(dimension.select("candidate", "candidate_group"), [F.col("candidate")], "rank")
        self.known = placed.withColumn("long", F.length("candidate"))
        self.turned = numbered(placed.select("candidate", "rank"), [F.reverse("candidate")], "turned")
        self.bytes = measure(self.known)[1]
        # How many candidates are how long.
        counts = self.known.where(F.col("long").isNotNull()).groupBy("long").agg(F.count("*").alias("n"))
        self.frequency = materialise(counts, "lengths")
        total = self.frequency.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("long")).alias("letters"), F.max("long").alias("long"))
        count, letters, self.longest = (value or 0 for value in total.first())
        self.blocks = max(1, math.ceil(count / BLOCK), math.ceil(letters / BLOCK_LETTERS))
        self.block = max(1, math.ceil(count / self.blocks))

    def _lengths(self) -> Column:
        """array of the lengths of candidates that can be as good as the best so far."""
        best, size = F.coalesce(-F.col("best.minus"), F.lit(0.0)), F.col("size")
        first = F.ceil(F.least(best, F.lit(1.0)) * size - ROUNDING).cast("int")
        last = F.when(best > 0, F.floor(size / F.least(best, F.lit(1.0)) + ROUNDING)).otherwise(self.longest)
        last = F.least(last, F.lit(self.longest)).cast("int")
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    def _by_block(self, waiting: DataFrame, held: DataFrame, place: str, search) -> DataFrame:
        """What ``search`` finds for each slice of the names in each block of ``held``, cut by ``place``."""
        cores = waiting.sparkSession.sparkContext.defaultParallelism
        count, letters = waiting.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        wanted = min(math.ceil(4 * cores / self.blocks), math.ceil(count / LEAST_SLICE))
        slices = max(1, wanted, math.ceil(count / BLOCK), math.ceil(letters / BLOCK_LETTERS))
        part = F.pmod(F.xxhash64("name"), F.lit(slices))
        blocks = F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))).alias("_block")
        best = F.coalesce(-F.col("best.minus"), F.lit(0.0)).alias("best")
        asked = waiting.select("name", best, part.alias("_slice"), blocks)
        numbers = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice")
        block = F.least(F.floor(F.col(place) / self.block), F.lit(self.blocks - 1)).alias("_block")
        held = held.where(F.col("candidate").isNotNull()).select("candidate", "rank", block, numbers)
        # More partitions than pieces of work, so that few get two.
        pieces, number = 3 * self.blocks * slices, (F.col("_block") * slices + F.col("_slice")).alias("_piece")
        asked = asked.select("name", "best", number).repartition(pieces, "_piece").groupBy("_piece")
        held = held.select("candidate", "rank", number).repartition(pieces, "_piece").groupBy("_piece")
        return asked.cogroup(held).applyInArrow(search, "name string, candidate string, rank bigint")

    def nested(self, waiting: DataFrame) -> DataFrame:
        """Of each name in each block the best that contains it or is contained in it."""
        return self._by_block(waiting, self.known, "rank", lambda asked, held: best_nested(asked, held))

    def near(self, waiting: DataFrame, most: int, met: int = 0) -> DataFrame:
        """Of each name in each block the best that is as good as the best so far, with no
        more than ``most`` edits, where ``met`` edits are not enough to find it."""
        reached = waiting.where(F.col("apart") <= most)
        # Cut along the order in which they are searched, most blocks are left at their first letters.
        forwards = self._by_block(
            reached, self.known, "rank", lambda asked, held: best_within(asked, held, most, met, False)
        )
        backwards = self._by_block(
            reached, self.turned, "turned", lambda asked, held: best_within(asked, held, most, met, True)
        )
        return forwards.unionByName(backwards)

    def reaching(self, waiting: DataFrame) -> DataFrame:
        """Pairs whose lengths let them be as good as the best so far."""
        cores = waiting.sparkSession.sparkContext.defaultParallelism
        tasks = max(4 * cores, math.ceil(waiting.count() / TASK_NAMES))
        # A name is a small row and much work.
        asked = waiting.repartition(tasks, "name").select("name", F.explode(self._lengths()).alias("long"))
        return lookup_join(asked, self.known, "long", "inner", lookup_bytes=self.bytes).select(*_PAIR)


_PAIR = ("name", "candidate", "rank")
