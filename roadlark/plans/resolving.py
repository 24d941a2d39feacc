"""Asking a slow service for places, with a log of what it has answered.

The unknown locations are numbered once, in their own order, and cut into batches. Rounds
of batches are asked as one job each and appended to the log. The first round has a few
batches and each later one twice as many, so their number hardly grows with the batches. A
task puts its answers into the log when it ends; so a run that breaks off has lost what
its running tasks were asking, and the next one goes on with the batches the log lacks. A
batch whose call fails is recorded with its error and asked again in later rounds, a few
times; an answer shorter than the batch leaves the rest of it unanswered.

    <log>/asked/     (batch, place, location), written once
    <log>/answers/   (batch, attempt, location, …, answered, error), appended by rounds
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from roadlark import rules
from roadlark.operators.locations import resolved_columns
from roadlark.operators.numbering import numbered
from roadlark.session import empty_table
from roadlark.sources.batches import Files

Resolver = Callable[[list[str]], list[dict | None]]

TRIES = 3
ROUND_BATCHES = 64  # batches of the first round
TASK_BATCHES = 256  # batches a task asks, about, where that makes a task for each core
# A task's file is put in place when the task ends, not when all have.
AS_TASKS_END = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
ANSWERS = (
    "batch bigint, attempt int, location string, city string, latitude double, longitude double, confidence string, "
    "hit boolean, answered boolean, error string"
)


@dataclass(frozen=True)
class Resolved:
    """``found`` are rows for the dimension's staging, ``unresolved`` (location, attempts)
    what has no answer or no hit; together they are what was asked."""

    found: DataFrame
    unresolved: DataFrame
    answers: DataFrame


class AnswerLog:
    """The log of one set of unknown locations, below a folder all executors reach."""

    def __init__(self, spark, path: str):
        self.spark, self.path, self.files = spark, path.rstrip("/"), Files(spark)

    def asked(self, missing: DataFrame, size: int) -> DataFrame:
        """The numbered locations: those the log has, or else ``missing``, each once."""
        path = f"{self.path}/asked"
        if not self.files.exists(f"{path}/_SUCCESS"):
            rows = numbered(missing.select("location").where("location is not null").distinct(), [F.col("location")], "place")
            rows.withColumn("batch", F.floor(F.col("place") / size).cast("bigint")).write.mode("overwrite").parquet(path)
        return self.spark.read.schema("location string, place bigint, batch bigint").parquet(path)

    def answers(self) -> DataFrame:
        path = f"{self.path}/answers"
        if not self.files.exists(path):
            return empty_table(self.spark, ANSWERS)
        return self.spark.read.schema(ANSWERS).parquet(path)

    def open_batches(self, asked: DataFrame, tries: int) -> DataFrame:
        """(batch, attempt) still to be asked: never, or failed fewer than ``tries`` times."""
        calls = self.answers().groupBy("batch").agg(
            F.max("attempt").alias("_last"), F.bool_or(F.col("error").isNull()).alias("_done")
        )
        every = asked.select("batch").distinct().join(calls, "batch", "left")
        waiting = every.where(F.col("_last").isNull() | (~F.col("_done") & (F.col("_last") < tries)))
        return waiting.select("batch", (F.coalesce("_last", F.lit(0)) + 1).alias("attempt"))


def resolve_in_batches(
    missing: DataFrame,
    resolver: Resolver,
    log: str,
    batch: int = rules.RESOLVER_BATCH,
    tries: int = TRIES,
    round_batches: int = ROUND_BATCHES,
) -> Resolved:
    """Asks ``resolver`` for the distinct locations of ``missing``, ``batch`` at a time.

    It answers position by position with a dict of (city, latitude, longitude, confidence)
    or None. ``log`` belongs to this set of locations: calling again with the same folder
    asks only what it lacks. A null location is not asked.
    """
    spark = missing.sparkSession
    book = AnswerLog(spark, log)
    asked = book.asked(missing, batch)
    total = asked.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]

    def answer(hit: dict | None) -> tuple:
        """(city, latitude, longitude, confidence, hit, answered)"""
        if hit is None:
            return None, None, None, None, False, True
        x, y = (None if hit.get(k) is None else float(hit[k]) for k in ("latitude", "longitude"))
        city, sure = (None if hit.get(k) is None else str(hit[k]) for k in ("city", "confidence"))
        return city, x, y, sure, True, True

    def ask(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            for row in frame.itertuples(index=False):
                places, error = sorted(row.locations), None
                try:
                    hits = [answer(hit) for hit in resolver(places)]
                except Exception as failure:  # any failure of the service is recorded
                    hits, error = [], f"{type(failure).__name__}: {failure}"
                hits = hits[: len(places)]
                hits += [(None, None, None, None, False, False)] * (len(places) - len(hits))
                lines = [[row.batch, row.attempt, place, *hit, error] for place, hit in zip(places, hits)]
                names = [c.split()[0] for c in ANSWERS.split(", ")]
                yield pd.DataFrame(lines, columns=names)

    size = round_batches
    while True:
        waiting = book.open_batches(asked, tries)
        first = waiting.agg(F.min(F.struct("attempt", "batch")).alias("first")).first()["first"]
        if first is None:
            break
        near = F.col("batch").between(first.batch, first.batch + size - 1)
        turn = waiting.where((F.col("attempt") == first.attempt) & near)
        calls = asked.join(turn, "batch").groupBy("batch", "attempt")
        lists = calls.agg(F.collect_list("location").alias("locations"))
        parts = min(size, max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BATCHES)))
        told = lists.repartition(parts, "batch").mapInPandas(ask, ANSWERS)
        told.write.mode("append").options(**AS_TASKS_END).parquet(f"{book.path}/answers")
        # A round is a stretch of batch numbers: none is longer than all of them.
        size = min(2 * size, max(size, total))
    answers = book.answers()
    told = answers.where("answered")
    found = told.where("hit").select(*resolved_columns(F.col("city")))
    tried = answers.groupBy("location").agg(F.max("attempt").alias("attempts"), F.bool_or("hit").alias("_hit"))
    return Resolved(found, tried.where(~F.col("_hit")).select("location", "attempts"), answers)
