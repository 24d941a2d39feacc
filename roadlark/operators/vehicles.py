"""Vehicles of an event: explode the involved list, classify types by fuzzy match."""

from pyspark.sql import Column, DataFrame, functions as F

from roadlark import rules, schemas
from roadlark.functions import involved, text as tx
from roadlark.operators.fuzzy import best_matches
from roadlark.operators.joins import lookup_join, measure
from roadlark.session import materialise

# Candidates scored against a type inside one row; a larger dimension is indexed.
BLOCK_CANDIDATES = 2048


def explode_vehicles(
    events: DataFrame, carry: tuple[str, ...] = (), drop_numeric: bool = False
) -> DataFrame:
    """One row per (event, listed vehicle); events without a list have none.

    ``drop_numeric`` leaves out entries that are only a number, such as a rally's
    head-count, which otherwise become a vehicle type of their own.
    """
    rows = events.select(
        "event_id", *carry, F.explode(involved.involved_array(F.col("involved"))).alias("v")
    ).select("event_id", "v.vehicle_type", "v.vehicle_count", *carry)
    return rows.where(~F.col("vehicle_type").rlike(r"^\d+$")) if drop_numeric else rows


def verified_types(dim_vehicles: DataFrame) -> DataFrame:
    """(vehicle_type, vehicle_group) of verified rows, one per normal spelling."""
    return (
        dim_vehicles.where(F.col("is_verified"))
        .groupBy(tx.normal_key(F.col("vehicle_type")).alias("vehicle_type"))
        .agg(F.min("vehicle_group").alias("vehicle_group"))
        .where(F.col("vehicle_type").isNotNull())
    )


def match_score(name: Column, candidate: Column) -> Column:
    """1 - edit distance / longer length, plus a bonus if one contains the other."""
    longest = F.greatest(F.length(name), F.length(candidate))
    similarity = F.lit(1.0) - F.levenshtein(name, candidate) / F.when(longest > 0, longest)
    contained = F.contains(name, candidate) | F.contains(candidate, name)
    bonus = F.when(contained, F.lit(rules.CONTAINMENT_BONUS)).otherwise(F.lit(0.0))
    return F.coalesce(similarity, F.lit(1.0)) + bonus


def suggest_types(unknown: DataFrame, verified: DataFrame, min_score: float | None = None) -> DataFrame:
    """Best verified candidate of each distinct unknown type; ties go to the first name.

    The verified types travel as a sorted array and one fold per type keeps the best, so
    no (type, candidate) pair ever becomes a row. A dimension of more than
    ``BLOCK_CANDIDATES`` types is indexed instead (``fuzzy.best_matches``), and a type is
    scored against the few that can be its best; the winners are the same.
    """
    n_types, n_bytes = measure(verified)
    if n_types > BLOCK_CANDIDATES:
        names = unknown.select(F.col("vehicle_type").alias("name")).distinct()
        dimension = verified.select(
            F.col("vehicle_type").alias("candidate"), F.col("vehicle_group").alias("candidate_group")
        )
        matches = best_matches(names, dimension, match_score).found.select(
            F.col("name").alias("vehicle_type"),
            F.col("candidate").alias("suggested_from"),
            F.col("candidate_group").alias("vehicle_group"),
            F.col("score").alias("match_score"),
        )
        return matches if min_score is None else matches.where(F.col("match_score") >= min_score)
    entry = F.struct(
        F.col("vehicle_type").alias("candidate"), F.col("vehicle_group").alias("candidate_group")
    )
    blocks = verified.groupBy(F.lit(0).alias("block")).agg(F.array_sort(F.collect_list(entry)).alias("candidates"))
    name = F.col("vehicle_type")
    start = F.lit(None).cast("struct<score:double,candidate:string,candidate_group:string>")

    def scored(c):
        score = match_score(name, c["candidate"]).alias("score")
        return F.struct(score, c["candidate"].alias("candidate"), c["candidate_group"].alias("candidate_group"))

    def better(best, c):
        return F.when(best.isNull() | (c["score"] > best["score"]), c).otherwise(best)

    # The array holds both text columns of its rows, which is what was measured.
    asked = unknown.select("vehicle_type", F.lit(0).alias("block"))
    partial = lookup_join(asked, blocks, "block", "inner", lookup_bytes=n_bytes).select(
        "vehicle_type", F.reduce(F.transform("candidates", scored), start, better).alias("best")
    )
    found = partial.select(
        "vehicle_type",
        F.col("best.candidate").alias("suggested_from"),
        F.col("best.candidate_group").alias("vehicle_group"),
        F.col("best.score").alias("match_score"),
    )
    return found if min_score is None else found.where(F.col("match_score") >= min_score)


def unknown_types(vehicles: DataFrame, verified: DataFrame) -> DataFrame:
    """Distinct vehicle types in normal spelling that are not verified."""
    types = vehicles.select(tx.normal_key(F.col("vehicle_type")).alias("vehicle_type")).distinct()
    return types.join(verified.select("vehicle_type"), "vehicle_type", "left_anti")


def classify_vehicles(
    vehicles: DataFrame,
    dim_vehicles: DataFrame,
    min_score: float | None = None,
    **join_options,
) -> DataFrame:
    """Add vehicle_group, suggested_from and is_verified to every vehicle row.

    The rows are joined once, to a table of the verified types and the suggestions for
    the distinct other ones; that table is written first, so its size is known.
    """
    verified = verified_types(dim_vehicles)
    suggestions = suggest_types(unknown_types(vehicles, verified), verified, min_score)
    known = verified.select(
        "vehicle_type", "vehicle_group", F.lit(rules.NO_SUGGESTION).alias("suggested_from"),
        F.lit(True).alias("is_verified"),
    )
    suggested = suggestions.select(
        "vehicle_type", "vehicle_group", "suggested_from", F.lit(False).alias("is_verified")
    )
    types = materialise(known.unionByName(suggested), "vehicle-types")
    keyed = vehicles.withColumn("vehicle_type", tx.normal_key(F.col("vehicle_type")))
    joined = lookup_join(keyed, types, "vehicle_type", "left", **join_options)
    carried = [c for c in vehicles.columns if c not in schemas.VEHICLE_COLUMNS]
    return joined.select(
        "event_id",
        "vehicle_type",
        "vehicle_count",
        F.coalesce("vehicle_group", F.lit(rules.UNKNOWN)).alias("vehicle_group"),
        "suggested_from",
        F.coalesce("is_verified", F.lit(False)).alias("is_verified"),
        *carried,
    )
