"""Location dimension: attach known places, find unknown ones, resolve them."""

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from roadlark import rules
from roadlark.functions import keys, places
from roadlark.operators.joins import lookup_join, one_row_per_key

DIM_COLUMNS = ["location_id", "city", "location", "latitude", "longitude", "accuracy"]


def one_row_per_location(dim: DataFrame) -> DataFrame:
    """Keep the most accurate row of a location that is known in several cities."""
    rank = F.struct(
        -F.coalesce(F.col("accuracy"), F.lit(0.0)), *[F.col(c) for c in DIM_COLUMNS if c != "location"]
    )
    best = dim.groupBy("location").agg(F.min(rank).alias("best"))
    return best.select("location", "best.*").select(*DIM_COLUMNS)


def known_locations(events: DataFrame, dim: DataFrame, **join_options) -> DataFrame:
    """Every event with the dimension columns of its location, null where unknown.

    An event whose location is known in several cities appears once per city.
    """
    return lookup_join(events, dim.select(*DIM_COLUMNS), "location", "left", **join_options)


def missing_locations(events: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct locations the dimension does not know; the empty location counts too.

    Distinct comes first, so a location shared by many events is one row per map task.
    """
    return events.select("location").distinct().join(dim.select("location"), "location", "left_anti")


def resolved_columns(city: Column) -> list[Column]:
    """A resolver's answer as a dimension row; no hit gives no city and zeros."""
    return [
        F.when(F.col("hit"), places.city_name(city)).otherwise("").alias("city"),
        F.col("location"),
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
        places.accuracy_score(F.col("confidence")).alias("accuracy"),
    ]


def resolve_from_gazetteer(
    missing: DataFrame, gazetteer: DataFrame, city_points: DataFrame | None = None, digits: int = 3
) -> DataFrame:
    """Look unknown locations up in a table instead of asking a service.

    ``gazetteer`` has (location, city, latitude, longitude, confidence); a hit without a
    city takes it from ``city_points`` (city, latitude, longitude) at the same rounded
    coordinates. A location without a hit gets the unresolved defaults.
    """
    entries = gazetteer.select("location", "city", "latitude", "longitude", "confidence")
    hits = one_row_per_key(entries, ["location"]).withColumn("hit", F.lit(True))
    found = missing.join(hits, "location", "left")
    city = F.col("city")
    if city_points is not None:
        # Many places may share a city's centre, so the point is a key like any other.
        known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        rounded = F.struct(F.round("latitude", digits).alias("x"), F.round("longitude", digits).alias("y"))
        points = (
            city_points.where(known).groupBy(rounded.alias("_point"))
            .agg(F.min("city").alias("point_city"))
        )
        found = lookup_join(found.withColumn("_point", F.when(known, rounded)), points, "_point")
        city = F.coalesce(F.when(city != "", city), F.col("point_city"))
    return found.select(*resolved_columns(city))


def resolve_with(
    missing: DataFrame,
    resolver: Callable[[list[str]], list[dict | None]],
    batch: int = rules.RESOLVER_BATCH,
    parallel: int | None = None,
) -> DataFrame:
    """Ask a user-supplied resolver, ``batch`` locations per call.

    ``resolver`` answers position by position with a dict of (city, latitude, longitude,
    confidence) or None. A location beyond the end of a short answer stays out of the
    result and is asked again next time. Materialise the result before using it twice.
    """

    def ask(frames: Iterator) -> Iterator:
        import pandas as pd

        names = ["location", "city", "latitude", "longitude", "confidence", "hit"]

        def answered(asked):
            rows = [
                [place] + [(hit or {}).get(n) for n in names[1:5]] + [hit is not None]
                for place, hit in zip(asked, resolver(asked))
            ]
            return pd.DataFrame(rows, columns=names)

        waiting: list[str] = []
        for frame in frames:
            waiting += frame["location"].tolist()
            while len(waiting) >= batch:
                yield answered(waiting[:batch])
                waiting = waiting[batch:]
        if waiting:
            yield answered(waiting)

    asked = missing.select("location")
    if parallel:
        asked = asked.repartition(parallel, "location")
    answers = asked.mapInPandas(
        ask,
        "location string, city string, latitude double, longitude double, confidence string, "
        "hit boolean",
    )
    return answers.select(*resolved_columns(F.col("city")))


def with_location_id(resolved: DataFrame) -> DataFrame:
    return resolved.select(
        keys.location_id(F.col("city"), F.col("location")).alias("location_id"), *DIM_COLUMNS[1:]
    )
