"""One batch of raw posts to enriched events and classified vehicles."""

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from roadlark import schemas
from roadlark.operators.fill import fill_event_time
from roadlark.operators.locations import (
    known_locations, missing_locations, one_row_per_location,
)
from roadlark.operators.parse import parse_posts
from roadlark.operators.upsert import new_locations
from roadlark.operators.vehicles import classify_vehicles, explode_vehicles
from roadlark.session import empty_table, materialise

Resolver = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Places:
    """A location dimension and what resolving the unknown locations of a batch adds.

    ``new_locations`` are the rows to insert, ``dim`` includes them, ``unresolved`` lists
    the locations that neither the dimension nor the resolver knows.
    """

    dim: DataFrame
    new_locations: DataFrame
    unresolved: DataFrame


def resolve_places(
    events: DataFrame, dim_locations: DataFrame, resolver: Resolver | None = None, keep_unresolved: bool = False
) -> Places:
    """Ask the resolver for the locations the dimension lacks. Its answers are written
    once, as it may be slow or not repeatable, and so are the rows they add, which several
    plans read. Locations without a city stay out of the dimension, so that they are asked
    again next time, unless they are to be kept."""
    missing = missing_locations(events, dim_locations)
    if resolver is not None:
        missing = materialise(missing, "missing")
    else:
        nothing = empty_table(events.sparkSession, schemas.TABLES["dim_locations"][0])
        return Places(dim_locations, nothing, missing)
    resolved = materialise(resolver(missing), "resolved")
    nowhere = F.col("city") == ""
    found = resolved if keep_unresolved else resolved.where(~nowhere)
    added = materialise(new_locations(found, dim_locations), "new-locations")
    # Also what the resolver has not answered at all.
    unresolved = missing.select("location").join(resolved.where(~nowhere), "location", "left_anti")
    return Places(dim_locations.unionByName(added), added, unresolved)


def attach_places(
    events: DataFrame, places: Places, one_per_location: bool = True, **join_options
) -> DataFrame:
    """Events with the dimension columns of their location."""
    dim = one_row_per_location(places.dim) if one_per_location else places.dim
    return known_locations(events, dim, **join_options)


def enrich_locations(
    events: DataFrame,
    dim_locations: DataFrame,
    resolver: Resolver | None = None,
    one_per_location: bool = True,
    keep_unresolved: bool = False,
) -> tuple[DataFrame, Places]:
    """Resolve the unknown locations of a table of events and attach all of them."""
    places = resolve_places(events, dim_locations, resolver, keep_unresolved)
    return attach_places(events, places, one_per_location), places


class Batch:
    """The tables that come out of a batch of raw posts; see ``process_batch``.

    The posts are scanned and parsed once, into a written table, when the batch is made.
    Each result is planned over that table when first asked for and reads only the
    columns it needs.
    """

    def __init__(
        self,
        posts: DataFrame,
        dim_locations: DataFrame,
        dim_vehicles: DataFrame,
        order: str = "post_seq",
        groups: tuple[str, ...] = (),
        resolver: Resolver | None = None,
        one_per_location: bool = True,
        keep_unresolved: bool = False,
        date_mode: str = "own",
        drop_numeric: bool = False,
    ):
        self.dim_locations, self.dim_vehicles = dim_locations, dim_vehicles
        self.order, self.groups, self.resolver = order, groups, resolver
        self.one_per_location, self.keep_unresolved = one_per_location, keep_unresolved
        self.date_mode, self.drop_numeric = date_mode, drop_numeric
        self.parsed = materialise(parse_posts(posts, carry=(order, *groups)), "parsed")

    @cached_property
    def places(self) -> Places:
        return resolve_places(self.parsed, self.dim_locations, self.resolver, self.keep_unresolved)

    @property
    def new_locations(self) -> DataFrame:
        return self.places.new_locations

    @property
    def unresolved(self) -> DataFrame:
        return self.places.unresolved

    @cached_property
    def events(self) -> DataFrame:
        """Enriched events: times filled, location attached."""
        timed = fill_event_time(self.parsed, self.order, self.groups)
        located = attach_places(timed, self.places, self.one_per_location, keys_from=self.parsed)
        return located.select(*schemas.EVENT_COLUMNS)

    @cached_property
    def dated_vehicles(self) -> DataFrame:
        """Classified vehicles with the date of their event, or of the batch, and always
        their event's own as ``event_date``, by which the facts are kept."""
        listed = explode_vehicles(self.parsed, ("date",), self.drop_numeric)
        classified = classify_vehicles(listed, self.dim_vehicles)
        own = classified.withColumn(schemas.EVENT_DATE, F.col("date"))
        if self.date_mode == "first":
            return own.withColumn("date", F.lit(first_date(self.parsed, self.order)))
        return own

    @property
    def vehicles(self) -> DataFrame:
        """Classified vehicles with the date of their event, or of the batch."""
        return self.dated_vehicles.drop(schemas.EVENT_DATE)


def process_batch(posts: DataFrame, dim_locations: DataFrame, dim_vehicles: DataFrame, **options) -> Batch:
    """Parse, fill times, resolve and attach locations, explode and classify vehicles.

    Options: missing times are filled in ``order`` within ``groups`` (such as the source
    file); ``resolver`` turns a table of unknown locations into resolved ones;
    ``one_per_location`` attaches the most accurate city where a location is known in
    several, instead of one event row per city; ``keep_unresolved`` lets locations without
    a city into the dimension; ``date_mode="first"`` dates every vehicle row with the
    first date of the batch in place of its event's own; ``drop_numeric`` leaves out
    vehicles that are only a number.
    """
    return Batch(posts, dim_locations, dim_vehicles, **options)


def first_date(parsed: DataFrame, order: str):
    """First non-null date in row order; null for a batch without any date."""
    dated = parsed.where(F.col("date").isNotNull())
    return dated.agg(F.min_by("date", order).alias("date")).first()["date"]
