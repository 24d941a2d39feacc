"""Raw posts to parsed events: projections only, without a UDF or a shuffle.

Each field can also be had alone: Catalyst drops the steps behind columns not selected.
"""

from pyspark.sql import Column, DataFrame, functions as F

from roadlark.functions import fields, involved, keys, text as tx
from roadlark.session import built_once


@built_once
def _list_columns() -> list[Column]:
    """From a participants text in ``_list`` to the counted list, step by step."""
    steps = [*involved.LIST_STEPS, involved.count_entries, involved.involved_text]
    return [step(F.col("_list")) for step in steps]


@built_once
def _searches() -> dict[str, Column]:
    post, plain = F.col("post"), F.col("_plain")
    return {
        "_time": fields.time_text(post, plain),
        "_place": fields.place_text(post, plain),
        "direction": fields.direction(post, plain),
        "type": fields.incident_type(post, plain),
        "_lanes": fields.lanes_text(post, plain),
        "_participants": fields.participants_text(post, plain),
    }


@built_once
def _readings() -> dict[str, Column]:
    return {
        "_time": fields.clock(F.col("_time")),
        "_place": fields.place_words(F.col("post"), F.col("_place"), F.col("_plain")),
        "lanes_blocked": fields.number_word(F.col("_lanes")),
    }


@built_once
def _names() -> dict[str, Column]:
    return {"time": fields.clock_time(F.col("_time")), "location": fields.place_name(F.col("_place"))}


@built_once
def _identity() -> list[Column]:
    date, time, location, post = (F.col(c) for c in ("date", "time", "location", "post"))
    return [
        keys.event_id(date, time, location, post).alias("event_id"),
        fields.event_timestamp(date, time).alias("event_timestamp"),
    ]


def with_involved(df: DataFrame, participants: str, into: str = "involved") -> DataFrame:
    """Add the counted vehicle list of a participants text; null where there is none."""
    df = df.withColumn("_list", tx.blank_to_null(F.col(participants)))
    for step in _list_columns():
        df = df.withColumn("_list", step)
    return df.withColumnRenamed("_list", into)


def parse_posts(
    posts: DataFrame,
    content: str = "content",
    created_at: str = "created_at",
    link: str = "tweetlinkid",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The 11 event fields of every post; ``carry`` names further columns to keep.

    What several expressions share (the cleaned post, a raw match) is a column of an
    earlier projection, so each search runs once per row.
    """
    texts = posts.select(
        fields.post_text(F.col(content)).alias("post"),
        tx.clean_text(F.col(link)).alias("link"),
        fields.post_date(F.col(created_at), posts.schema[created_at].dataType).alias("date"),
        *carry,
    )
    marked = texts.withColumn("_plain", tx.is_plain(F.col("post")))
    read = marked.withColumns(_searches()).withColumns(_readings())
    named = with_involved(read, "_participants").withColumns(_names())
    event_id, event_timestamp = _identity()
    return named.select(
        event_id, "date", "time", event_timestamp, "location", "direction", "type",
        "lanes_blocked", "involved", "post", "link", *carry,
    )
