"""Extractors that turn one upper-cased, stripped post into its fields.

Where a field needs its raw match more than once, the search (``*_text``) and what is
made of its result are separate, so that a plan can compute the search once per row.
"""

from pyspark.sql import Column, functions as F, types as T

from roadlark import rules
from roadlark.functions import text as tx


def post_text(content: Column) -> Column:
    return tx.clean_text(F.upper(content))


def time_text(post: Column, plain: Column | None = None) -> Column:
    """First ``h[:mm] AM/PM`` of the post as written."""
    tidy = F.replace(F.replace(post, F.lit(";"), F.lit(":")), F.lit("."), F.lit(""))
    # What is replaced leaves a plain post plain, and any other one as it is in that.
    plain = tx.is_plain(post) if plain is None else plain
    return tx.first_group(tidy, rules.TIME_PATTERN, 0, plain)


def clock(time_text: Column) -> Column:
    """The written time as struct<hour, minute, pm>, all null if there is none."""
    minute = F.when(
        F.contains(time_text, F.lit(":")), tx.whole_number(F.regexp_extract(time_text, r":\D*(\d+)", 1))
    )
    return F.struct(
        tx.whole_number(F.regexp_extract(time_text, r"^(\d+)", 1)).alias("hour"),
        F.coalesce(minute, F.lit(0)).alias("minute"),
        F.endswith(time_text, F.lit("PM")).alias("pm"),
    )


def clock_time(clock: Column) -> Column:
    """``HH:mm``; null if the struct is not a 12-hour time of day."""
    hour, minute = clock["hour"], clock["minute"]
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    written = F.concat(
        two(hour % 12 + F.when(clock["pm"], 12).otherwise(0)), F.lit(":"), two(minute)
    )
    return F.when(hour.between(1, 12) & minute.between(0, 59), written)


def number_word(word: Column) -> Column:
    """Digits or ZERO..TEN as int, anything else (also beyond int range) null."""
    known = F.try_element_at(tx.literal_map(rules.NUMBER_WORDS), word)
    return F.coalesce(known, tx.whole_number(word))


def lanes_text(post: Column, plain: Column | None = None) -> Column:
    found = tx.first_group(post, rules.LANES_PATTERN, plain=plain)
    return F.when(F.contains(post, F.lit(rules.LANES_HINT)), found)


def incident_type(post: Column, plain: Column | None = None) -> Column:
    return tx.strip(tx.first_group(post, rules.TYPE_PATTERN, plain=plain))


def direction(post: Column, plain: Column | None = None) -> Column:
    tokens = tx.all_groups(post, rules.DIRECTION_PATTERN, plain)
    return F.try_element_at(tokens, F.lit(-1))


def is_rally(post: Column) -> Column:
    return F.contains(post, F.lit(rules.RALLY_WORD))


def is_stalled(post: Column) -> Column:
    return F.contains(post, F.lit(rules.STALLED_WORD))


def place_text(post: Column, plain: Column | None = None) -> Column:
    """The stretch of the post that names the place, as written."""
    return F.when(
        is_rally(post), tx.first_group(post, rules.RALLY_LOCATION_PATTERN, 2, plain)
    ).otherwise(tx.first_group(post, rules.LOCATION_PATTERN, 2, plain))


def place_words(post: Column, place: Column, plain: Column | None = None) -> Column:
    """The place without a trailing list of participants and without directions."""
    plain = tx.is_plain(place) if plain is None else plain
    has_tail = ~is_rally(post) & F.contains(place, F.lit(rules.LOCATION_TAIL_HINT))
    place = F.when(
        has_tail, tx.replaced(place, rules.LOCATION_TAIL_PATTERN, "", plain)
    ).otherwise(place)
    return tx.strip_direction(place, plain)


def place_name(words: Column) -> Column:
    """Regular spelling of a place."""
    return tx.strip(F.replace(tx.respell_place(words), F.lit("Ñ"), F.lit("N")))


def participants_text(post: Column, plain: Column | None = None) -> Column:
    """Who was involved, as written; for a rally the head-count, without leading zeros."""
    heads = tx.whole_number(tx.first_group(post, rules.RALLY_COUNT_PATTERN, plain=plain), "decimal(38,0)")
    listed = tx.strip(tx.first_group(post, rules.PARTICIPANTS_PATTERN, plain=plain))
    return (
        F.when(is_rally(post), heads.cast("string"))
        .when(is_stalled(post), tx.strip(tx.first_group(post, rules.STALLED_PATTERN, plain=plain)))
        .otherwise(F.rtrim(listed, F.lit(",")))
    )


def post_date(value: Column, data_type: T.DataType) -> Column:
    """Date of a date, timestamp or text column; other types have no date."""
    if isinstance(data_type, T.DateType):
        return value
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(value)
    if isinstance(data_type, T.StringType):
        written = F.regexp_replace(tx.strip(value), rules.SPACES_PATTERN, " ")
        tries = [
            F.when(written.rlike(shape), F.try_to_timestamp(written, F.lit(form)))
            for shape, form in rules.DATE_FORMATS.items()
        ]
        return F.to_date(F.coalesce(*tries))
    return F.lit(None).cast("date")


def event_timestamp(date: Column, time: Column) -> Column:
    """Zone-free timestamp; null when either half is missing."""
    return F.concat(date.cast("string"), F.lit(" "), time, F.lit(":00")).try_cast("timestamp_ntz")


def event_type(details: Column) -> Column:
    """Classify a raw incident type; the first matching rule wins."""
    label = F.lit(rules.EVENT_TYPE_DEFAULT)
    for pattern, name in reversed(rules.EVENT_TYPE_RULES):
        label = F.when(details.like(pattern), name).otherwise(label)
    return label
