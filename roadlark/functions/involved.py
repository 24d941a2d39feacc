"""From a free-text list of participants to counted vehicle types, all in-row."""

from functools import reduce

from pyspark.sql import Column, functions as F

from roadlark import rules
from roadlark.functions import text as tx

_BIG_COUNT = "decimal(38,0)"


def drop_articles(text: Column) -> Column:
    return tx.strip(F.regexp_replace(F.upper(text), rules.ARTICLE_PATTERN, ""))


def regular_name(name: Column) -> Column:
    """Singular, alias and hyphenation of a whole name. No listed plural or alias is a
    wheeler truck, and none is the outcome of another, so one lookup serves for both."""
    listed = tx.literal_map({**rules.VEHICLE_PLURALS, **rules.VEHICLE_ALIASES})
    hyphenated = F.regexp_replace(name, rules.WHEELER_PATTERN, "$1-$2")
    other = F.when(F.contains(name, F.lit(rules.WHEELER_HINT)), hyphenated).otherwise(name)
    return F.coalesce(F.try_element_at(listed, name), other)


def number_digits(text: Column) -> Column:
    digits = reduce(
        lambda col, word: F.regexp_replace(col, rules.whole_word(word[0]), str(word[1])),
        rules.NUMBER_WORDS.items(),
        text,
    )
    return F.when(text.rlike(rules.NUMBER_WORD_PATTERN), digits).otherwise(text)


def split_list(text: Column) -> Column:
    """Entries of a list separated by commas and AND. Only AND is searched by pattern:
    splitting by a pattern would compile it anew for each row."""
    commas = F.regexp_replace(text, rules.AND_PATTERN, ",")
    return F.filter(F.transform(F.split(commas, ","), tx.strip), lambda p: p != "")


# From the participants as written to their entries. Every step reads its input more
# than once, so a plan gives each its own projection.
LIST_STEPS = [drop_articles, regular_name, number_digits, split_list]


def _leading_count(part: Column) -> Column:
    """The entry and its leading number, which is empty unless a name follows it."""
    return F.struct(part.alias("whole"), F.regexp_extract(part, rules.COUNTED_PATTERN, 1).alias("n"))


def _rest(p: Column) -> Column:
    """The name of an entry: what follows the number, or all of it."""
    return F.when(
        p["n"] != "", tx.strip(F.substr(p["whole"], F.length(p["n"]) + 1))
    ).otherwise(p["whole"])


def count_entries(parts: Column) -> Column:
    """Entries as array<struct<name, n>>, equal names still apart; one without a number
    counts once."""
    # Chained transforms bind each intermediate once.
    read = F.transform(parts, _leading_count)
    one = F.lit(1).cast(_BIG_COUNT)
    named = F.transform(
        read,
        lambda p: F.struct(
            _rest(p).alias("name"),
            F.when(p["n"] != "", p["n"].try_cast(_BIG_COUNT)).otherwise(one).alias("n"),
        ),
    )
    regular = F.transform(
        named, lambda p: F.struct(regular_name(p["name"]).alias("name"), p["n"].alias("n"))
    )
    return F.sort_array(regular)


def involved_text(entries: Column) -> Column:
    """``1 CAR|2 MOTORCYCLE``: counts summed per name, names ascending; ``entries`` are
    sorted, so equal names are neighbours and one fold adds them up."""
    empty = F.array().cast(f"array<struct<name:string,n:{_BIG_COUNT}>>")

    def add(done, p):
        last = F.try_element_at(done, F.lit(-1))
        total = F.try_add(last["n"], p["n"]).cast(_BIG_COUNT)
        merged = F.struct(p["name"].alias("name"), total.alias("n"))
        return F.when(
            F.coalesce(last["name"] == p["name"], F.lit(False)),
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(merged)),
        ).otherwise(F.concat(done, F.array(p)))

    lines = F.transform(
        F.reduce(entries, empty, add), lambda p: F.concat_ws(" ", p["n"].cast("string"), p["name"])
    )
    return F.array_join(lines, "|")


def involved_array(involved: Column) -> Column:
    """``1 CAR|2 VAN`` as array<struct<vehicle_type, vehicle_count>>; empty if no text."""
    parts = F.when(tx.blank_to_null(involved).isNotNull(), F.split(involved, r"\|"))
    parts = F.transform(F.coalesce(parts, F.array().cast("array<string>")), tx.strip)
    return F.transform(
        F.transform(parts, _leading_count),
        lambda p: F.struct(
            F.upper(_rest(p)).alias("vehicle_type"),
            F.when(p["n"] != "", p["n"].try_cast("int")).otherwise(F.lit(1)).alias("vehicle_count"),
        ),
    )
