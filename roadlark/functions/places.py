"""Columns that tidy what a place resolver returns."""

from functools import reduce

from pyspark.sql import Column, functions as F

from roadlark import rules
from roadlark.functions import text as tx


def city_name(city: Column) -> Column:
    """Regular upper-case city name. Spellings compare case-insensitively, because a
    reverse lookup answers in upper case."""
    upper = F.upper(F.coalesce(city, F.lit("")))
    named = F.when(
        upper.isin([c.upper() for c in rules.CITY_SUFFIXED]),
        F.concat(upper, F.lit(rules.CITY_SUFFIX.upper())),
    ).otherwise(upper)
    respelled = tx.lookup_or_self(
        named, {k.upper(): v.upper() for k, v in rules.CITY_RESPELLED.items()}
    )
    return reduce(
        lambda col, p: F.when(col.rlike(f"(?d)^{p[0].upper()}\\z"), p[1].upper()).otherwise(col),
        rules.CITY_PATTERNS.items(),
        respelled,
    )


def accuracy_score(confidence: Column) -> Column:
    known = F.try_element_at(tx.literal_map(rules.CONFIDENCE_SCORES), confidence)
    return F.coalesce(known, F.lit(0.0))
