"""Small text helpers shared by the field extractors."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

from roadlark import rules


def strip(text: Column) -> Column:
    """Trim every kind of white space (``F.trim`` only knows the blank)."""
    return F.btrim(text, F.lit(rules.WHITE_SPACE))


def clean_text(text: Column) -> Column:
    return strip(F.coalesce(text.cast("string"), F.lit("")))


def is_plain(text: Column) -> Column:
    """Whether a text may be searched by ``rules.plain`` forms of the patterns."""
    return ~F.rlike(text, F.lit(rules.FOREIGN_PATTERN))


def _by_plain(text: Column, plain: Column | None, search: Callable[[str], Column], pattern: str) -> Column:
    plain = is_plain(text) if plain is None else plain
    return F.when(plain, search(rules.plain(pattern))).otherwise(search(pattern))


def first_group(text: Column, pattern: str, group: int = 1, plain: Column | None = None) -> Column:
    """Group of the first match; ``''`` where the pattern does not occur. ``plain`` tells
    whether the text is, where that is a column already."""
    return _by_plain(text, plain, lambda p: F.regexp_extract(text, p, group), pattern)


def all_groups(text: Column, pattern: str, plain: Column | None = None) -> Column:
    """First group of every match."""
    return _by_plain(text, plain, lambda p: F.regexp_extract_all(text, F.lit(p), F.lit(1)), pattern)


def replaced(text: Column, pattern: str, by: str, plain: Column | None = None) -> Column:
    return _by_plain(text, plain, lambda p: F.regexp_replace(text, p, by), pattern)


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def whole_number(digits: Column, kind: str = "int") -> Column:
    """Number of a text of digits; null if empty or beyond the type's range.

    A failing ``try_cast`` raises and catches an exception inside, which costs more than
    all searches in a post, so the usual failure is ruled out first.
    """
    return F.when(digits != "", digits.try_cast(kind))


def literal_map(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def lookup_or_self(text: Column, entries: dict) -> Column:
    return F.coalesce(F.try_element_at(literal_map(entries), text), text)


def strip_direction(text: Column, plain: Column | None = None) -> Column:
    plain = is_plain(text) if plain is None else plain
    spaced = replaced(text, rules.DIRECTION_PATTERN, " ", plain)
    return strip(replaced(spaced, rules.SPACES_PATTERN, " ", plain))


def respell_place(text: Column, place_rules=rules.LOCATION_RULES) -> Column:
    """Run the ordered literal spelling rules."""
    return reduce(
        lambda col, rule: F.replace(col, F.lit(rule[0]), F.lit(rule[1])), place_rules, text
    )


def normal_key(text: Column) -> Column:
    return F.upper(F.trim(text))
