"""The spelt-out Java patterns mean what Python's Unicode shorthands mean."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roadlark import rules
from roadlark.functions import text as tx

WORDS = (
    "AT ALONG ON INVOLVING STALLED NB SB SOUTHBOUND MORE OR LESS AS OF PAX DUE CAR AND A AN LANE LANES "
    "TWO TEN 1 12 8:05 8: 05 10:5 AM PM MMDA ALERT: ROAD CRASH EDSA C-5 WHEELER TRUCK 16 OFFICE ATENEO "
    "ÑAT ATÑ É ² _ _AT AT_ 中 AT中 ; . , ( ) - /"
).split(" ")
GAPS = [" ", "  ", "\n", "\t", "\xa0", " ", "　", "\x1f", "\x85", "\r", "", " ", " ", " "]


def python_form(pattern: str) -> str:
    short = pattern.replace(rules._S, r"\s").replace("(?d)", "")
    return short.replace(rules._START, r"\b").replace(rules._END, r"\b")


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(11)
    made = ["".join(rng.choice(WORDS) + rng.choice(GAPS) for _ in range(rng.randint(1, 18))) for _ in range(4000)]
    made += ["MMDA ALERT: CRASH AT X\nY NB", "AT EDSA\n", "AT EDSA \n", "INVOLVING CAR ", "INVOLVING CAR \n"]
    df = spark.createDataFrame(list(enumerate(made)), "n int, t string").repartition(8).cache()
    return made, df


@pytest.mark.parametrize(
    "name,group",
    [("TIME_PATTERN", 0), ("LANES_PATTERN", 1), ("TYPE_PATTERN", 1), ("LOCATION_PATTERN", 2),
     ("LOCATION_TAIL_PATTERN", 0), ("PARTICIPANTS_PATTERN", 1), ("RALLY_LOCATION_PATTERN", 2),
     ("RALLY_COUNT_PATTERN", 1), ("STALLED_PATTERN", 1), ("WHEELER_PATTERN", 2), ("COUNTED_PATTERN", 2)],
)
def test_first_match(texts, name, group):
    made, df = texts
    pattern = getattr(rules, name)
    got = df.select("n", F.regexp_extract("t", pattern, group)).collect()
    compiled = re.compile(python_form(pattern))
    for n, found in got:
        match = compiled.search(made[n])
        assert found == (match.group(group) if match else ""), repr(made[n])


@pytest.mark.parametrize("name", ["DIRECTION_PATTERN", "ARTICLE_PATTERN", "NUMBER_WORD_PATTERN", "AND_PATTERN", "SPACES_PATTERN"])
def test_all_matches(texts, name):
    made, df = texts
    pattern = getattr(rules, name)
    compiled = re.compile(python_form(pattern))
    for n, put in df.select("n", F.regexp_replace("t", pattern, "#")).collect():
        assert put == compiled.sub("#", made[n]), repr(made[n])


@pytest.mark.parametrize(
    "name,group",
    [("TIME_PATTERN", 0), ("LANES_PATTERN", 1), ("TYPE_PATTERN", 1), ("LOCATION_PATTERN", 2),
     ("LOCATION_TAIL_PATTERN", 0), ("PARTICIPANTS_PATTERN", 1), ("RALLY_LOCATION_PATTERN", 2),
     ("RALLY_COUNT_PATTERN", 1), ("STALLED_PATTERN", 1), ("DIRECTION_PATTERN", 1), ("SPACES_PATTERN", 0)],
)
def test_plain_form_finds_the_same_in_plain_texts(texts, name, group):
    made, df = texts
    pattern = getattr(rules, name)
    plain = df.select(F.regexp_replace("t", rules.FOREIGN_PATTERN, " ").alias("t"))
    both = [F.regexp_extract("t", p, group).alias(c) for c, p in (("a", pattern), ("b", rules.plain(pattern)))]
    found = plain.select(tx.is_plain(F.col("t")).alias("plain"), *both).collect()
    assert all(r.plain for r in found) and (any(r.a for r in found) or name.startswith("RALLY"))
    assert [r.a for r in found] == [r.b for r in found]


def test_texts_of_both_kinds_are_searched_alike(texts):
    made, df = texts
    assert {r.t for r in df.where(tx.is_plain(F.col("t"))).collect()} == {t for t in made if all(" " <= c <= "~" for c in t)}
    for name in ("LOCATION_PATTERN", "PARTICIPANTS_PATTERN"):
        pattern = getattr(rules, name)
        got = df.select(tx.first_group(F.col("t"), pattern), F.regexp_extract("t", pattern, 1)).collect()
        assert [r[0] for r in got] == [r[1] for r in got]
