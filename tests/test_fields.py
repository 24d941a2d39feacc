import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from roadlark.functions import fields, keys, places, text as tx
from roadlark.operators.parse import parse_posts


def parsed_one(spark, *contents, day=dt.date(2025, 1, 2)):
    rows = [(i, c, "https://a/B ", day) for i, c in enumerate(contents)]
    posts = spark.createDataFrame(rows, "n int, content string, tweetlinkid string, created_at date")
    return [r.asDict() for r in parse_posts(posts, carry=("n",)).orderBy("n").collect()]


def column(spark, make, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, v {kind}")
    return [r[0] for r in df.orderBy("n").select(make(F.col("v"))).collect()]


TIMES = {
    "8:05 AM": "08:05", "8: 05 AM": "08:05", "8;05 PM": "20:05", "8 PM": "20:00", "8:05AM": "08:05",
    "12:00 AM": "00:00", "12:30 PM": "12:30", "8:05 A.M.": "08:05",
    "8.30 AM": None, "NOON": None, "14:00": None, "13:00 PM THEN 8:00 AM": None, "8:75 AM": None,
    "0:10 AM": None, "10:5 AM": "05:00", "108 AM": None, "8:05 AMX": None, "8:05 pm": "20:05",
    "AS OF 8:05 AM AND 9:10 PM": "08:05",
}


def test_time(spark):
    got = [r["time"] for r in parsed_one(spark, *TIMES)]
    assert dict(zip(TIMES, got)) == TIMES


LANES = {
    "1 LANE": 1, "TWO LANES": 2, "12 lanes": 12, "ONE (1) LANE": None, "NO LANES": None, "TEN LANE": 10,
    "LANE": None, "99999999999 LANES": None, "BONE LANE": None, "3 LANESX THEN 4 LANES": 4,
}


def test_lanes(spark):
    got = [r["lanes_blocked"] for r in parsed_one(spark, *LANES)]
    assert dict(zip(LANES, got)) == LANES


def test_type(spark):
    cases = {
        "MMDA ALERT: Road Crash Incident at EDSA": "ROAD CRASH INCIDENT",
        "MMDA ALERT:Stalled bus along C5": "STALLED BUS",
        "nothing here": "",
        "MMDA ALERT: X ONE ON Y": "X ONE",
        "MMDA ALERT: broken\nline AT X": "",
    }
    assert [r["type"] for r in parsed_one(spark, *cases)] == list(cases.values())


def test_direction_is_the_last_token(spark):
    cases = {"EDSA NB THEN SOUTHBOUND": "SOUTHBOUND", "NBX": None, "": None, "(WB)": "WB", "ÑNB": None}
    assert [r["direction"] for r in parsed_one(spark, *cases)] == list(cases.values())


LOCATIONS = {
    "AT EDSA ORTIGAS NB INVOLVING CAR AS OF 8 AM": "EDSA ORTIGAS",
    "CRASH AT EDSA": "",
    "AT EDSA COR TIMOG AVE AS OF 8 AM": "EDSA TIMOG AVE",
    "AT EDSA INTRAMUROS NB": "EDSA RAMUROS",
    "AT ROXAS BLVD KALAW SB": "ROXAS BLVD KALAW",
    "AT ROXAS BOULEVARD KALAW SB": "ROXAS BLVD KALAW",
    "ALONG C-5 F/O AS OF": "C-5 FLYOVER",
    "AT EDSA C-5 RAMP AS OF": "EDSA C5 RAMP",
    "AT PARAÑAQUE, SUCAT AS OF": "PARANAQUE SUCAT",
    "AT ENTIRE ROAD EB": "ENROAD",
    "AT A AT B WB": "AB",
    "ON  EDSA \t NB  SHAW  AS OF": "EDSA",
    "AT EDSA U-TURN SLOT KALAW MORE OR": "EDSA UTS KALAW",
    "AT X SERVICE ROAD Y STALLED": "X Y",
    "RALLY AT MENDIOLA SB MORE OR LESS 50 PAX": "MENDIOLA",
    "RALLY AT MENDIOLA AS OF 8 AM": "",
}


def test_location(spark):
    got = [r["location"] for r in parsed_one(spark, *LOCATIONS)]
    assert dict(zip(LOCATIONS, got)) == LOCATIONS


INVOLVED = {
    "CRASH INVOLVING CAR, VAN AND 2 MOTORCYCLES AS OF": "1 CAR|2 MOTORCYCLE|1 VAN",
    "INVOLVING A CAR, VAN, AND TWO MOTORCYCLES AS OF": "1 CAR|2 MOTORCYCLE|1 VAN",
    "INVOLVING VAN AND CAR AS OF": "1 CAR|1 VAN",
    "INVOLVING CAR AND CARS AS OF": "2 CAR",
    "INVOLVING 16 WHEELER TRUCK AS OF": "1 16-WHEELER TRUCK",
    "INVOLVING 16 WHEELER TRUCKS AS OF": "1 16-WHEELER TRUCKS",
    "INVOLVING 2 10 WHEELER TRUCK AS OF": "2 10-WHEELER TRUCK",
    "INVOLVING TEN WHEELER TRUCK AS OF": "10 WHEELER TRUCK",
    "INVOLVING PICK UP AS OF": "1 PICK-UP",
    "INVOLVING A AS OF": "",
    "INVOLVING 02 CARS AND 3 CARS, AS OF": "5 CAR",
    "INVOLVING 9171234567 CARS AS OF": "9171234567 CAR",
    f"INVOLVING {'9' * 38} CARS AND {'9' * 38} CARS AS OF": "CAR",
    "INVOLVING PICKUP, PICK UPS AND 3 PICK- UP AS OF": "1 PICK UPS|4 PICK-UP",
    "INVOLVING CAR AT THE END": None,
    "INVOLVING CAR OFFICE": "1 CAR",
    "RALLY MORE OR LESS 0250 PAX": "1 250",
    "RALLY WITH NO COUNT INVOLVING CAR AS OF": None,
    "STALLED A BUS DUE TO RAIN": "1 BUS",
    "STALLED BUS": None,
    "NATURALLY INVOLVING CAR AS OF": None,
    "INVOLVING ANDROID AND SANDY VAN AS OF": "1 ANDROID|1 SANDY VAN",
    "INVOLVING A.B. TRUCKS, AN AMBULANCE AS OF": "1 .B. TRUCKS|1 AMBULANCE",
}


def test_involved(spark):
    got = [r["involved"] for r in parsed_one(spark, *INVOLVED)]
    assert dict(zip(INVOLVED, got)) == INVOLVED


def test_post_link_and_null_content(spark):
    plain, empty = parsed_one(spark, "  stalled Bus \x1f", None)
    assert (plain["post"], plain["link"]) == ("STALLED BUS", "https://a/B")
    assert (empty["post"], empty["location"], empty["type"], empty["time"]) == ("", "", "", None)
    assert empty["event_timestamp"] is None


def test_event_id_and_timestamp(spark):
    import hashlib

    (row,) = parsed_one(spark, "MMDA ALERT: Bus at EDSA NB as of 8:05 PM")
    text = "2025-01-02" + "20:05" + "EDSA" + "MMDA ALERT: BUS AT EDSA NB AS OF 8:05 PM"
    assert row["event_id"] == hashlib.sha256(text.encode()).hexdigest().upper()
    assert row["event_timestamp"] == dt.datetime(2025, 1, 2, 20, 5)


def test_keys(spark):
    import hashlib

    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    row = spark.range(1).select(
        keys.location_id(F.lit("PASIG"), F.lit(None)), keys.event_vehicle_id(F.lit("E"), F.lit("CAR"))
    ).first()
    assert tuple(row) == (sha("PASIG"), sha("E|CAR"))


def test_dates(spark):
    day = dt.date(2025, 1, 2)
    cases = {
        "2025-01-02": day, "2025-1-2 3:04:05": day, "1/2/2025": day, " 01/02/2025  13:00:00 ": day,
        "x": None, "2025-13-02": None, "2025-02-30": None, "1/2/25": None, "2025-01-02 25:00:00": None,
        "": None,
    }
    make = lambda c: fields.post_date(c, T.StringType())
    assert column(spark, make, list(cases)) == list(cases.values())
    stamp = spark.createDataFrame([(dt.datetime(2025, 1, 2, 3, 4),)], "v timestamp_ntz")
    assert stamp.select(fields.post_date(F.col("v"), T.TimestampNTZType())).first()[0] == day
    assert spark.range(1).select(fields.post_date(F.col("id"), T.LongType())).first()[0] is None


def test_event_type(spark):
    cases = {
        "STALLED BUS": "STALLED VEHICLE", "ROAD CRASH": "ROAD CRASH", "VEHICULAR COLLISION": "ACCIDENT",
        "MULTIPLE COLLISION": "MULTIPLE COLLISION", "RALLY X": "RALLY", "": "OTHERS", None: "OTHERS",
    }
    assert column(spark, fields.event_type, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    "raw,city",
    [("Makati", "MAKATI CITY"), ("PASIG", "PASIG CITY"), ("Kalookan City", "CALOOCAN CITY"),
     ("Parañaque", "PARANAQUE"), ("Paranaque City", "PARANAQUE CITY"), ("Manila", "MANILA"), (None, "")],
)
def test_city(spark, raw, city):
    assert column(spark, places.city_name, [raw]) == [city]


def test_accuracy(spark):
    assert column(spark, places.accuracy_score, ["High", "Medium", "Low", "x", None]) == [1.0, 0.5, 0, 0, 0]


def test_strip_knows_all_white_space(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0     　"
    assert column(spark, tx.strip, [f"{spaces}a b{spaces}"]) == ["a b"]


def test_plurals_and_aliases_are_apart_so_that_one_lookup_serves_for_both():
    from roadlark import rules

    plurals, aliases = rules.VEHICLE_PLURALS, rules.VEHICLE_ALIASES
    assert not set(plurals) & set(aliases) and not set(plurals.values()) & set(aliases)
    assert not any(rules.WHEELER_HINT in name for name in (*plurals, *aliases))
