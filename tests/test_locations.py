from roadlark.operators import locations
from roadlark.operators.upsert import new_locations

DIM = "location_id string, city string, location string, latitude double, longitude double, accuracy double"


def dim(spark):
    return spark.createDataFrame(
        [("1", "X", "EDSA", 1.0, 1.0, 0.5), ("2", "Y", "EDSA", 2.0, 2.0, 1.0), ("3", "Z", "C5", 3.0, 3.0, None)], DIM
    )


def events(spark, *places):
    return spark.createDataFrame([(i, p) for i, p in enumerate(places)], "n int, location string")


def test_known_locations_fan_out_or_not(spark):
    posts = events(spark, "EDSA", "C5", "", "NEW")
    rows = locations.known_locations(posts, dim(spark)).collect()
    assert sorted((r.n, r.city) for r in rows if r.city) == [(0, "X"), (0, "Y"), (1, "Z")]
    assert {r.n for r in rows if r.city is None} == {2, 3}
    single = locations.known_locations(posts, locations.one_row_per_location(dim(spark))).collect()
    assert sorted((r.n, r.city or "") for r in single) == [(0, "Y"), (1, "Z"), (2, ""), (3, "")]


def test_large_dimension_path_gives_the_same(spark):
    posts = events(spark, *(["EDSA"] * 50 + ["C5", "", None]))
    plain = locations.known_locations(posts, dim(spark))
    salted = locations.known_locations(posts, dim(spark), broadcast_bytes=0)
    key = lambda df: sorted(str(r.asDict()) for r in df.collect())
    assert key(plain) == key(salted)


def test_missing_locations_are_distinct_and_include_the_empty_one(spark):
    got = locations.missing_locations(events(spark, "EDSA", "", "", "NEW", "NEW"), dim(spark))
    assert sorted(r.location for r in got.collect()) == ["", "NEW"]


GAZ = "location string, city string, latitude double, longitude double, confidence string"


def test_gazetteer(spark):
    gaz = spark.createDataFrame(
        [("A", "Makati", 1.0, 2.0, "High"), ("B", None, 14.5001, 121.0, "Medium"), ("C", "Kalookan City", None, None, None),
         ("A", "Pasig", 1.0, 2.0, "High")], GAZ)
    points = spark.createDataFrame([("PARAÑAQUE", 14.5, 121.0)], "city string, latitude double, longitude double")
    missing = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "location string")
    got = {r.location: tuple(r)[2:] + (r.city,) for r in locations.resolve_from_gazetteer(missing, gaz, points).collect()}
    assert got == {
        "A": (1.0, 2.0, 1.0, "MAKATI CITY"), "B": (14.5001, 121.0, 0.5, "PARANAQUE"),
        "C": (0.0, 0.0, 0.0, "CALOOCAN CITY"), "D": (0.0, 0.0, 0.0, ""),
    }
    without = locations.resolve_from_gazetteer(missing, gaz).where("location = 'B'").first()
    assert without.city == ""


def test_resolver_is_asked_in_batches_by_position(spark):
    missing = spark.createDataFrame([(f"P{i}",) for i in range(200)], "location string").repartition(2)

    def resolver(names):
        assert 0 < len(names) <= 95
        known = [None if n.endswith("7") else {"city": "pasay", "latitude": 1.0, "longitude": float(n[1:]), "confidence": "Low"}
                 for n in names]
        return known[:-1] if len(names) == 95 else known

    rows = locations.resolve_with(missing, resolver).collect()
    assert len(rows) == 200 - 2  # two full batches, each answered one short
    for r in rows:
        lost = r.location.endswith("7")
        assert (r.city, r.longitude) == (("", 0.0) if lost else ("PASAY CITY", float(r.location[1:])))


def test_upsert_locations_guards_and_is_idempotent(spark):
    staging = spark.createDataFrame(
        [("X", "A", 1.0, 1.0, 0.5), ("X", "A", 1.0, 1.0, 0.2), (None, "B", 1.0, 1.0, 1.0), ("Y", "C", None, 1.0, 1.0)],
        "city string, location string, latitude double, longitude double, accuracy double",
    )
    first = new_locations(staging, dim(spark))
    (row,) = first.collect()
    assert (row.city, row.location, row.accuracy) == ("X", "A", 0.2)
    assert new_locations(staging, dim(spark).unionByName(first)).count() == 0
