import random

from pyspark.sql import functions as F

from roadlark.operators import fuzzy, vehicles
from roadlark.sources.tables import seed_vehicles


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def best(name, types):
    def score(c):
        s = 1 - levenshtein(name, c) / max(len(name), len(c), 1)
        return s + (0.15 if name in c or c in name else 0.0)

    return min(types, key=lambda c: (-round(score(c), 12), c))


def test_suggestions_match_brute_force_in_one_block_and_in_many(spark, monkeypatch):
    rng = random.Random(5)
    types = [r.vehicle_type for r in seed_vehicles(spark).collect()]
    names = {"".join(rng.choices("ABCTRUKVN -1", k=rng.randint(1, 12))) for _ in range(120)} - set(types)
    unknown = spark.createDataFrame([(n,) for n in sorted(names)], "vehicle_type string")
    verified = vehicles.verified_types(seed_vehicles(spark))
    expected = {n: best(n, types) for n in names}
    for size in (2048, 5):
        monkeypatch.setattr(vehicles, "BLOCK_CANDIDATES", size)
        got = vehicles.suggest_types(unknown, verified).collect()
        assert {r.vehicle_type: r.suggested_from for r in got} == expected
        groups = dict(verified.collect())
        assert all(r.vehicle_group == groups[r.suggested_from] for r in got)


def listed(spark, *rows):
    return spark.createDataFrame(list(rows), "event_id string, vehicle_type string, vehicle_count int")


def test_classify(spark):
    rows = listed(spark, ("e1", "car", 1), ("e1", " VAN ", 2), ("e2", "JEEPNEY", 1), ("e3", "250", 1))
    got = {r.vehicle_type: r for r in vehicles.classify_vehicles(rows, seed_vehicles(spark)).collect()}
    assert (got["CAR"].vehicle_group, got["CAR"].suggested_from, got["CAR"].is_verified) == ("PRIVATE", "NONE", True)
    assert got["VAN"].vehicle_count == 2
    assert (got["JEEPNEY"].suggested_from, got["JEEPNEY"].is_verified) == ("MODERN JEEPNEY", False)
    assert got["JEEPNEY"].vehicle_group == "PUBLIC"
    assert got["250"].suggested_from is not None


def test_classify_without_verified_types_or_above_the_minimum_score(spark):
    rows = listed(spark, ("e1", "CAR", 1))
    (row,) = vehicles.classify_vehicles(rows, seed_vehicles(spark).where("false")).collect()
    assert (row.vehicle_group, row.suggested_from, row.is_verified) == ("UNKNOWN", None, False)
    strange = listed(spark, ("e1", "QQQQ", 1))
    (row,) = vehicles.classify_vehicles(strange, seed_vehicles(spark), min_score=0.9).collect()
    assert (row.vehicle_group, row.suggested_from) == ("UNKNOWN", None)


def test_doubled_dimension_rows_do_not_double_vehicles(spark):
    dim = seed_vehicles(spark).unionByName(
        seed_vehicles(spark).withColumn("vehicle_type", F.lower("vehicle_type"))
    )
    assert vehicles.classify_vehicles(listed(spark, ("e", "CAR", 1)), dim).count() == 1


def test_explode(spark):
    events = spark.createDataFrame(
        [("a", "1 CAR|2 VAN"), ("b", None), ("c", ""), ("d", "bus | 3 x y"), ("e", "1 250"), ("f", "CAR||9999999999 B")],
        "event_id string, involved string",
    )
    got = sorted(tuple(r) for r in vehicles.explode_vehicles(events).collect() if r.event_id != "f")
    assert got == [("a", "CAR", 1), ("a", "VAN", 2), ("d", "BUS", 1), ("d", "X Y", 3), ("e", "250", 1)]
    odd = {r.vehicle_type: r.vehicle_count for r in vehicles.explode_vehicles(events).where("event_id = 'f'").collect()}
    assert odd == {"CAR": 1, "": 1, "B": None}
    assert vehicles.explode_vehicles(events, drop_numeric=True).where("vehicle_type = '250'").count() == 0


def test_index_finds_the_best_with_few_comparisons(spark):
    rng = random.Random(9)
    words = ["TRUCK", "VAN", "JEEPNEY", "TRAILER", "BUS", "MIXER", "CLOSED", "SIX", "WHEELER", "DELIVERY", "FIRE", "TANKER"]
    types = sorted({" ".join(rng.sample(words, 3)) + f" {rng.randint(1, 99)}" for _ in range(300)})
    names = {"", "A", "VAN", "QQ", "ZZZZZZZZZZ"}
    for t in rng.sample(types, 60):
        at = rng.randrange(len(t))
        names |= {t[:at] + t[at + 1 :], t[:at] + "X" + t[at:], t + " OLD"}
    asked = spark.createDataFrame([(n,) for n in [*sorted(names), None]], "name string")
    dimension = spark.createDataFrame([(t, t[:3]) for t in types], "candidate string, candidate_group string")
    matches = fuzzy.best_matches(asked, dimension, vehicles.match_score)
    found = {r.name: (r.candidate, r.candidate_group) for r in matches.found.collect()}
    expected = {n: best(n, types) for n in names} | {None: types[0]}
    assert found == {n: (t, t[:3]) for n, t in expected.items()}
    assert matches.compared < 0.2 * len(names) * len(types)
    assert fuzzy.best_matches(asked, dimension.limit(0), vehicles.match_score).found.where("name is not null").count() == 0
