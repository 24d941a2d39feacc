"""The resolver's log: what is asked, what is kept, what is asked again."""

import os

import pytest
from pyspark.sql import functions as F

from roadlark.operators.numbering import numbered
from roadlark.plans.resolving import resolve_in_batches


@pytest.fixture
def missing(spark):
    names = [f"PLACE {i:03d}" for i in range(50)]
    return spark.createDataFrame([(n,) for n in [*names, *names, None]], "location string")


def service(folder, fails=lambda asked, calls: False, short=0):
    """Answers odd places; each call leaves a file, from which later calls count."""

    def asked_for(asked):
        calls = len([f for f in os.listdir(folder) if f.startswith(asked[0])])
        with open(f"{folder}/{asked[0]}-{calls}", "x"):
            pass
        if fails(asked, calls):
            raise ConnectionError("gone")
        hits = [{"city": "Pasig", "latitude": 1, "longitude": "2.5"} if int(p[-1]) % 2 else None for p in asked]
        return hits[: len(hits) - short]

    return asked_for


def names(df, column="location"):
    return sorted(r[column] for r in df.collect())


def test_each_batch_is_called_once_and_a_second_run_asks_nothing(spark, tmp_path, missing):
    calls, log = tmp_path / "calls", str(tmp_path / "log")
    calls.mkdir()
    done = resolve_in_batches(missing, service(calls), log, batch=10, round_batches=2)
    assert len(os.listdir(calls)) == 5
    assert len(names(done.found)) == 25 and {r.city for r in done.found.collect()} == {"PASIG CITY"}
    assert names(done.found) + names(done.unresolved) != [] and len({*names(done.found), *names(done.unresolved)}) == 50
    again = resolve_in_batches(missing, service(calls), log, batch=10)
    assert len(os.listdir(calls)) == 5 and names(again.found) == names(done.found)


def test_failed_batches_are_asked_again_a_few_times(spark, tmp_path, missing):
    calls, log = tmp_path / "calls", str(tmp_path / "log")
    calls.mkdir()
    fails = lambda asked, calls: asked[0] == "PLACE 010" or (asked[0] == "PLACE 020" and calls == 0)
    done = resolve_in_batches(missing, service(calls, fails), log, batch=10, tries=3)
    count = lambda name: len([f for f in os.listdir(calls) if f.startswith(name)])
    assert [count(f"PLACE 0{i}0") for i in range(5)] == [1, 3, 2, 1, 1]
    attempts = {r.location: r.attempts for r in done.unresolved.collect()}
    assert attempts["PLACE 012"] == 3 and attempts["PLACE 011"] == 3 and attempts["PLACE 022"] == 2
    assert "PLACE 021" in names(done.found)
    errors = done.answers.where("error is not null").select("batch", "error").distinct().collect()
    assert sorted(r.batch for r in errors) == [1, 2] and errors[0].error == "ConnectionError: gone"


def test_short_answers_leave_the_rest_unresolved(spark, tmp_path, missing):
    calls = tmp_path / "calls"
    calls.mkdir()
    done = resolve_in_batches(missing, service(calls, short=3), str(tmp_path / "log"), batch=10)
    assert len(os.listdir(calls)) == 5
    unanswered = names(done.answers.where("not answered"))
    assert len(unanswered) == 15 and set(unanswered) <= set(names(done.unresolved))


def test_nothing_to_ask(spark, tmp_path, missing):
    done = resolve_in_batches(missing.limit(0), service(tmp_path), str(tmp_path / "log"))
    assert done.found.count() == 0 == done.unresolved.count()


def test_numbers_follow_the_order_over_many_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(6)
    found = {r.x: r.n for r in numbered(rows, [F.col("x")], "n").collect()}
    assert found == {x: x for x in range(5000)}
    assert numbered(rows.limit(0), [F.col("x")], "n").count() == 0
