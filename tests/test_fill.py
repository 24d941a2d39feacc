import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from roadlark.operators.fill import fill_event_time, forward_fill


def brute(rows):
    last, out = {}, {}
    for seq, group, value in sorted(rows):
        last[group] = value if value is not None else last.get(group)
        out[seq] = last[group]
    return out


@pytest.mark.parametrize("bits,width", [(2, 4), (2, 12), (3, 6), (16, 48)])
@pytest.mark.parametrize("known", [0.02, 0.5])
def test_forward_fill_over_many_levels(spark, bits, width, known):
    rng = random.Random(bits * 100 + width)
    rows = [
        (seq, rng.choice(["a", "b", None]), f"v{seq}" if rng.random() < known else None)
        for seq in rng.sample(range(4000), 700)
    ]
    df = spark.createDataFrame(rows, "seq long, g string, v string").repartition(5)
    alone = forward_fill(df, "v", "seq", block_bits=bits, order_bits=width)
    assert {r.seq: r.v for r in alone.collect()} == brute([(s, 0, v) for s, _, v in rows])
    grouped = forward_fill(df, "v", "seq", ("g",), block_bits=bits, order_bits=width)
    assert {r.seq: r.v for r in grouped.collect()} == brute(rows)
    assert grouped.columns == df.columns


def test_result_does_not_depend_on_partitions(spark):
    rows = [(i, f"{i:05d}" if i % 11 == 5 else None) for i in range(500)]
    results = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "seq long, v string").repartition(parts)
        results.append(sorted(map(tuple, forward_fill(df, "v", "seq", block_bits=4).collect())))
    assert results[0] == results[1]
    assert results[0][:6] == [(0, None), (1, None), (2, None), (3, None), (4, None), (5, "00005")]


def test_null_groups_fill_each_other_and_running_rows_move_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(None, 0, "a"), (None, 2**61, None), ("g", 1, None), ("g", 2, "b"), ("g", 2**62, None)]
        df = spark.createDataFrame(rows, "g string, n bigint, v string")
        filled = forward_fill(df, "v", "n", ("g",))
        got = {(r.g, r.n): r.v for r in filled.collect()}
        text = filled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(None, 0): "a", (None, 2**61): "a", ("g", 1): None, ("g", 2): "b", ("g", 2**62): "b"}
    assert "coalesce(_group" not in text


def test_fill_event_time_rebuilds_the_timestamp(spark):
    day = dt.date(2025, 1, 2)
    df = spark.createDataFrame(
        [(1, day, None), (2, day, "08:05"), (3, day, None), (4, None, None)], "seq long, date date, time string"
    ).withColumn("event_timestamp", F.lit(None).cast("timestamp_ntz"))
    rows = fill_event_time(df, "seq").orderBy("seq").collect()
    at = dt.datetime(2025, 1, 2, 8, 5)
    assert [(r.time, r.event_timestamp) for r in rows] == [
        (None, None), ("08:05", at), ("08:05", at), ("08:05", None)
    ]
