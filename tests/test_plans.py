"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from checks.fixtures import Inputs
from checks.queries import QUERIES, parsed
from roadlark.operators.directions import direction_lookup
from roadlark.operators.fill import forward_fill
from roadlark.operators.upsert import absent_rows
from roadlark.plans.batch import process_batch
from roadlark.session import materialise
from roadlark.sources.tables import seed_directions, seed_vehicles

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["parse_all_fields", "fact_flow", "classify_vehicles", "extract_posts", "upsert_events"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for node in ("Python", "ArrowEval", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert node not in text, node


def test_direction_lookup_is_a_hash_join(spark):
    text = plan(direction_lookup(parsed(Inputs(spark, FOLDER)), seed_directions(spark)))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text


def test_only_selected_fields_are_searched(spark):
    text = plan(parsed(Inputs(spark, FOLDER)).select("post_seq", "direction"))
    assert text.count("regexp_extract") == 1 and "sha2" not in text


def test_forward_fill_moves_only_narrow_rows_and_no_task_sees_all(spark):
    df = materialise(spark.range(1000).select("id", F.lit("wide" * 20).alias("post"), F.lit(None).cast("string").alias("time")), "t")
    text = plan(forward_fill(df, "time", "id"))
    windows = re.findall(r"Window \[last\(([^\]]*)\], \[([^\]]*)\]", text)
    # The running fill and every level but the topmost are partitioned.
    assert len(windows) >= 3
    assert text.count("Exchange SinglePartition") == 1
    # The one unpartitioned window sees a row per 2 ** 32 positions.
    assert re.search(r"hashpartitioning\(at#", text)
    running = text.split("+- Window")[-1]
    assert "post#" not in running
    assert "PushedFilters: [IsNull(time)]" in text and "PushedFilters: [IsNotNull(time)]" in text


def test_insert_if_absent_shuffles_each_side_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = materialise(spark.range(100).selectExpr("id k", "id v"), "rows")
        have = materialise(spark.range(50).selectExpr("id k", "id v"), "have")
        text = plan(absent_rows(rows, have, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2
    assert "ReadSchema: struct<k:bigint>" in text


def test_a_batch_scans_the_raw_posts_once(spark, tmp_path):
    t = Inputs(spark, FOLDER)
    path = str(tmp_path / "posts")
    t.posts().write.parquet(path)
    batch = process_batch(spark.read.parquet(path), t.dim_locations(), seed_vehicles(spark))
    for df in (batch.events, batch.vehicles, batch.new_locations, batch.unresolved):
        assert path not in plan(df)
        assert "regexp_extract(post" not in plan(df)
