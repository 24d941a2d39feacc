"""Work that is dealt to as many tasks, and as few, as the size of the input asks for."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from checks import queries
from roadlark import schemas, session
from roadlark.operators import fuzzy, vehicles
from roadlark.plans import audits, ingest, resolving
from roadlark.sources import pages as timeline, records
from roadlark.sources.batches import BatchWarehouse


@pytest.fixture
def no_coalescing(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def tasks_by_stage(spark, name, action):
    """What ``action`` returns, and the tasks of each stage it has run."""
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        made = action()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    seen = context.statusTracker()
    infos = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup(name) for s in seen.getJobInfo(j).stageIds]
    return made, [i.numTasks for i in infos if i]


def test_rounds_grow_with_what_is_asked(spark, tmp_path, monkeypatch):
    asked_for, open_batches = [], resolving.AnswerLog.open_batches
    monkeypatch.setattr(
        resolving.AnswerLog, "open_batches", lambda *a: asked_for.append(1) or open_batches(*a)
    )
    places = spark.range(40).select(F.format_string("PLACE %03d", "id").alias("location"))

    def service(asked):
        if asked == ["PLACE 007"]:
            raise TimeoutError("too busy")
        return [{"city": "Pasig", "latitude": 1.0, "longitude": 2.0} for _ in asked]

    done = resolving.resolve_in_batches(places, service, str(tmp_path / "log"), batch=1, tries=2, round_batches=1)
    assert done.found.count() == 39
    assert [tuple(r) for r in done.unresolved.collect()] == [("PLACE 007", 2)]
    # 1, 2, 4, ... 32 batches, those that failed, and a look that finds none.
    assert len(asked_for) == 8


def test_finished_tasks_of_a_broken_round_stay_in_the_log(spark, tmp_path):
    places = spark.range(40).select(F.format_string("PLACE %03d", "id").alias("location"))
    calls = tmp_path / "calls"
    calls.mkdir()

    def service(asked):
        if asked == ["PLACE 023"] and not os.path.exists(f"{calls}/gone"):
            with open(f"{calls}/gone", "x"):
                pass
            time.sleep(4)  # the other tasks end
            raise SystemExit("the worker is gone")  # not a failure that an answer records
        with open(f"{calls}/{asked[0]}-{len(os.listdir(calls))}", "x"):
            pass
        return [None for _ in asked]

    log = str(tmp_path / "log")
    with pytest.raises(Exception):
        resolving.resolve_in_batches(places, service, log, batch=1, round_batches=40)
    kept = resolving.AnswerLog(spark, log).answers().count()
    assert 0 < kept < 40
    before = len(os.listdir(calls))
    resolving.resolve_in_batches(places, service, log, batch=1, round_batches=40)
    assert len(os.listdir(calls)) - before == 40 - kept
    assert resolving.AnswerLog(spark, log).answers().count() == 40


def test_checks_of_an_audit_write_side_by_side(spark, tmp_path):
    warehouse = BatchWarehouse(spark, str(tmp_path / "star"))
    warehouse.seed()
    ddl = schemas.TABLES["fact_events"][0]
    rows = spark.range(4).select(
        *[
            {"event_id": F.lit("1"), "location_id": F.lit("nowhere"), "direction_id": F.lit("NORTH")}
            .get(name.split()[0], F.lit(None)).cast(name.split()[1]).alias(name.split()[0])
            for name in ddl.split(", ")
        ],
        F.lit(dt.date(2024, 1, 5)).alias("date"),
    )
    warehouse._write("fact_events", rows, "a", "x", "date")
    warehouse._commit("a", "x")
    audits.audit_batch(warehouse, "a")
    found = {(r.kind, r.key_value, r.found) for r in audits.merged_audit(warehouse).collect()}
    assert found == {("copies", "1", 4), ("orphan", "nowhere", 4), ("orphan", "NORTH", 4)}
    parts = [f for f in os.listdir(tmp_path / "star/_batches/a/audit") if f.startswith("part-")]
    assert len(parts) > 1


def test_raw_files_of_many_days_are_written_by_many_tasks(spark, no_coalescing):
    posts = spark.range(60).select(
        F.col("id").alias("post_seq"), F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 20).cast("int")).alias("created_at"),
        F.format_string("link %02d", "id").alias("tweetlinkid"), F.format_string("MMDA ALERT: %02d", "id").alias("content"),
    )

    class Given(queries.Inputs):
        def posts(self):
            return posts

    (_, root, _), tasks = tasks_by_stage(spark, "raw-days", lambda: queries._raw_days(Given(spark, "")))
    files = [f"{d}/{f}" for d, _, names in os.walk(root) for f in names if f.startswith("part-")]
    assert len(files) == 20 and tasks[-1] > 1
    for file in files:
        with open(file) as lines:
            written = [line.split(",")[1] for line in lines][1:]
        assert len(written) == 3 and written == sorted(written)


def test_a_large_multi_line_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = "".join(f'"MMDA ALERT: Stalled car\ndue to {i}, ""x""",link {i},2024-01-05\n' for i in range(3000))
    path = tmp_path / "2024/01"
    path.mkdir(parents=True)
    (path / "scrape_data_20240105.csv").write_text("content,tweetlinkid,created_at\n" + rows)
    read = []
    numbered_lines = records.numbered_lines
    monkeypatch.setattr(records, "numbered_lines", lambda s, p, n=None: read.append(p) or numbered_lines(s, p, 8 << 10))
    found = {}
    for name, limit in (("whole", ingest.LARGE_FILE), ("many", 1 << 10)):
        monkeypatch.setattr(ingest, "LARGE_FILE", limit)
        star = ingest.Warehouse(spark, str(tmp_path / f"star-{name}"))
        star.seed()
        batch = ingest.ingest_daily(star, str(tmp_path), str(tmp_path / f"clean-{name}"), dt.date(2024, 1, 6))
        found[name] = sorted((r.event_id, r.post, r.link) for r in batch.events.collect())
    assert len(found["whole"]) == 3000 and found["many"] == found["whole"]
    assert len(read) == 1


def test_splits_beyond_a_number_share_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "LINE_TASKS", 8)
    path = tmp_path / "many.csv"
    path.write_text("a,b,c\n" + "".join(f'x,"y\n{i}",{i}\n' for i in range(5000)))
    old = spark.conf.get(records.SPLIT_SETTING)
    found, tasks = tasks_by_stage(
        spark, "splits", lambda: records.read_records(spark, str(path), "a string, b string, c int", split_bytes=512)
    )
    assert max(tasks) <= 8 and spark.conf.get(records.SPLIT_SETTING) == old
    assert [r.c for r in found.orderBy("no").collect()] == list(range(5000))


def test_a_small_file_of_many_rows_is_parsed_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    path = str(tmp_path / "rows")
    spark.range(0, 5000, 1, 1).write.parquet(path)
    assert session.spread(spark.read.parquet(path)).rdd.getNumPartitions() == 50


def test_pairs_of_like_names_are_scored_where_they_are_found(spark):
    words = ["LARGE RING", "SMALL RING", "HOT BOLT", "OLD PLATE"]
    types = sorted(f"{w} ECONOMY BRAND#{b} {n}" for w in words for b in range(1, 9) for n in range(10, 16))
    names = sorted({t.replace("A", "O") for t in types[::5]} | {t.replace(" ", "") for t in types[::7]} | {"RING", "Q"})
    dimension = spark.createDataFrame([(t, t[:3]) for t in types], "candidate string, candidate_group string")
    asked = spark.createDataFrame([(n,) for n in names], "name string")
    found = fuzzy.best_matches(asked, dimension, vehicles.match_score).found
    score = vehicles.match_score(F.col("name"), F.col("candidate"))
    every = asked.crossJoin(dimension).select("name", F.struct((-score).alias("m"), "candidate").alias("best"))
    expected = {r.name: (r.best.candidate, -r.best.m) for r in every.groupBy("name").agg(F.min("best").alias("best")).collect()}
    assert {r.name: (r.candidate, r.score) for r in found.collect()} == expected
    # Not brought together by pair, which is a row for each piece that like names share.
    index = fuzzy._Index(dimension)
    waiting = fuzzy._ranked(asked, index.frequency).withColumn("best", F.lit(None).cast(fuzzy._BEST))
    waiting = session.materialise(waiting, "waiting")
    plan = index.near(waiting, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(name" not in plan and "Aggregate" not in plan


def test_pages_are_read_once_for_numbered_posts(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def looked_at(html):
        seen.add(1)
        return html

    item = (
        '<div class="timeline-item"><div class="tweet-content">MMDA ALERT: A &amp; B</div><span class="tweet-date">'
        '<a href="/MMDA/status/1" title="Jan 5, 2024 · 8:00 AM UTC">Jan 5</a></span></div>'
    )
    pages = spark.range(0, 60, 1, 4).select(F.col("id").alias("page_id"), F.lit(item * 2).alias("html"))
    pages = pages.withColumn("html", looked_at.asNondeterministic()("html"))
    posts = timeline.extract_posts(pages, order="page_id")
    assert sorted(r.post_seq for r in posts.collect()) == list(range(120))
    assert seen.value == 60
