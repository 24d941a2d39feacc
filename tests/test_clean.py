"""Clean folders under repeated micro-batches and compactions that break off."""

import datetime as dt

import pytest

from roadlark.plans.batch import process_batch
from roadlark.sources import tables
from roadlark.sources.tables import seed_vehicles
from roadlark.session import empty_table
from roadlark import schemas
from roadlark.streaming import clean

POST = "MMDA ALERT: Vehicular accident at EDSA Ortigas NB involving car and van as of 7:30 AM. 1 lane occupied. #mmda"


@pytest.fixture
def batch(spark):
    def made(*days):
        rows = [(i, POST.replace("7:30", f"7:{10 + i}"), f"l{i}", d) for i, d in enumerate(days)]
        posts = spark.createDataFrame(rows, "post_seq long, content string, tweetlinkid string, created_at date")
        places = empty_table(spark, schemas.TABLES["dim_locations"][0])
        return process_batch(posts, places, seed_vehicles(spark))

    return made


def counts(spark, root):
    return [clean.read_clean(spark, root, "q", t).count() for t in clean.TABLES]


def test_a_repeated_batch_and_a_broken_compaction_leave_each_row_once(spark, tmp_path, batch, monkeypatch):
    root, (a, b) = str(tmp_path), (dt.date(2024, 1, 5), dt.date(2024, 1, 6))
    clean.write_pending(batch(a, a, None), root, "q", 0)
    clean.write_pending(batch(a, a, None), root, "q", 0)
    assert counts(spark, root) == [3, 6]
    assert clean.compact(spark, root, "q") == [a, None]
    assert counts(spark, root) == [3, 6] and clean.compact(spark, root, "q") == []
    # The compacted batch is run again, and with it comes another one.
    clean.write_pending(batch(a, a, None), root, "q", 0)
    clean.write_pending(batch(a, b), root, "q", 1)
    assert counts(spark, root) == [5, 10]
    write, done = tables.write_by_date, []

    def dies(*args, **options):
        if done:
            raise RuntimeError("died")
        done.append(write(*args, **options))

    monkeypatch.setattr(clean, "write_by_date", dies)
    with pytest.raises(RuntimeError):
        clean.compact(spark, root, "q")
    assert counts(spark, root) == [5, 10]
    monkeypatch.setattr(clean, "write_by_date", write)
    assert clean.compact(spark, root, "q") == [a, b, None]
    assert counts(spark, root) == [5, 10]
    events = tables.read_by_date(spark, f"{root}/events", clean.TABLES["events"], a, b)
    assert events.count() == 4


def test_a_batch_written_in_part_does_not_count(spark, tmp_path, batch):
    root = str(tmp_path)
    batch(dt.date(2024, 1, 5)).events.write.parquet(f"{clean.pending_path(root, 'q', 0)}/events")
    assert counts(spark, root) == [0, 0] and clean.compact(spark, root, "q") == []
    clean.write_pending(batch(dt.date(2024, 1, 5)), root, "other", 0)
    assert counts(spark, root) == [0, 0]
    with pytest.raises(ValueError):
        clean.pending_path(root, "a/b")
