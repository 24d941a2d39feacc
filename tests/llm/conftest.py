import datetime as dt

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, node string, _row date"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, other columns with
    names that operators use."""
    day = dt.date(2024, 1, 1)
    long_text = "the quick brown fox jumps over the lazy dog. " * 4000
    rows = [
        (1, "Some plain words, all rights reserved.", "en", "a", 1, 1, "n", day),
        (1, "Some plain words, all rights reserved.", "en", "a", 1, 1, "n", day),
        (2, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 1, "n", day),
        (4, " \t\n ", "de", "b", 0, 1, "n", day),
        (5, long_text, "en", "b", 1, 1, "n", day),
        (6, "x" * 70_000, "en", "b", 1, 1, "n", day),
        (None, "A row without an id, but with words.", "en", None, 1, 1, "n", day),
        (7, "1234 %%% !!!", "de", "a", 1, 1, "n", day),
        (8, "Ñandú ☃ 中文 text é", None, "Z", 1, 1, "n", day),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark, odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
