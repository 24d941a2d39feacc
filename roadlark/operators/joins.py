"""Joins that hold when one key owns a third of the rows."""

import math

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from roadlark.session import observed

BROADCAST_BYTES = 64 << 20
# A key with more than this share of the rows is split; at most 1 / share keys can be.
HOT_SHARE = 1 / 5000


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a whole table from one small aggregate: the length of every
    variable-size field as text, plus 16 bytes per field."""
    fixed = ("boolean", "byte", "tinyint", "smallint", "int", "bigint", "float", "double", "date")
    sizes = [
        F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
        for name, kind in df.dtypes
        if kind not in fixed
    ]
    per_row = sum(sizes, F.lit(16 * len(df.columns))).cast("bigint")
    row = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()
    return row["rows"], row["bytes"]


def one_row_per_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """The smallest row of each key. Copies collapse inside each map task first, so a
    key with very many copies costs one row per task."""
    rest = [c for c in rows.columns if c not in key]
    if not rest:
        return rows.distinct()
    return (
        rows.groupBy(*key)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*key, "_row.*")
        .select(*rows.columns)
    )


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    how: str = "left",
    lookup_bytes: int | None = None,
    keys_from: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Join a large table to a lookup table on one column.

    A lookup of no more than ``broadcast_bytes`` is broadcast: no shuffle of ``rows`` and
    so no skew. A larger one is joined by shuffle, with each key that has more than
    ``hot_share`` of the rows split into pieces of about that share. ``lookup_bytes`` is
    the measured size where the caller has it already, ``keys_from`` a table with the same
    keys in which to look for hot ones, where ``rows`` is costly to compute.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a lookup keeps or drops rows without a match, it is not {how!r}")
    if lookup_bytes is None:
        lookup_bytes = measure(lookup)[1]
    if lookup_bytes <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), on, how)
    hot = hot_keys(rows if keys_from is None else keys_from, on, hot_share)
    return salted_join(rows, lookup, on, how, hot, math.ceil(1 / hot_share))


def hot_keys(rows: DataFrame, key: str, hot_share: float) -> DataFrame:
    """(key, salts): the keys that each hold more than ``hot_share`` of the rows and how
    many pieces of that share they are, from one pre-aggregated count.

    There are fewer than ``1 / hot_share`` such keys and twice as many pieces, however
    large the data, so the table may be collected and broadcast.
    """
    seen = Observation()
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    top = (
        counts.observe(seen, F.sum("count").alias("total"))
        .orderBy(F.desc("count"))
        .limit(math.ceil(1 / hot_share))
        .collect()
    )
    piece = max(1, observed(seen, "total") * hot_share)
    hot = [(row[key], math.ceil(row["count"] / piece)) for row in top if row["count"] > piece]
    fields = [rows.schema[key], T.StructField("_salts", T.IntegerType())]
    return rows.sparkSession.createDataFrame(hot, T.StructType(fields)).coalesce(1)


def salted_join(
    rows: DataFrame, lookup: DataFrame, on: str, how: str, hot: DataFrame, null_salts: int
) -> DataFrame:
    """Shuffle join in which the rows of the ``hot`` keys, and of no key, are spread; of
    the lookup only the rows of hot keys are copied.

    The salt depends on the row and on its partition only: equal copies of a row spread
    too, and a partition computed again after a lost executor gets the same salts.
    """
    salts = F.when(F.col(on).isNull(), null_salts).otherwise(F.coalesce("_salts", F.lit(1)))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    spread = F.pmod(F.pmod(row_hash, salts) + F.spark_partition_id(), salts).cast("int")
    salted = rows.join(F.broadcast(hot), on, "left").withColumn("_salt", spread).drop("_salts")
    pieces = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copied = (
        lookup.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(pieces)).drop("_salts")
    )
    return salted.join(copied, [on, "_salt"], how).drop("_salt")
