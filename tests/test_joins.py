from collections import Counter

from pyspark.sql import functions as F

from roadlark.operators.joins import hot_keys, lookup_join, measure, one_row_per_key


def rows_of(df):
    return Counter(tuple(r) for r in df.select(sorted(df.columns)).collect())


def skewed(spark):
    """A third of the rows on one key, a third on none, and equal copies."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))
    )
    return spark.range(3000).select(key.alias("key"), (F.col("id") % 2).alias("x")).repartition(6)


def lookup(spark):
    rows = [("hot", "A"), ("hot", "B"), ("k2", "C"), ("k5", "D"), ("other", "E")]
    return spark.createDataFrame(rows, "key string, y string")


def test_salted_join_equals_plain_join(spark):
    big, small = skewed(spark), lookup(spark)
    for how in ("left", "inner"):
        plain = rows_of(big.join(small, "key", how))
        salted = lookup_join(big, small, "key", how, broadcast_bytes=0, hot_share=0.05)
        assert rows_of(salted) == plain
        assert rows_of(lookup_join(big, small, "key", how)) == plain


def test_salted_join_spreads_the_hot_key_and_the_null_key(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(skewed(spark), lookup(spark), "key", broadcast_bytes=0, hot_share=0.05)
        per_task = joined.withColumn("task", F.spark_partition_id()).groupBy("key", "task").count()
        tasks = Counter(r["key"] for r in per_task.collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert tasks["hot"] > 1 and tasks[None] > 1


def test_small_lookup_is_broadcast_and_large_is_not(spark):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(lookup_join(skewed(spark), lookup(spark), "key"))
    assert measure(lookup(spark))[0] == 5


def test_hot_keys_get_pieces_by_their_share(spark):
    assert [tuple(r) for r in hot_keys(skewed(spark), "key", 0.25).collect()] == [("hot", 2)]
    assert dict(map(tuple, hot_keys(skewed(spark), "key", 0.01).collect())) == {"hot": 50}
    assert hot_keys(skewed(spark).limit(0), "key", 0.25).count() == 0


def test_one_row_per_key_takes_the_smallest(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 0)], "k int, s string, n int")
    assert rows_of(one_row_per_key(df, ["k"])) == Counter({(1, 5, None): 1, (2, 0, "z"): 1})
