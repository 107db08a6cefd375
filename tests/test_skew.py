"""The split join against Spark's plain join, with keys that hold a third of the rows on one or both sides."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators.skew import fits_broadcast, hot_hashes, hot_keys, skew_join
from tests.conftest import rows


def sides(spark, seed, n_left=400, n_right=90):
    """Hot key on the left, another on the right, one on both, one hot on the left without partner, NULLs, copies."""
    rng = random.Random(seed)
    keys = ["both"] * 3 + ["left"] * 3 + ["alone"] * 2 + [None] * 2 + ["right"] + [f"k{i}" for i in range(20)]
    left = [(rng.choice(keys), rng.choice(["x", "y", None]), rng.randrange(5)) for _ in range(n_left)]
    keys = ["both"] * 8 + ["right"] * 8 + [None] * 2 + ["left"] + [f"k{i}" for i in range(5, 25)]
    right = [(rng.choice(keys), rng.choice(["x", "y", None]), rng.randrange(4)) for _ in range(n_right)]
    return (
        spark.createDataFrame(left, "a string, b string, v int").repartition(3),
        spark.createDataFrame(right, "c string, d string, w int").repartition(2),
    )


def plain(left, right, how):
    joined = left.join(right, (left.a == right.c) & (left.b == right.d), how)
    return joined if how == "left_anti" else joined.drop("c", "d")


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_split_join_equals_plain_join(spark, shuffled_joins, how, seed):
    left, right = sides(spark, seed)
    found = skew_join(left, right, [("a", "c"), ("b", "d")], how, hot_rows=7)
    assert rows(found) == rows(plain(left, right, how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_unique_right_side(spark, shuffled_joins, how):
    left, right = sides(spark, 3)
    right = right.groupBy("c", "d").agg(F.max("w").alias("w"))
    found = skew_join(left, right, [("a", "c"), ("b", "d")], how, right_unique=True, hot_rows=7)
    assert rows(found) == rows(plain(left, right, how))


def test_piece_without_rows_is_not_a_missing_match(spark, shuffled_joins):
    """All right rows are copies in one partition, so they share a piece and the other pieces stay empty."""
    left = spark.createDataFrame([("k", 1), ("z", 2), (None, 3)], "a string, v int")
    right = spark.createDataFrame([("k", 1)] * 10, "c string, w int").coalesce(1)
    found = skew_join(left, right, [("a", "c")], "left", hot_rows=3)
    assert rows(found) == [(None, 3, None)] + [("k", 1, 1)] * 10 + [("z", 2, None)]


def test_same_key_names_and_self_join(spark, shuffled_joins):
    left, _ = sides(spark, 4)
    right = left.select("a", "b").distinct().withColumn("z", F.lit(1))
    found = skew_join(left, right, [("a", "a"), ("b", "b")], "left", hot_rows=7)
    assert found.columns == ["a", "b", "v", "z"]
    assert rows(found) == rows(left.join(right, ["a", "b"], "left"))


def test_nothing_hot(spark, shuffled_joins):
    left, right = sides(spark, 5)
    found = skew_join(left, right, [("a", "c"), ("b", "d")], "left")
    assert rows(found) == rows(plain(left, right, "left"))


def test_hot_lists(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [("c",)] + [(None,)] * 9, "k string").repartition(3)
    assert hot_keys(df, ["k"], 2) == [("a", 3), ("b", 2)]
    hashes = {r.k: r.h for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    assert sorted(hot_hashes(df, ["k"], 2)) == sorted([(hashes["a"], 3), (hashes["b"], 2)])
    assert hot_hashes(df.limit(0), ["k"], 2) == hot_keys(df.limit(0), ["k"], 2) == []


@pytest.mark.parametrize("key", ["hot", None])
@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_hot_key_is_spread_over_tasks(spark, shuffled_joins, key, how):
    """A key with all rows, every row an exact copy of the others, ends up in several tasks; so do NULL keys."""
    left = spark.range(0, 4000, 1, 8).select(F.lit(key).cast("string").alias("a"), F.lit(1).alias("v"))
    right = spark.createDataFrame([("hot" if how == "left" else "cold", 1)], "c string, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew_join(left, right, [("a", "c")], how, right_unique=True, hot_rows=100)
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(parts) > 1 and sum(p["count"] for p in parts) == 4000


def test_without_hot_keys_one_shuffle_per_side(spark, shuffled_joins):
    left, right = sides(spark, 6)
    plan = skew_join(left, right, [("a", "c"), ("b", "d")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Generate" not in plan


def test_broadcast_only_below_the_limit(spark, tmp_path):
    df = spark.range(100_000).withColumn("v", F.rand(1))
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert fits_broadcast(stored)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in ("1000", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert not fits_broadcast(stored)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_unsupported_join(spark):
    with pytest.raises(ValueError):
        skew_join(spark.range(1), spark.range(1), [("id", "id")], "full")
