"""Hot keys: same results, and no task that gets a whole hot key."""

import pytest
from pyspark.sql import functions as F

from lorebase.operators.ask import multi_turn_context
from lorebase.operators.skew import hot_keys, lookup_join, running_number


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows have key 0; every key above 0 has few."""
    return spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 997).alias("key"), "id", (F.col("id") * 7919 % 1000).alias("v")
    )


def test_lookup_join_is_the_join(spark, skewed):
    lookup = spark.range(500).select(F.col("id").alias("key"), (F.col("id") * 10).alias("x"))
    got = lookup_join(skewed, lookup, "key", spread_by="id")
    want = skewed.join(lookup, "key")
    assert sorted(map(tuple, got.select("key", "id", "x").collect())) == sorted(map(tuple, want.select("key", "id", "x").collect()))


def test_hot_rows_are_spread(spark, skewed):
    counts = skewed.groupBy("key").agg(F.count("*").alias("rows"))
    hot = hot_keys(counts, "key", "rows")
    assert 0 in {r["key"] for r in hot.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        lookup = spark.range(1000).select(F.col("id").alias("key"), F.lit(1).alias("x"))
        sizes = [r["count"] for r in lookup_join(skewed, lookup, "key", "id").groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 4 * sum(sizes) / 16
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_running_number_with_a_hot_key(spark, skewed):
    got = running_number(skewed, ["key"], ["v", "id"], "n", total="size").collect()
    seen = {}
    for r in sorted(got, key=lambda r: (r["key"], r["v"], r["id"])):
        seen[r["key"]] = seen.get(r["key"], 0) + 1
        assert r["n"] == seen[r["key"]]
    assert all(r["size"] == seen[r["key"]] for r in got)


def test_running_number_over_all_rows_and_null_keys(spark):
    df = spark.createDataFrame([(None, 3), ("a", 1), (None, 1), ("a", 2)], "k string, v int")
    by_key = {(r["k"], r["v"]): r["n"] for r in running_number(df, ["k"], ["v"], "n").collect()}
    assert by_key == {(None, 1): 1, (None, 3): 2, ("a", 1): 1, ("a", 2): 2}
    overall = running_number(df, [], [F.desc("v"), "k"], "n", total="size")
    assert sorted((r["n"], r["v"], r["size"]) for r in overall.collect()) == [(1, 3, 4), (2, 2, 4), (3, 1, 4), (4, 1, 4)]


def test_turns_across_block_borders(spark):
    turns = spark.createDataFrame([(c, t * 10, "user", f"{c}-{t}") for c in (1, 2) for t in range(23)], "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r["history"] for r in multi_turn_context(turns, n=3, block=5).collect()}
    for c in (1, 2):
        for t in range(23):
            assert got[(c, t * 10)] == "\n".join(f"user: {c}-{i}" for i in range(max(0, t - 3), t))
