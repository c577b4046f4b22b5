"""Joins with hot keys give what plain joins give."""

import pytest
from pyspark.sql import functions as F

from frames import rows
from loanlake.operators.joins import SkewPolicy, hot_keys, inner_join, left_joins, matching_rows

KEYS = ["k", "d"]
EAGER = SkewPolicy(max_keys=10, min_rows=20, tracked=64)


def table(spark, hot, cold, value, copies=False):
    """Keys 0 to ``cold`` with two rows each, plus ``hot`` rows of key 7; exact copies if asked for."""
    base = spark.range(0, cold * 2, 1, 8).select((F.col("id") % cold).alias("k"), F.col("id").alias(value))
    extra = spark.range(0, hot, 1, 8).select(
        F.lit(7).cast("long").alias("k"), (F.lit(-1).cast("long") if copies else -F.col("id")).alias(value)
    )
    return base.unionAll(extra).withColumn("d", F.lit("m")).select("k", "d", value)


def keep_even(df):
    return df.where(F.col("k") % 2 == 1)


CASES = {
    "none": (0, 0, 0),
    "left": (300, 0, 0),
    "one right": (0, 300, 0),
    "both rights": (0, 100, 90),
    "left and right": (80, 70, 0),
}


@pytest.mark.parametrize("copies", [False, True], ids=["rows", "copies"])
@pytest.mark.parametrize("case", CASES)
def test_left_joins(spark, case, copies):
    hot = CASES[case]
    left = table(spark, hot[0], 40, "a", copies)
    rights = {"r1": keep_even(table(spark, hot[1], 50, "b", copies)), "r2": keep_even(table(spark, hot[2], 30, "c"))}
    found = hot_keys({"left": left, **rights}, KEYS, EAGER)
    expected_hot = {name for name, n in zip(["left", "r1", "r2"], hot) if n}
    assert set(found) == expected_hot
    assert all([row["k"] for row in df.collect()] == [7] for df in found.values())
    plain = left.join(rights["r1"], KEYS, "left").join(rights["r2"], KEYS, "left")
    got = left_joins(left, rights, KEYS, EAGER)
    assert rows(got) == rows(plain)


def test_hot_key_without_partner(spark):
    """Rows of a hot right key that no left row has must not appear, and left rows must not be lost."""
    left = table(spark, 0, 40, "a").where(F.col("k") != 7)
    right = table(spark, 500, 20, "b")
    got = left_joins(left, {"right": right}, KEYS, EAGER)
    assert rows(got) == rows(left.join(right, KEYS, "left"))


@pytest.mark.parametrize("hot", [(0, 0), (200, 0), (0, 200), (60, 50)])
def test_inner_join(spark, hot):
    left, right = table(spark, hot[0], 40, "a"), keep_even(table(spark, hot[1], 30, "b"))
    assert rows(inner_join(left, right, KEYS, EAGER)) == rows(left.join(right, KEYS))


@pytest.fixture
def as_if_large(spark):
    """Neither broadcast the tables nor merge their partitions for being small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("sides", [(4000, 0), (0, 4000)], ids=["left", "right"])
@pytest.mark.parametrize("copies", [False, True], ids=["rows", "copies"])
def test_hot_rows_are_spread(spark, as_if_large, sides, copies):
    """The rows of a hot key reach several tasks, also if they are exact copies."""
    left, right = table(spark, sides[0], 40, "a", copies), table(spark, sides[1], 30, "b", copies)
    joined = left_joins(left, {"right": right}, KEYS, EAGER)
    tasks = joined.where("k = 7").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 2
    assert max(row["count"] for row in tasks) < 6000


def test_hot_rows_of_one_task_are_spread(spark, as_if_large):
    """Also if the input is partitioned on the key, so that one task reads all rows of the hot key."""
    left = table(spark, 4000, 40, "a").repartition(8, "k")
    joined = left_joins(left, {"right": table(spark, 0, 30, "b")}, KEYS, EAGER)
    tasks = joined.where("k = 7").groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 2


def test_ordinary_keys_use_the_plain_plan(spark):
    left, right = table(spark, 0, 40, "a"), table(spark, 0, 30, "b")
    assert left_joins(left, {"right": right}, KEYS).sameSemantics(left.join(right, KEYS, "left"))


def test_rows_without_a_match_are_not_shuffled(spark):
    left = spark.createDataFrame([(i, i % 3) for i in range(0, 60, 2)] * 2, "k int, m int")
    right = spark.createDataFrame([(i, i % 3, f"v{i}") for i in range(100)] * 3, "k int, m int, v string")
    thin = matching_rows({"r": right}, left, ["k", "m"])["r"]
    assert rows(thin) == rows(right.where("k < 60 and k % 2 = 0")) and thin.columns == right.columns
    assert rows(left_joins(left, {"r": thin}, ["k", "m"])) == rows(left_joins(left, {"r": right}, ["k", "m"]))
    assert matching_rows({"r": right}, left, ["k", "m"], 29)["r"] is right
    assert rows(matching_rows({"r": right}, left, ["k", "m"], 30)["r"]) == rows(thin)
    assert matching_rows({"r": right}, left.where("k < 0"), ["k", "m"])["r"].count() == 0
