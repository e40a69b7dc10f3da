"""Joins whose keys are mostly one value."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import skew
from linkloom.operators.materialize import materialize, shared_folder
from linkloom.operators.skew import block_join, lookup_join


def hot_rows(spark, n, name):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 11))
    return spark.range(n).select(key.alias("key"), F.col("id").alias(name))


@pytest.mark.parametrize("block_rows", [1, 4, 10, 1000])
def test_block_join_equals_join(spark, block_rows):
    left, right = hot_rows(spark, 100, "a"), hot_rows(spark, 70, "b").filter("key <> 'k1'")
    want = sorted(map(tuple, left.join(right, "key").select("key", "a", "b").collect()))
    got = block_join(left, right, ["key"], "a", "b", block_rows=block_rows).select("key", "a", "b")
    assert sorted(map(tuple, got.collect())) == want


def test_block_join_cuts_hot_keys(spark):
    left, right = hot_rows(spark, 300, "a"), hot_rows(spark, 300, "b")
    joined = block_join(left, right, ["key"], "a", "b", block_rows=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_l" in plan and "cartesian" not in plan.lower()
    assert joined.filter("key = 'hot'").count() == 100 * 100


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_equals_join(spark, monkeypatch, how):
    monkeypatch.setattr(skew, "HOT_KEYS", 4)
    rows = hot_rows(spark, 100, "a")
    lookup = rows.groupBy("key").agg(F.count("*").alias("n")).filter("key <> 'k2'")
    lookup = lookup.withColumn("v", F.concat(F.lit("v"), F.col("key")))
    want = sorted(map(tuple, rows.join(lookup, "key", how).select("key", "a", "n", "v").collect()))
    got = lookup_join(rows, lookup, ["key"], "n", "a", how)
    assert got.columns == ["key", "a", "n", "v"]
    assert sorted(map(tuple, got.collect())) == want


def test_lookup_join_rejects_other_kinds(spark):
    rows = hot_rows(spark, 3, "a")
    with pytest.raises(ValueError):
        lookup_join(rows, rows.withColumn("n", F.lit(1)), ["key"], "n", "a", "right")


def test_written_tables_go_to_the_shared_folder(spark):
    table = materialize(spark.range(5), "five")
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert all(folder in name for name in table.inputFiles())
    assert table.count() == 5
