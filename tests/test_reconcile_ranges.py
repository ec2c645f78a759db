"""Two-level reconciliation: equal to ``reconcile``, and reads only what differs."""

import importlib
import random

import pytest
from pyspark.sql import functions as F

R = importlib.import_module("starload.operators.reconcile")       # the package also exports a function of that name


def counts(df):
    return {r.status: r.n for r in df.collect()}


@pytest.mark.parametrize("ranges", [1, 7, 4096])
@pytest.mark.parametrize("composite", [False, True])
def test_counts_equal_reconcile(spark, ranges, composite):
    rng = random.Random(ranges)
    rows = [(i * 3 - 400, f"k{i % 50}", rng.choice([None, "a", "b"]), float(i)) for i in range(700)] + [(None, "n", "x", 0.0)]
    other = [r if rng.random() < 0.9 else (r[0], r[1], "edited", r[3]) for r in rows if rng.random() < 0.95]
    other += [(5000 + i, "new", None, 1.0) for i in range(20)]
    s = spark.createDataFrame(rows, "k long, g string, v string, w double").repartition(3)
    t = spark.createDataFrame(other, s.schema).repartition(2)
    key = ["k", "g"] if composite else "k"
    assert counts(R.reconcile_ranges(s, t, key, ranges=ranges)) == counts(R.reconcile(s, t, key))


def test_equal_tables_join_nothing(spark, monkeypatch):
    s = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") * 7).cast("string").alias("v"))
    monkeypatch.setattr(R, "reconcile_rows", lambda *a, **k: pytest.fail("keys were joined"))
    assert counts(R.reconcile_ranges(s, s.repartition(5), "k")) == {"match": 10_000, "changed": 0, "missing": 0, "extra": 0}
    empty = s.limit(0)
    assert counts(R.reconcile_ranges(empty, empty, "k")) == {"match": 0, "changed": 0, "missing": 0, "extra": 0}


def test_columns_swapped_between_rows_differ(spark):
    """A range's digest is of whole rows, keys included: sums of columns are not enough."""
    s = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    t = spark.createDataFrame([(1, "b"), (2, "a")], "k int, v string")
    assert counts(R.reconcile_ranges(s, t, "k", ranges=1)) == {"match": 0, "changed": 2, "missing": 0, "extra": 0}


def test_only_differing_ranges_are_read_again(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100_000).select(F.col("id").alias("k"), F.lit("v").alias("v")).write.parquet(path)
    s = spark.read.parquet(path)
    t = s.withColumn("v", F.when(F.col("k").isin(500, 90_000), F.lit("w")).otherwise(F.col("v")))
    bucket, differ, agreed, pushed = R.differing_ranges(s, t, "k")
    assert len(differ) == 2 and agreed > 99_900
    plan = s.filter(pushed).filter(bucket.isin(differ))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,500)" in plan.replace(" ", "") and "Or(" in plan
    assert counts(R.reconcile_ranges(s, t, "k")) == {"match": 99_998, "changed": 2, "missing": 0, "extra": 0}


def test_intervals_cover_the_ranges_with_the_widest_gaps_left_out():
    ranges = [1, 2, 3, 10, 11, 50, 52, 90]
    assert R._intervals(ranges, 32) == [(1, 3), (10, 11), (50, 50), (52, 52), (90, 90)]
    assert R._intervals(ranges, 3) == [(1, 11), (50, 52), (90, 90)]
    assert R._intervals([4], 3) == [(4, 4)]
