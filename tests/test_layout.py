"""Layout along a curve: which files a filter skips, measured."""

import random

import pytest
from pyspark.sql import functions as F

from starload.operators.layout import clustered, clustered_by_curve, curve_key, file_skipping, layout_advice


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(1000), 7 if i % 3 == 0 else rng.randrange(5000), f"name{rng.randrange(400):03d}")
            for i in range(20_000)]
    rows += [(-1, None, None, None)] * 50
    return spark.createDataFrame(rows, "id long, a int, b long, s string").repartition(4)


def stored(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def shares(df):
    return {r.column_name: r.skipped_share for r in df.collect()}


def test_the_curve_skips_files_on_either_column(table, tmp_path):
    by_a = shares(file_skipping(stored(clustered(table, "a", 32), str(tmp_path / "a")), ["a", "b"]))
    curve = stored(clustered_by_curve(table, ["a", "b"], 32), str(tmp_path / "c"))
    both = shares(file_skipping(curve, ["a", "b"]))
    assert by_a["a"] > 0.85 and by_a["b"] < 0.1                  # one column: the other's filter reads all
    assert both["a"] > 0.5 and both["b"] > 0.4                   # a third of the rows share one b
    assert sorted(map(str, curve.collect())) == sorted(map(str, table.collect()))


def test_three_columns_and_text(table, tmp_path):
    found = shares(file_skipping(stored(clustered_by_curve(table, ["a", "b", "s"], 64), str(tmp_path / "t")),
                                 ["a", "b", "s"]))
    assert min(found.values()) > 0.25


def test_curve_interleaves_ranks(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    got = {(r.x, r.y): r.key for r in df.withColumn("key", curve_key(df, ["x", "y"], bits=2)).collect()}
    assert sorted(got.values()) == list(range(16))
    assert got[0, 0] == 0 and got[0, 1] == 1 and got[1, 0] == 2 and got[1, 1] == 3 and got[2, 0] == 8


def test_a_value_held_by_a_third_of_the_rows_is_split(table):
    sizes = [r["count"] for r in clustered_by_curve(table.select("a", "b", "id").withColumn("a", F.lit(1)), ["a", "b"], 16)
             .groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3 * sum(sizes) / 16


def test_advice_follows_the_measurement(table):
    found = layout_advice(table, [["a"], ["b"], ["a", "b"]], ["a", "b"], files=32).collect()
    assert {r.layout for r in found if r.rnk == 1} == {"a,b"} and len(found) == 6
    only_a = layout_advice(table, [["a"], ["b"], ["a", "b"]], ["a"], files=32).collect()
    assert {r.layout for r in only_a if r.rnk == 1} == {"a"}


def test_empty_table_and_wrong_columns(table):
    assert clustered_by_curve(table.limit(0), ["a", "b"], 4).count() == 0
    with pytest.raises(ValueError):
        clustered_by_curve(table, ["a"], 4)
