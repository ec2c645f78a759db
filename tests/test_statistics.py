"""Statistics of batches merged against one pass over all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starload.operators.statistics import batch_statistics, merge_statistics, report, row_length

SCHEMA = "k long, hot string, price double, day date, tags array<string>, none int"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(9)
    rows = [(i, "hot" if i % 3 else f"v{rng.randrange(5000)}é", rng.random() * 100 if i % 5 else None,
             dt.date(2020, 1, 1) + dt.timedelta(days=i % 400), ["a"] * (i % 3), None) for i in range(9000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6), rows


def merged(table, cuts, spark, path):
    df, _ = table
    for low, high in zip([0, *cuts], [*cuts, 9000]):
        batch_statistics(df.filter((F.col("k") >= low) & (F.col("k") < high))).write.mode("append").parquet(path)
    return merge_statistics(spark.read.parquet(path))


@pytest.mark.parametrize("cuts", [[], [100, 100, 4000, 8999]])      # one batch; five, one of them empty
def test_exact_parts_equal_one_pass_and_estimates_keep_their_bounds(table, spark, tmp_path, cuts):
    _, rows = table
    stats = merged(table, cuts, spark, str(tmp_path / "s"))
    got = {r.column_name: r for r in report(stats).collect()}
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    assert sorted(got) == sorted(names)
    for at, name in enumerate(names):
        values = [r[at] for r in rows if r[at] is not None]
        assert (got[name].rows, got[name].nulls) == (9000, 9000 - len(values))
        exact = len({str(v) for v in values})
        assert abs(got[name].distinct_estimate - exact) <= 0.05 * exact
    assert got["hot"].bytes == sum(len(r[1].encode()) for r in rows) and got["day"].bytes == 4 * 9000
    prices = sorted(r[2] for r in rows if r[2] is not None)
    assert (got["price"].least, got["price"].largest) == (prices[0], prices[-1])
    for q, value in zip((0.25, 0.5, 0.75), got["price"].quantiles):
        assert abs(sum(p <= value for p in prices) / len(prices) - q) <= 0.02
    assert got["day"].first_text == "2020-01-01" and got["day"].last_text == "2021-02-03"
    assert got["hot"].heavy_values[0]["item"] == "hot" and got["hot"].heavy_values[0]["count"] == 6000
    assert got["none"].quantiles is None and got["none"].heavy_values == [] and got["none"].distinct_estimate == 0
    total = row_length(stats).first()
    assert total.rows == 9000 and total.bytes == sum(r.bytes for r in got.values())
    assert total.blocks == -(-total.bytes // 8192)


def test_merged_statistics_merge_again(table, spark, tmp_path):
    parts = merged(table, [3000], spark, str(tmp_path / "a"))
    again = merge_statistics(parts.unionByName(merged(table, [], spark, str(tmp_path / "b"))))
    first = {r.column_name: r for r in report(again).collect()}
    assert first["k"].rows == 18000 and abs(first["k"].distinct_estimate - 9000) <= 450
    assert first["hot"].heavy_values[0]["count"] == 12000


def test_no_rows(table, spark):
    got = report(merge_statistics(batch_statistics(table[0].limit(0)))).collect()
    assert len(got) == 6 and all(r.rows == r.bytes == r.distinct_estimate == 0 and r.average_length is None for r in got)
