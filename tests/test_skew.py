"""Hot keys through shuffle joins: a third of lineitem points at one part.

Broadcasting is switched off (as for a dimension above the row bound), so
lookups and anti joins are sort-merge joins; AQE must split the hot
partition (``SortMergeJoin(skew=true)``) and results must stay exact.  AQE
splits a skewed partition along map outputs, so the input is first spread
over 8 tasks (a 1 MB single-row-group file would be one map task; at scale
the input has many files and row groups).
"""

import pytest
from pyspark.sql import functions as F

from starload.operators import assign_surrogate_keys, dim_lookup, fk_orphans, join_on_keys

from locations import SF_ORACLE

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
}


@pytest.fixture()
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    li = spark.read.parquet(f"{SF_ORACLE}/lineitem.parquet")
    hot = li.select("l_orderkey", "l_linenumber",
                    F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_partkey")).alias("l_partkey")
                    ).repartition(8)
    yield hot
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_with_hot_key_is_exact_and_split(spark, skewed):
    part = spark.read.parquet(f"{SF_ORACLE}/part.parquet").select("p_partkey")
    dim = assign_surrogate_keys(part, "p_partkey", sk="sk_part")
    out = dim_lookup(skewed, dim, "l_partkey", "p_partkey", sk="sk_part", keep_fk=True)
    rows = out.collect()
    assert "skew=true" in final_plan(out)
    assert len(rows) == skewed.count()
    # part keys are 0..n-1, so the surrogate key is key + 1
    assert all(r.sk_part == r.l_partkey + 1 for r in rows)


def test_fk_orphans_with_hot_key_is_exact_and_split(spark, skewed):
    part = spark.read.parquet(f"{SF_ORACLE}/part.parquet")
    child = skewed.withColumn("l_partkey", F.when(F.col("l_linenumber") == 7, F.col("l_partkey") + 10**6)
                              .otherwise(F.col("l_partkey")))
    out = fk_orphans(child, part, "l_partkey", "p_partkey")
    rows = out.collect()
    assert "skew=true" in final_plan(out)
    assert len(rows) == child.filter(F.col("l_partkey") >= 10**6).count()


@pytest.mark.parametrize("split_hot", [True, False])
def test_join_with_own_aggregate_splits_a_hot_group(skewed, split_hot):
    """Without an exchange of its own on the aggregate side AQE cannot split."""
    groups = skewed.groupBy(F.col("l_partkey").alias("g")).agg(F.count("*").alias("n"))
    out = join_on_keys(skewed, groups, ["l_partkey"], ["g"], split_hot=split_hot)
    rows = out.collect()
    assert ("skew=true" in final_plan(out)) == split_hot
    want = {r.l_partkey: r["count"] for r in skewed.groupBy("l_partkey").count().collect()}
    assert len(rows) == sum(want.values()) and all(r.n == want[r.l_partkey] for r in rows)
