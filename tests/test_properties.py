"""Property tests (hypothesis): surrogate keys equal row_number, lookups
keep row counts, reject split partitions the input, reconcile(x, x)."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starload.operators import assign_surrogate_keys, dim_lookup, reconcile, reject_split

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture()
def distributed(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@SETTINGS
@given(keys=st.lists(st.integers(-10**6, 10**6), min_size=0, max_size=300, unique=True),
       parts=st.integers(1, 9))
def test_distributed_keys_equal_row_number(spark, distributed, keys, parts):
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(parts)
    got = {r.k: r.sk for r in assign_surrogate_keys(df, "k", sk="sk").collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_distributed_keys_with_aqe_coalescing(spark, distributed):
    df = spark.range(0, 20000, 1, 13).select(((F.col("id") * 7919) % 20000).alias("k"))
    out = assign_surrogate_keys(df, "k", sk="sk")
    expect = df.withColumn("rn", F.row_number().over(Window.orderBy("k")))
    assert out.join(expect, "k").filter(F.col("sk") != F.col("rn")).count() == 0
    assert out.count() == 20000


@SETTINGS
@given(fact=st.lists(st.one_of(st.none(), st.integers(0, 30)), max_size=60),
       dim=st.lists(st.integers(0, 30), max_size=20, unique=True))
def test_lookup_keeps_rows_and_flags_unknown(spark, fact, dim):
    f = spark.createDataFrame([(i, k) for i, k in enumerate(fact)], "id int, k int")
    d = spark.createDataFrame([(k, k + 100) for k in dim], "k int, sk long")
    out = {r.id: r.sk for r in dim_lookup(f, d, "k", sk="sk").collect()}
    assert out == {i: (k + 100 if k is not None and k in dim else -1) for i, k in enumerate(fact)}


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.text(max_size=3))),
                     max_size=40))
def test_reject_split_partitions_input(spark, rows):
    df = spark.createDataFrame(rows, "k int, s string")
    valid, rejected = reject_split(df, {"null_k": F.col("k").isNull(), "null_s": F.col("s").isNull()})
    assert valid.count() + rejected.count() == len(rows)
    assert valid.filter(F.col("k").isNull() | F.col("s").isNull()).count() == 0


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 10), st.one_of(st.none(), st.integers(-2**63, 2**63 - 1))), max_size=40))
def test_reconcile_self_is_all_match(spark, rows):
    df = spark.createDataFrame(rows, "k int, v long")
    got = {r.status: r.n for r in reconcile(df, df, "k").collect()}
    assert got["changed"] == got["missing"] == got["extra"] == 0
    assert got["match"] == len({k for k, _ in rows})
