"""Unit tests per operator on tiny hand-made frames (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from starload.functions import (cast_decimal, cast_try_default, ci_equals, fill_min_date, fill_text, fill_zero,
                                flag_decode, iso_text, parse_date)
from starload.operators import (anti_members, assign_surrogate_keys, assign_surrogate_keys_incremental,
                                check_violations, collect_set_by_key, conform_schema, count_checks, date_dim,
                                dim_lookup, distinct_counts, fill_nulls, fk_orphans, functional_dependency,
                                listagg_ordered, map_columns, missing_dim_default, nest_children, not_null_check,
                                reconcile, reject_split, self_fk_orphans, semi_members, set_difference_counts,
                                split_hierarchy, table_profile, unique_check)


def _key(t):
    return tuple((v is None, v) for v in t)


def srt(items):
    return sorted(items, key=_key)


def rows(df, *cols):
    cols = cols or df.columns
    return srt(tuple(r[c] for c in cols) for r in df.collect())


# ------------------------------------------------------------------ mapping and fills

def test_map_columns_one_source_many_targets(spark):
    df = spark.createDataFrame([(1, "2020-05-06")], "id int, d string")
    out = map_columns(df, [("a", "id"), ("b", "id"), ("day", F.to_date("d"))])
    assert out.columns == ["a", "b", "day"]
    assert rows(out) == [(1, 1, dt.date(2020, 5, 6))]


def test_fill_keeps_decimal_type_and_date_fill_works(spark):
    # Defects 1 and 5: a date filled with text, a decimal filled with 0.0.
    df = spark.createDataFrame([(None, None, None), (Decimal("1.50"), dt.date(2000, 1, 2), "x")],
                               "m decimal(10,2), d date, s string")
    out = fill_nulls(df, {"m": "zero", "d": "min_date", "s": "na"})
    assert out.schema["m"].dataType == DecimalType(10, 2)
    assert rows(out) == sorted([(Decimal("0.00"), dt.date(1900, 1, 1), "N/A"),
                                (Decimal("1.50"), dt.date(2000, 1, 2), "x")])


def test_fill_mean_uses_non_null_average(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    assert sorted(r.v for r in fill_nulls(df, {"v": "mean"}).collect()) == [1.0, 2.0, 3.0]


def test_null_hire_date_date_dim_row(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2001, 3, 4, 10, 0),)], "h timestamp_ntz")
    dd = date_dim([(df, "h")])
    assert rows(dd, "date_value", "day", "month", "year") == [
        (dt.date(1900, 1, 1), 1, 1, 1900), (dt.date(2001, 3, 4), 4, 3, 2001)]


def test_two_employees_same_hire_date_one_date_row(spark):
    emp = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 1))], "id int, h date")
    dd = date_dim([(emp, "h")])
    assert dd.count() == 1
    from starload.operators import date_lookup
    fact = date_lookup(emp, dd, "h", sk="sk_date")
    assert rows(fact, "id", "sk_date") == [(1, 1), (2, 1)]


def test_commission_half_up_and_strict_overflow(spark):
    df = spark.createDataFrame([(0.255,), (None,)], "c double")
    out = df.select(fill_zero(cast_decimal("c", 10, 2), DecimalType(10, 2)).alias("c"))
    assert sorted(r.c for r in out.collect()) == [Decimal("0.00"), Decimal("0.26")]
    big = spark.createDataFrame([(123456789012.0,)], "v double")
    # ANSI: too large for decimal(10,2) raises instead of becoming null -> 0.
    with pytest.raises(Exception):
        big.select(cast_decimal("v", 10, 2)).collect()
    # The explicit default path.
    assert big.select(cast_try_default("v", "decimal(10,2)", 0).alias("x")).first().x == Decimal("0.00")


def test_conform_schema_orders_casts_and_checks(spark):
    df = spark.createDataFrame([("a", 1)], "name string, id int")
    schema = StructType([StructField("id", LongType()), StructField("name", StringType()),
                         StructField("note", StringType())])
    with pytest.raises(ValueError):
        conform_schema(df, schema)
    out = conform_schema(df, schema, allow_missing=True)
    assert out.schema == StructType([StructField("id", LongType()), StructField("name", StringType()),
                                     StructField("note", StringType())])


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("building", "Y", "2021-02-03", None)], "seg string, f string, t string, n string")
    r = df.select(ci_equals("seg", "BUILDING").alias("ci"), flag_decode("f").alias("flag"),
                  parse_date("t", "yyyy-MM-dd").alias("ok"), parse_date("t", "dd/MM/yyyy").alias("bad"),
                  iso_text(F.to_date("t")).alias("iso"), fill_text("n").alias("na"),
                  fill_min_date(F.lit(None).cast("date")).alias("md")).first()
    assert (r.ci, r.flag, r.ok, r.bad, r.iso, r.na, r.md) == (
        True, True, dt.date(2021, 2, 3), None, "2021-02-03", "N/A", dt.date(1900, 1, 1))


# ------------------------------------------------------------------ lookups

def test_dim_lookup_null_orphan_status_and_drop(spark):
    dim = spark.createDataFrame([(10, 1), (20, 2)], "k int, sk bigint")
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, k int")
    out = dim_lookup(fact, dim, "k", sk="sk", status_col="st")
    assert "k" not in out.columns
    assert rows(out, "id", "sk", "st") == [(1, 1, "found"), (2, -1, "null_key"), (3, -1, "orphan")]


def test_dim_lookup_keeps_row_count_on_unique_dim(spark):
    dim = spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 1).alias("sk"))
    fact = spark.range(1000).select((F.col("id") % 120).alias("k"))
    assert dim_lookup(fact, dim, "k", sk="sk").count() == 1000


def test_missing_dimension_gives_unknown_member(spark):
    df = spark.createDataFrame([(1, "FR")], "id int, country string")
    out = missing_dim_default(df, "country", "sk_country")
    assert rows(out) == [(1, -1)]


def test_semi_and_anti_members_null_safe(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (1,), (3,)], "k int")
    assert rows(semi_members(a, b, "k")) == [(1,)]
    assert rows(anti_members(a, b, "k"), "k") == srt([(2,), (None,)])


# ------------------------------------------------------------------ keys

def test_surrogate_keys_equal_row_number_no_gaps(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("k"))
    out = assign_surrogate_keys(df, "k", sk="sk", num_partitions=6)
    got = rows(out, "k", "sk")
    assert got == [(k, k + 1) for k in range(5000)]


def test_surrogate_keys_hot_key_spread(spark):
    # A key held by a third of the rows still numbers 1..n without gaps.
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("v"))
    out = assign_surrogate_keys(df, "k", sk="sk", num_partitions=8)
    sks = sorted(r.sk for r in out.collect())
    assert sks == list(range(1, 3001))
    per_part = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_part) > 1


def test_surrogate_keys_incremental_continue(spark):
    first = assign_surrogate_keys(spark.createDataFrame([(5,), (1,)], "k int"), "k", sk="sk")
    new = assign_surrogate_keys_incremental(spark.createDataFrame([(1,), (3,), (9,)], "k int"), first, "k", sk="sk")
    assert rows(new, "k", "sk") == [(3, 3), (9, 4)]


def test_split_hierarchy(spark):
    df = spark.createDataFrame([(1, "B"), (2, "A"), (3, "B")], "id int, brand string")
    parent, child = split_hierarchy(df, ["brand"], "sk_brand")
    assert rows(parent, "brand", "sk_brand") == [("A", 1), ("B", 2)]
    assert rows(child, "id", "sk_brand") == [(1, 2), (2, 1), (3, 2)]


# ------------------------------------------------------------------ quality

def test_count_checks_single_row(spark):
    df = spark.createDataFrame([(1, -1), (2, 5), (None, -1)], "a int, sk int")
    r = count_checks(df, {"null_a": F.col("a").isNull(), "unknown": F.col("sk") == -1}).first()
    assert (r.null_a, r.unknown, r.rows) == (1, 2, 3)


def test_reject_split_partitions_input(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, "y")], "k int, name string")
    valid, rejected = reject_split(df, {"null_key": F.col("k").isNull(), "null_name": F.col("name").isNull()})
    assert valid.count() + rejected.count() == df.count()
    assert rows(rejected, "k", "reject_reasons") == srt([(1, ["null_name"]), (None, ["null_key"])])


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(unique_check(df, "k")) == [(1, 2)]
    assert rows(not_null_check(df)) == [("k", 0), ("v", 1)]


def test_fk_orphans_ignore_null_fk_and_self_reference(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(10, 1), (11, None), (12, 7)], "cid int, pid int")
    assert rows(fk_orphans(child, parent, "pid", "id")) == [(12, 7)]
    emp = spark.createDataFrame([(1, None), (2, 1), (3, 42)], "id int, manager_id int")
    assert rows(self_fk_orphans(emp, "id", "manager_id")) == [(3, 42)]


def test_check_violations_null_passes(spark):
    df = spark.createDataFrame([(1, 2), (3, 1), (None, 1)], "a int, b int")
    assert rows(check_violations(df, "a <= b")) == [(3, 1)]


def test_reconcile_statuses(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    assert dict(rows(reconcile(s, t, "k"))) == {"match": 1, "changed": 1, "missing": 1, "extra": 1}
    assert dict(rows(reconcile(s, s, "k"))) == {"match": 3, "changed": 0, "missing": 0, "extra": 0}


def test_set_difference_counts_multiset(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(set_difference_counts(a, b)) == [("left_only", 2, False), ("right_only", 1, False)]
    assert all(r.equal for r in set_difference_counts(a, a).collect())


# ------------------------------------------------------------------ nesting and profiling

def test_listagg_and_nest_are_ordered(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, "z")], "g int, pos int, v string")
    assert rows(listagg_ordered(df, "g", "v", "pos", alias="l")) == [(1, "a,b,c"), (2, "z")]
    nested = nest_children(df, "g", "pos", ["v"], alias="j", as_json=True)
    assert rows(nested) == [(1, '[{"v":"a"},{"v":"b"},{"v":"c"}]'), (2, '[{"v":"z"}]')]
    assert rows(collect_set_by_key(df.withColumn("v", F.lit("q")), "g", "v", alias="s")) == [(1, "q"), (2, "q")]


def test_profile_and_distincts(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (2, "a")], "k int, v string")
    prof = {r.column_name: r for r in table_profile(df).collect()}
    assert (prof["k"].rows, prof["k"].nulls, prof["k"].distinct_count, prof["k"].min_value,
            prof["k"].max_value) == (3, 0, 2, "1", "2")
    assert (prof["v"].nulls, prof["v"].distinct_count) == (1, 1)
    empty = spark.createDataFrame([(None,)], "v string")
    assert rows(distinct_counts(empty)) == [("v", 0)]


def test_profile_of_every_type(spark):
    df = spark.sql("""SELECT * FROM VALUES
        (1S, 10L, 0.0D, 1.50BD, true, DATE'2024-01-02', TIMESTAMP'2024-01-02 03:04:05.000001', X'00FF', 'b', 1),
        (2S, 9L, -0.0D, 1.5BD, true, DATE'2024-01-02', TIMESTAMP'2024-01-02 03:04:05.000002', X'00FE', 'B', 1),
        (1S, 9L, double('NaN'), null, false, null, null, X'00FF', '', 1),
        (1S, null, double('NaN'), -2BD, null, DATE'0001-01-01', null, null, null, 1)
        AS t(small, whole, real, exact, flag, day, at, raw, k, there)""")
    got = {r.column_name: tuple(r)[1:] for r in table_profile(df).collect()}
    assert {c: v[2] for c, v in got.items()} == {"small": 2, "whole": 2, "real": 2, "exact": 2, "flag": 2, "day": 2,
                                                 "at": 2, "raw": 2, "k": 3, "there": 1}
    assert got["whole"] == (4, 1, 2, "9", "10") and got["day"] == (4, 1, 2, "0001-01-01", "2024-01-02")
    assert got["exact"] == (4, 1, 2, "-2.00", "1.50") and got["k"] == (4, 1, 3, "", "b")
    nothing = {r.column_name: tuple(r)[1:] for r in table_profile(df.limit(0)).collect()}
    assert len(nothing) == 10 and set(nothing.values()) == {(0, 0, 0, None, None)}


def test_functional_dependency(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    r = functional_dependency(df, "k", "v").first()
    assert (r.violating_groups, r.holds) == (1, False)


def test_reconcile_repeated_keys_no_pair_blowup(spark):
    # one key holds most rows on both sides: fingerprints make the join 1:1
    s = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
                                 (F.col("id") % 5).alias("v"))
    t = s.union(spark.createDataFrame([(1, 4)], "k long, v long"))
    got = dict(rows(reconcile(s, t, "k")))
    assert got["changed"] == 1 and got["missing"] == 0 and got["extra"] == 0
    assert got["match"] == s.select("k").distinct().count() - 1


def test_chunked_nesting_of_hot_parent(spark):
    # parent 1 holds a third of the rows; chunks keep order and size
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 1000).alias("g"),
                                 F.col("id").alias("pos"))
    out = nest_children(df, "g", "pos", ["pos"], alias="kids", chunk_size=50)
    hot = sorted((r.chunk, [k.pos for k in r.kids]) for r in out.filter("g = 1").collect())
    assert [len(k) for _, k in hot] == [50] * 6
    flat = [p for _, kids in hot for p in kids]
    assert flat == list(range(0, 900, 3))
    texts = listagg_ordered(df, "g", "pos", "pos", alias="l", chunk_size=100).filter("g = 1")
    assert ",".join(r.l for r in texts.orderBy("chunk").collect()) == ",".join(str(p) for p in range(0, 900, 3))


def test_dedupe_keeps_smallest_row_per_key(spark):
    from starload.operators.dims import dedupe_on_key

    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, None, 1), (2, "z", 0)], "k int, s string, n int")
    out = dedupe_on_key(df, ["k"])
    assert out.columns == ["k", "s", "n"]
    assert rows(out) == [(1, "a", 9), (2, None, 1)]


# ------------------------------------------------------------------ nulls and empty inputs

def test_reconcile_nulls(spark):
    a = spark.createDataFrame([(1, 5, None), (None, 1, 2)], "k int, x int, y int")
    b = spark.createDataFrame([(1, None, 5), (None, 1, 2)], "k int, x int, y int")
    assert dict(rows(reconcile(a, b, "k"), "status", "n")) == {"match": 1, "changed": 1, "missing": 0, "extra": 0}
    assert dict(rows(reconcile(a, a, "k"), "status", "n"))["match"] == 2


def test_split_hierarchy_null_attribute(spark):
    df = spark.createDataFrame([("A", None), ("A", "x"), (None, None)], "brand string, kind string")
    parent, child = split_hierarchy(df, ["brand", "kind"], "sk")
    back = child.join(parent, "sk").select("brand", "kind")
    assert rows(back) == srt([("A", None), ("A", "x"), (None, None)])


def test_chunked_nesting_keeps_null_parent(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "p int, v int")
    out = listagg_ordered(df, "p", "v", "v", chunk_size=1)
    assert rows(out, "p", "chunk", "list") == srt([(None, 0, "1"), (None, 1, "2"), (1, 0, "3")])


def test_profiles_of_empty_columns(spark):
    from starload.operators.profile import fk_containment, infer_types

    nothing = spark.createDataFrame([(None,)], "a string")
    assert infer_types(nothing).first().share_int is None
    assert fk_containment(nothing, "a", nothing, "a").first().ratio is None
