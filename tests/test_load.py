"""Loader behaviour: dependency order, idempotent reruns, reject/fail modes."""

import pytest
from pyspark.sql import functions as F

from starload.operators.quality import LoadCheckError
from starload.plans.load import run_load
from starload.plans.spec import (FAIL, KEEP, REJECT, Lookup, TableSpec, build_table, mapped_rows, plan_table,
                                 topological_order)
from starload.plans.star import LOAD_TS, spec_by_name, star_sources, star_specs
from starload.sources.warehouse import append_by_name, append_new_only, read_back

from locations import SF_SMALL


def _regions(spark, rows):
    return {"REGIONS": spark.createDataFrame(rows, "REGION_ID int, REGION_NAME string")}


REGION_SPEC = TableSpec("d_region", "REGIONS", [("region_id", "REGION_ID"), ("region_name", "REGION_NAME")],
                        business_key=["region_id"], sk="sk_region", fill={"region_name": "na"})


def test_topological_order_parents_first(spark):
    order = [s.target for s in topological_order(list(reversed(star_specs())))]
    assert order.index("dim_region") < order.index("dim_nation") < order.index("dim_customer")
    assert order[-1] == "fact_lineitem"


def test_same_regions_twice_adds_nothing(spark, tmp_target):
    src = _regions(spark, [(1, "EU"), (2, None)])
    run_load(spark, [REGION_SPEC], src, tmp_target, LOAD_TS)
    run_load(spark, [REGION_SPEC], src, tmp_target, LOAD_TS)
    got = sorted(tuple(r) for r in read_back(spark, f"{tmp_target}/d_region")
                 .select("sk_region", "region_id", "region_name").collect())
    assert got == [(1, 1, "EU"), (2, 2, "N/A")]


def test_incremental_dimension_continues_keys(spark, tmp_target):
    run_load(spark, [REGION_SPEC], _regions(spark, [(5, "A"), (9, "B")]), tmp_target, LOAD_TS)
    run_load(spark, [REGION_SPEC], _regions(spark, [(5, "A"), (7, "C")]), tmp_target, LOAD_TS)
    got = sorted(tuple(r) for r in read_back(spark, f"{tmp_target}/d_region")
                 .select("region_id", "sk_region").collect())
    assert got == [(5, 1), (7, 3), (9, 2)]


def test_null_business_key_fails_or_rejects(spark, tmp_target):
    src = _regions(spark, [(1, "EU"), (None, "X")])
    with pytest.raises(LoadCheckError):
        build_table(REGION_SPEC, src, {})
    spec = TableSpec(**{**REGION_SPEC.__dict__, "on_null_key": REJECT})
    valid, rejected = build_table(spec, src, {})
    assert valid.count() == 1
    assert [r.reject_reasons for r in rejected.collect()] == [["null_business_key"]]


def test_unknown_parent_modes(spark):
    regions = _regions(spark, [(1, "EU")])
    countries = spark.createDataFrame([("FR", 1), ("XX", 99), ("YY", None)], "COUNTRY_ID string, REGION_ID int")
    src = {**regions, "COUNTRIES": countries}
    dim_region, _ = build_table(REGION_SPEC, src, {})

    def spec(mode):
        return TableSpec("d_country", "COUNTRIES", [("country_id", "COUNTRY_ID"), ("region_id", "REGION_ID")],
                         business_key=["country_id"], sk="sk_country",
                         lookups=[Lookup(["region_id"], "d_region", ["region_id"], "sk_region", on_missing=mode)])

    with pytest.raises(LoadCheckError):
        build_table(spec(FAIL), src, {"d_region": dim_region})
    # same check observed during the materialising checkpoint (no extra job)
    with pytest.raises(LoadCheckError, match="unresolved_sk_region"):
        build_table(spec(FAIL), src, {"d_region": dim_region}, materialize_checked=True)
    ok, _ = build_table(spec(KEEP), src, {"d_region": dim_region}, materialize_checked=True)
    assert ok.count() == 3
    kept, _ = build_table(spec(KEEP), src, {"d_region": dim_region})
    assert sorted((r.country_id, r.sk_region) for r in kept.collect()) == [("FR", 1), ("XX", -1), ("YY", -1)]
    valid, rejected = build_table(spec(REJECT), src, {"d_region": dim_region})
    assert [r.country_id for r in valid.collect()] == ["FR"]
    assert sorted(r.country_id for r in rejected.collect()) == ["XX", "YY"]
    # Absent dimension: unknown member for everyone, not a KeyError.
    absent, _ = build_table(spec(KEEP), src, {})
    assert {r.sk_region for r in absent.collect()} == {-1}


def test_append_by_name_and_new_only(spark, tmp_target):
    first = spark.createDataFrame([(1, "a")], "k int, v string")
    append_by_name(first, tmp_target)
    append_by_name(spark.createDataFrame([("b", 2, "extra")], "v string, k int, z string"), tmp_target)
    append_new_only(spark.createDataFrame([(2, "b"), (3, "c")], "k int, v string"), tmp_target, "k")
    got = sorted(tuple(r) for r in read_back(spark, tmp_target).collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]
    assert read_back(spark, tmp_target).columns == ["k", "v"]


def test_star_load_twice_equals_once(spark, tmp_target):
    sources = star_sources(spark, SF_SMALL)
    first = dict((r.table_name, r.rows) for r in run_load(spark, star_specs(), sources, tmp_target, LOAD_TS).collect())
    second = dict((r.table_name, r.rows) for r in run_load(spark, star_specs(), sources, tmp_target, LOAD_TS).collect())
    assert first == second
    assert first["fact_lineitem"] == sources["lineitem"].count()
    fact = read_back(spark, f"{tmp_target}/fact_lineitem")
    assert fact.filter(F.col("sk_part") == -1).count() == 0


def test_verify_gate_passes_and_fails(spark, tmp_target):
    src = _regions(spark, [(1, "EU"), (2, "US")])
    run_load(spark, [REGION_SPEC], src, tmp_target, LOAD_TS, verify=True)
    # a source key the target lacks (null keys are rejected, so never loaded)
    spec = TableSpec(**{**REGION_SPEC.__dict__, "target": "d_region2"})
    from starload.plans.load import load_gate, reconcile_load
    run_load(spark, [spec], src, tmp_target, LOAD_TS)
    more = _regions(spark, [(1, "EU"), (2, "US"), (3, "X")])
    with pytest.raises(LoadCheckError, match="missing"):
        load_gate(reconcile_load(spark, [spec], more, tmp_target))


def _spec(**changes):
    return TableSpec(**{**REGION_SPEC.__dict__, "fill": {}, **changes})


def test_conflicting_keys_fail_reject_or_keep(spark, tmp_target):
    src = _regions(spark, [(1, "A"), (1, "A"), (7, "p"), (7, "q"), (7, None), (8, None), (8, None)])
    with pytest.raises(LoadCheckError, match="'duplicate_business_key': 1"):
        build_table(_spec(), src, {})
    for _ in range(2):
        run_load(spark, [_spec(on_duplicate_key=REJECT)], src, tmp_target, LOAD_TS)
    assert sorted((r.region_id, r.sk_region) for r in read_back(spark, f"{tmp_target}/d_region").collect()) == [
        (1, 1), (8, 2)]
    rejects = read_back(spark, f"{tmp_target}/d_region_rejected").collect()
    assert sorted((r.region_id, r.region_name or "") for r in rejects) == [(7, ""), (7, "p"), (7, "q")]
    assert {tuple(r.reject_reasons) for r in rejects} == {("duplicate_business_key",)}
    kept, _ = build_table(_spec(on_duplicate_key=KEEP), src, {})
    assert sorted(r.region_id for r in kept.collect()) == [1, 7, 8]


def test_null_keys_are_counted_before_collapsing(spark):
    src = _regions(spark, [(1, "A"), (None, "x"), (None, "x"), (None, "y")])
    with pytest.raises(LoadCheckError, match="'null_business_key': 3") as error:
        build_table(_spec(), src, {})
    assert "duplicate" not in str(error.value)


def test_load_clusters_files_by_spec(spark, tmp_target):
    src = {"REGIONS": spark.range(4000).selectExpr("cast(id as int) REGION_ID", "concat('n', id % 97) REGION_NAME")
           .repartition(4)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        run_load(spark, [_spec(cluster_by=["region_name"])], src, tmp_target, LOAD_TS)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = sorted((r.lo, r.hi) for r in read_back(spark, f"{tmp_target}/d_region")
                   .groupBy(F.input_file_name()).agg(F.min("region_name").alias("lo"), F.max("region_name").alias("hi"))
                   .collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_keys_of_orders_are_looked_up_before_lines_are_joined(spark):
    """Null, unknown and repeated orders, null and unknown customers: the rows and
    reasons are those of lookups on the joined lines."""
    lines = spark.createDataFrame(
        [(o, 1, 1, 2.0, 3.5, 0.1, 0.2, "2020-01-02 00:00:00") for o in (1, 1, 2, 3, 4, 9, None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate string").withColumn("l_shipdate", F.to_timestamp("l_shipdate"))
    orders = spark.createDataFrame(
        [(1, 5, "2020-01-01 10:00:00"), (2, None, None), (3, 77, "2021-05-05 00:00:00"), (4, 5, "2020-01-01 00:00:00"),
         (4, 6, "2020-01-02 00:00:00"), (None, 5, None)],
        "o_orderkey long, o_custkey long, o_orderdate string").withColumn("o_orderdate", F.to_timestamp("o_orderdate"))
    dims = {"dim_part": spark.createDataFrame([(1, 1)], "sk_part long, part_id long"),
            "dim_supplier": spark.createDataFrame([(1, 1)], "sk_supplier long, supplier_id long"),
            "dim_customer": spark.createDataFrame([(11, 5), (12, 6)], "sk_customer long, customer_id long"),
            "dim_date": spark.sql("SELECT 1L AS sk_date, DATE'2020-01-01' AS date_value "
                                  "UNION ALL SELECT 2L, DATE'2020-01-02'")}
    spec, sources = spec_by_name("fact_lineitem", KEEP), {"lineitem": lines, "orders": orders}
    early = mapped_rows(spec, sources, dims)
    assert {"__ahead_sk_customer", "__ahead_sk_order_date"} <= set(early.columns)
    got = plan_table(spec, early, dims, source_col="source").df
    want = plan_table(spec, mapped_rows(spec, sources), dims, source_col="source").df
    assert sorted(got.columns) == sorted(want.columns)
    assert (sorted(map(str, got.select(*sorted(got.columns)).collect()))
            == sorted(map(str, want.select(*sorted(got.columns)).collect())))
    assert sorted(r.sk_customer for r in got.collect()) == [-1, -1, -1, -1, 11, 11, 11, 12]
    absent = {**dims, "dim_customer": None}
    assert {r.sk_customer for r in plan_table(spec, mapped_rows(spec, sources, absent), absent).df.collect()} == {-1}
