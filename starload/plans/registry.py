"""Registered queries: one per operator of the inventory, each a Spark job
over the given tables (``queries()[name](spark, sf_dir) -> DataFrame``).

Null and orphan cases are injected deterministically because the test
tables contain neither: ``inj`` nulls a value where the row key is a
multiple of 7, ``orph`` moves a foreign key out of range where the row key
is a multiple of 11.  The same expressions appear in the DuckDB oracle.
Queries that write (read-back, appends, JSON, clustered layout, the full
load) write under the shared checkpoint root, in a fresh folder per call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from starload.functions.scalar import (cast_decimal, cast_strict, cast_try_default, ci_equals, fill_min_date,
                                       fill_text, fill_zero, flag_decode, iso_text, parse_date, split_array)
from starload.operators.dims import split_hierarchy
from starload.operators.discovery import fact_ranking, inclusion_dependencies, minimal_dependencies, minimal_keys
from starload.operators.keys import assign_surrogate_keys, assign_surrogate_keys_incremental
from starload.operators.layout import clustered_by_curve, clustered_write, layout_advice
from starload.operators.lookup import (date_lookup, dim_lookup, join_on_keys, missing_dim_default,
                                       semi_members)
from starload.operators.mapping import add_audit_column, conform_schema, fill_nulls, map_columns
from starload.operators.nest import collect_set_by_key, listagg_ordered, nest_children
from starload.operators.profile import (cluster_advice, distinct_counts, fk_containment, functional_dependency, infer_types,
                                        numeric_measures, table_profile)
from starload.operators.quality import (annotate_rejects, check_violations, count_checks, fk_orphans,
                                        not_null_check, null_key_check, self_fk_orphans, unique_check,
                                        unresolved_fk_check)
from starload.operators.reconcile import reconcile, reconcile_ranges, set_difference_counts
from starload.operators.statistics import batch_statistics, merge_statistics, report, row_length
from starload.plans.load import open_rejects, run_load
from starload.plans.spec import KEEP, REJECT, Lookup, TableSpec, build_table
from starload.plans.star import LOAD_TS, build_star, star_sources, star_specs
from starload.session import staging_path
from starload.sources.documents import read_documents, relations
from starload.sources.json_io import read_json, write_json
from starload.sources.published import Warehouse
from starload.sources.tables import read_table
from starload.sources.warehouse import append_by_name, append_new_only, read_back, write_table

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def inj(key: str, value: str) -> Column:
    """Null injection: value is NULL where ``key % 7 = 0``."""
    return F.when(F.col(key) % 7 == 0, F.lit(None)).otherwise(F.col(value))


def orph(key: str, fk: str) -> Column:
    """Orphan injection: fk moved out of range where ``key % 11 = 0``."""
    return F.when(F.col(key) % 11 == 0, F.col(fk) + 1000000).otherwise(F.col(fk))


def _customer_injected(spark, d) -> DataFrame:
    return _t(spark, d, "customer").select(
        "c_custkey", inj("c_custkey", "c_name").alias("c_name"), "c_nationkey",
        inj("c_custkey", "c_acctbal").alias("c_acctbal"), inj("c_custkey", "c_mktsegment").alias("c_mktsegment"))


def _nation_dim(spark, d) -> DataFrame:
    return assign_surrogate_keys(_t(spark, d, "nation").select("n_nationkey"), "n_nationkey", sk="sk_nation")


# ---------------------------------------------------------------- 2.1 sources and sinks

def q_dim_readback(spark, d):
    path = staging_path(spark, "dim_customer")
    write_table(build_star(star_sources(spark, d), ["dim_customer"])["dim_customer"], path)
    return read_back(spark, path)


def q_append_by_name(spark, d):
    path = staging_path(spark, "customer_target")
    c = _t(spark, d, "customer")
    first = c.filter(F.col("c_nationkey") < 12).select(
        "c_custkey", "c_name", "c_mktsegment", F.lit(1).alias("batch"))
    write_table(first, path)
    # Reordered columns, c_mktsegment missing (-> null), one extra column (dropped).
    second = c.filter(F.col("c_nationkey") >= 12).select(
        F.lit(2).alias("batch"), "c_name", F.lit("x").alias("extra_note"), "c_custkey")
    append_by_name(second, path)
    return read_back(spark, path)


def q_snowflaked_chain(spark, d):
    root = staging_path(spark, "chain")
    specs = [s for s in star_specs() if s.target in ("dim_region", "dim_nation", "dim_customer")]
    run_load(spark, specs, star_sources(spark, d), root, LOAD_TS)
    customer = read_back(spark, f"{root}/dim_customer")
    nation = read_back(spark, f"{root}/dim_nation")
    # sk_region reached through the stored parent row.
    return dim_lookup(customer.select("customer_id", "sk_nation"), nation, "sk_nation", "sk_nation",
                      sk="sk_region", keep_fk=True).select("customer_id", "sk_nation", "sk_region")


# Children per output row of the nesting queries: a parent holding any share
# of the rows becomes several (parent, chunk) rows, never one unbounded row.
NEST_CHUNK = 10000


def q_nested_json(spark, d):
    return nest_children(_t(spark, d, "orders"), "o_custkey", "o_orderkey", ["o_orderkey", "o_orderstatus"],
                         alias="orders_json", as_json=True, chunk_size=NEST_CHUNK)


CUSTOMER_SCHEMA = StructType([
    StructField("c_custkey", LongType()), StructField("c_name", StringType()),
    StructField("c_nationkey", IntegerType()), StructField("c_acctbal", DoubleType()),
    StructField("c_mktsegment", StringType())])


def q_json_roundtrip(spark, d):
    path = staging_path(spark, "customer_json")
    write_json(_t(spark, d, "customer"), path)
    return read_json(spark, path, CUSTOMER_SCHEMA)


CATALOG = StructType([
    StructField("table_name", StringType()), StructField("batch", IntegerType()),
    StructField("rows", ArrayType(StructType([
        StructField("order_id", LongType()), StructField("customer", StructType([StructField("id", LongType())])),
        StructField("lines", ArrayType(StructType([
            StructField("line", IntegerType()), StructField("part_id", LongType())])))])))])


def q_document_relations(spark, d):
    """Orders with their lines as nested documents over many lines, a bounded
    number of orders to a document, read back and taken apart into relations."""
    path = staging_path(spark, "documents")
    fields = ["l_linenumber", "l_partkey"]
    lines = nest_children(_t(spark, d, "lineitem"), "l_orderkey", fields, fields, alias="lines", chunk_size=NEST_CHUNK)
    orders = (_t(spark, d, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
              .select(F.floor(F.col("o_orderkey") / 5000).cast("int").alias("batch"), F.struct(
                  F.col("o_orderkey").alias("order_id"), F.struct(F.col("o_custkey").alias("id")).alias("customer"),
                  F.transform("lines", lambda x: F.struct(x["l_linenumber"].alias("line"), x["l_partkey"].alias("part_id")))
                  .alias("lines")).alias("r")))
    documents = orders.groupBy("batch").agg(F.array_sort(F.collect_list("r")).alias("rows")).select(
        "batch", F.to_json(F.struct(F.lit("orders").alias("table_name"), "batch", "rows"), {"pretty": "true"}).alias("text"))
    documents.write.option("lineSep", "\n").partitionBy("batch").text(path)      # one document to a folder
    read, _ = read_documents(spark, f"{path}/*", CATALOG)
    found = relations(read, ["batch"], "orders")
    parents = found["orders.rows"].select("batch", "rows_pos", "order_id", F.col("customer.id").alias("customer_id"))
    return found["orders.rows.lines"].join(parents, ["batch", "rows_pos"]).select(
        "order_id", "customer_id", F.col("lines_pos").alias("position"), "line", "part_id")


# ---------------------------------------------------------------- 2.2 projection, filter

def q_map_columns(spark, d):
    return map_columns(_t(spark, d, "customer"), [("customer_id", "c_custkey"), ("customer_name", "c_name"),
                                                  ("nation_id", "c_nationkey"), ("segment", "c_mktsegment")])


def q_audit_column(spark, d):
    return add_audit_column(_t(spark, d, "customer").select("c_custkey", "c_name"), LOAD_TS)


PART_TARGET = StructType([
    StructField("part_id", LongType()), StructField("brand", StringType()), StructField("part_name", StringType()),
    StructField("size", LongType()), StructField("retail_price", DecimalType(10, 2)),
    StructField("part_type", StringType())])


def q_conform_schema(spark, d):
    mapped = map_columns(_t(spark, d, "part"), [("part_name", "p_name"), ("part_id", "p_partkey"),
                                                ("part_type", "p_type"), ("size", "p_size"),
                                                ("retail_price", "p_retailprice"), ("brand", "p_brand")])
    return conform_schema(mapped, PART_TARGET)


def q_missing_dim_default(spark, d):
    return missing_dim_default(_t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"),
                               "c_nationkey", "sk_nation")


def q_filter_not_like(spark, d):
    return _t(spark, d, "part").filter(~F.col("p_brand").like("Brand#1%")).select("p_partkey", "p_brand", "p_name")


def q_filter_params(spark, d):
    # Bound parameters, never string formatting of values into SQL text.
    return spark.sql(
        "SELECT o_orderkey, o_orderstatus, o_totalprice FROM {orders} "
        "WHERE o_orderstatus = :status AND o_totalprice >= :min_price",
        args={"status": "O", "min_price": 100000.0}, orders=_t(spark, d, "orders"))


def q_filter_ci(spark, d):
    return _t(spark, d, "customer").filter(ci_equals("c_mktsegment", "building")).select("c_custkey", "c_mktsegment")


# ---------------------------------------------------------------- 2.3 joins

def q_dim_lookup(spark, d):
    src = _t(spark, d, "customer").select("c_custkey", "c_name", orph("c_custkey", "c_nationkey").alias("c_nationkey"))
    return dim_lookup(src, _nation_dim(spark, d), "c_nationkey", "n_nationkey", sk="sk_nation")


def q_date_lookup(spark, d):
    dd = build_star(star_sources(spark, d), ["dim_date"], audit_col=None)["dim_date"]
    orders = _t(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return date_lookup(orders, dd, "o_orderdate", sk="sk_date")


def q_join_composite(spark, d):
    li = _t(spark, d, "lineitem")
    groups = li.groupBy(F.col("l_orderkey").alias("g_orderkey"), F.col("l_linenumber").alias("g_linenumber")).agg(
        F.count(F.lit(1)).alias("lines_in_group"),
        F.sum(cast_decimal("l_quantity", 12, 2)).cast(DecimalType(18, 2)).alias("group_quantity"))
    joined = join_on_keys(li.select("l_orderkey", "l_linenumber", "l_partkey"), groups,
                          ["l_orderkey", "l_linenumber"], ["g_orderkey", "g_linenumber"], split_hot=True)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "lines_in_group", "group_quantity")


def q_join_multiway_self(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = _t(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = _t(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nation = _t(spark, d, "nation")
    n1 = nation.select(F.col("n_nationkey").alias("n1_key"), F.col("n_name").alias("cust_nation"))
    n2 = nation.select(F.col("n_nationkey").alias("n2_key"), F.col("n_name").alias("supp_nation"))
    out = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
           .join(c, F.col("o_custkey") == c["c_custkey"])
           .join(n1, F.col("c_nationkey") == n1["n1_key"])
           .join(s, F.col("l_suppkey") == s["s_suppkey"])
           .join(n2, F.col("s_nationkey") == n2["n2_key"]))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "cust_nation", "supp_nation")


def q_semi_members(spark, d):
    returned = _t(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    return semi_members(_t(spark, d, "part").select("p_partkey", "p_name"), returned, "p_partkey", "l_partkey")


def q_append_new_only(spark, d):
    path = staging_path(spark, "orders_target")
    orders = _t(spark, d, "orders")
    first = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_orderstatus", F.lit(1).alias("load_batch"))
    write_table(first, path)
    append_new_only(orders.select("o_orderkey", "o_orderstatus", F.lit(2).alias("load_batch")), path, "o_orderkey")
    return read_back(spark, path)


# ---------------------------------------------------------------- 2.4 aggregation

def q_listagg_ordered(spark, d):
    return listagg_ordered(_t(spark, d, "lineitem"), "l_orderkey", "l_partkey", ["l_linenumber", "l_partkey"],
                           alias="part_keys", chunk_size=NEST_CHUNK)


def q_nest_children(spark, d):
    fields = ["l_linenumber", "l_partkey", "l_suppkey"]
    return nest_children(_t(spark, d, "lineitem"), "l_orderkey", fields, fields, alias="lines_json", as_json=True,
                         chunk_size=NEST_CHUNK)


def q_collect_set_by_key(spark, d):
    return collect_set_by_key(_t(spark, d, "lineitem"), "l_orderkey", "l_returnflag", alias="return_flags")


def q_table_profile(spark, d):
    return table_profile(_customer_injected(spark, d))


def _orders_with_nulls(spark, d) -> DataFrame:
    return _t(spark, d, "orders").select(
        "o_orderkey", "o_custkey", inj("o_orderkey", "o_orderstatus").alias("o_orderstatus"),
        inj("o_orderkey", "o_totalprice").alias("o_totalprice"), "o_orderdate", "o_orderpriority")


def _stored_statistics(spark, d) -> DataFrame:
    """Three batches of orders, each read once, their statistics stored."""
    path, orders = staging_path(spark, "statistics"), _orders_with_nulls(spark, d)
    for batch in range(3):
        batch_statistics(orders.filter(F.col("o_custkey") % 3 == batch)).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def q_merged_statistics(spark, d):
    """Merged statistics: the exact ones, and whether the estimates keep their bounds."""
    orders = _orders_with_nulls(spark, d)
    found = report(merge_statistics(_stored_statistics(spark, d)), quantiles=(0.5,), heavy=1)
    exact = distinct_counts(orders)
    medians = {r.column_name: r.quantiles[0] for r in found.filter(F.col("quantiles").isNotNull())
               .select("column_name", "quantiles").collect()}                 # one number per column
    below = orders.agg(*[F.try_divide(F.count_if(F.col(c) <= F.lit(m)), F.count(c)).alias(c)
                         for c, m in medians.items()]).unpivot([], list(medians), "column_name", "share")
    heavy, often = F.get("heavy_values", F.lit(0)), F.col("rows") / 100
    return (found.join(exact, "column_name").join(below, "column_name", "left")
            .withColumn("is_heavy", F.coalesce(heavy["count"] > often, F.lit(False))).select(
        "column_name", "rows", "nulls", "bytes", "average_length", "least", "largest", "first_text", "last_text",
        (F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= F.col("distinct_count") * 0.05)
        .alias("distinct_within"),
        (F.abs(F.col("share") - 0.5) <= 0.02).alias("median_within"),
        F.when(F.col("is_heavy"), heavy["item"]).alias("top_value"),
        F.when(F.col("is_heavy"), heavy["count"]).alias("top_count")))


def q_row_length(spark, d):
    return row_length(merge_statistics(_stored_statistics(spark, d)))


def q_fill_mean(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", inj("c_custkey", "c_acctbal").alias("acctbal"))
    return fill_nulls(c, {"acctbal": "mean"}).select("c_custkey", cast_decimal("acctbal", 12, 2).alias("acctbal"))


# ---------------------------------------------------------------- 2.5 sort, limit, set ops

def q_sort_multi(spark, d):
    order = [F.asc("o_orderpriority"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    rows = _t(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    # Every row with its place in the order, numbered without a single task.
    return assign_surrogate_keys(rows, order, sk="rnk", tiebreak=False, first=False)


def q_limit_one(spark, d):
    return (_t(spark, d, "part").filter(F.col("p_size") > 40).orderBy("p_partkey").limit(1)
            .select("p_partkey", "p_name", "p_size"))


def _customer_edited(spark, d) -> DataFrame:
    """Edited copy: nation 3 removed, MACHINERY balances +1."""
    c = _t(spark, d, "customer")
    return c.filter(F.col("c_nationkey") != 3).withColumn(
        "c_acctbal", F.when(F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))


def q_set_equality(spark, d):
    cols = ["c_custkey", "c_name", "c_acctbal"]
    return set_difference_counts(_t(spark, d, "customer").select(cols), _customer_edited(spark, d).select(cols))


# ---------------------------------------------------------------- 2.6 scalar functions

def q_fill_na_string(spark, d):
    return _t(spark, d, "customer").select("c_custkey", fill_text(inj("c_custkey", "c_mktsegment")).alias("segment"))


def q_fill_zero(spark, d):
    return _t(spark, d, "customer").select("c_custkey", fill_zero(inj("c_custkey", "c_acctbal"), "double").alias("acctbal"))


def q_fill_min_date(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", fill_min_date(inj("o_orderkey", "o_orderdate")).alias("order_date"))


def q_cast_decimal(spark, d):
    return _t(spark, d, "part").select("p_partkey", cast_decimal("p_retailprice", 10, 2).alias("price"))


def q_cast_strict(spark, d):
    return _t(spark, d, "customer").select(
        "c_custkey", cast_strict(F.regexp_extract("c_name", "[0-9]+", 0), "bigint").alias("name_number"))


def q_cast_try_default(spark, d):
    return _t(spark, d, "part").select(
        "p_partkey", cast_try_default("p_name", "int", -1).alias("name_as_int"),
        cast_try_default(F.col("p_size").cast("string"), "int", -1).alias("size_as_int"))


def q_parse_date(spark, d):
    text = iso_text("o_orderdate")
    return _t(spark, d, "orders").select("o_orderkey", parse_date(text, "yyyy-MM-dd").alias("order_day"),
                                         parse_date(text, "dd/MM/yyyy").alias("bad_format"))


def q_flag_decode(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", flag_decode("o_orderstatus", ["F"]).alias("is_final"),
                                         flag_decode("o_orderstatus", ["O"]).alias("is_open"))


def q_split_array(spark, d):
    return _t(spark, d, "part").select("p_partkey", F.posexplode(split_array("p_name", " ")).alias("pos", "word"))


def q_iso_text(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", iso_text("o_orderdate").alias("order_date_text"))


# ---------------------------------------------------------------- 2.7 data quality

def q_null_key_check(spark, d):
    c = _t(spark, d, "customer").select(inj("c_custkey", "c_custkey").alias("c_custkey"))
    return null_key_check(c, "c_custkey")


def q_unresolved_fk_check(spark, d):
    return unresolved_fk_check(q_dim_lookup(spark, d), ["sk_nation"])


def _fact(sources, on_missing: str = KEEP) -> DataFrame:
    # No fail-mode rule: nothing to observe, so nothing is materialised.
    return build_star(sources, ["fact_lineitem"], on_missing=on_missing, materialize_facts=False)["fact_lineitem"]


def q_qc_single_pass(spark, d):
    """Parts beyond the part table and suppliers without a key are injected, so
    that the unresolved counts have something to count."""
    sources = dict(star_sources(spark, d))
    sources["lineitem"] = (sources["lineitem"].withColumn("l_partkey", orph("l_orderkey", "l_partkey"))
                           .withColumn("l_suppkey", inj("l_orderkey", "l_suppkey")))
    fact = _fact(sources)
    sks = ["sk_part", "sk_supplier", "sk_customer", "sk_order_date", "sk_ship_date"]
    checks = {f"unresolved_{c}": F.col(c) == -1 for c in sks}
    checks["nonpositive_quantity"] = F.col("quantity") <= 0
    # Date keys follow date order, so this is "shipped before ordered".
    checks["ship_before_order"] = F.col("sk_ship_date") < F.col("sk_order_date")
    return count_checks(fact, checks)


def q_reject_split(spark, d):
    src = _t(spark, d, "customer").select(
        "c_custkey", inj("c_custkey", "c_name").alias("c_name"), orph("c_custkey", "c_nationkey").alias("c_nationkey"))
    looked = dim_lookup(src, _nation_dim(spark, d), "c_nationkey", "n_nationkey", sk="sk_nation",
                        status_col="nation_status")
    annotated = annotate_rejects(looked, {"null_name": F.col("c_name").isNull(),
                                          "unknown_nation": F.col("nation_status") != "found"})
    return annotated.select(
        "c_custkey",
        F.when(F.size("reject_reasons") == 0, F.lit("valid")).otherwise(F.lit("rejected")).alias("verdict"),
        F.array_join("reject_reasons", ",").alias("reasons"))


def q_unique_check(spark, d):
    return unique_check(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_not_null_check(spark, d):
    return not_null_check(_customer_injected(spark, d))


def q_fk_orphans(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", orph("o_orderkey", "o_custkey").alias("o_custkey"))
    return fk_orphans(orders, _t(spark, d, "customer"), "o_custkey", "c_custkey")


def q_check_violations(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderdate")
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"]).drop("o_orderkey")
    return check_violations(joined, "l_shipdate >= o_orderdate")


def q_fact_key_unique(spark, d):
    """Every fiftieth order's lines come twice."""
    sources = dict(star_sources(spark, d))
    li = sources["lineitem"]
    sources["lineitem"] = li.unionByName(li.filter(F.col("l_orderkey") % 50 == 0))
    return unique_check(_fact(sources), ["sk_part", "sk_supplier", "sk_customer", "sk_order_date", "sk_ship_date"])


def q_self_fk_orphans(spark, d):
    c = _t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") + 100).alias("manager_id"))
    return self_fk_orphans(c, "c_custkey", "manager_id")


def _customer_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    c = _t(spark, d, "customer")
    extra = c.filter(F.col("c_nationkey") == 5).withColumn("c_custkey", F.col("c_custkey") + 10000000)
    return c.select(cols), _customer_edited(spark, d).select(cols).unionByName(extra.select(cols))


def q_reconcile(spark, d):
    return reconcile(*_customer_sides(spark, d), "c_custkey")


def q_reconcile_ranges(spark, d):
    return reconcile_ranges(*_customer_sides(spark, d), "c_custkey")


def q_reconcile_ranges_few(spark, d):
    """Orders against a copy in which a short run of keys changed: most ranges agree."""
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    orders = _t(spark, d, "orders").select(cols)
    run = F.col("o_orderkey").between(1000, 1200)
    target = (orders.filter(~(run & (F.col("o_orderkey") % 5 == 0)))
              .withColumn("o_totalprice", F.when(run & (F.col("o_orderkey") % 5 == 1), F.col("o_totalprice") + 1)
                          .otherwise(F.col("o_totalprice"))))
    return reconcile_ranges(orders, target, "o_orderkey")


# ---------------------------------------------------------------- 2.8 modelling and load

def q_surrogate_key(spark, d):
    return assign_surrogate_keys(_t(spark, d, "orders").select("o_orderkey"), "o_orderkey", sk="sk_order")


def q_surrogate_key_incremental(spark, d):
    orders = _t(spark, d, "orders")
    first = assign_surrogate_keys(
        orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey"),
        "o_orderkey", sk="sk_order")
    added = assign_surrogate_keys_incremental(orders.select("o_orderkey"), first, "o_orderkey", sk="sk_order")
    return first.unionByName(added)


def q_date_dim(spark, d):
    return build_star(star_sources(spark, d), ["dim_date"], audit_col=None)["dim_date"]


def _dim(name: str) -> Query:
    def q(spark, d):
        return build_star(star_sources(spark, d), [name])[name]
    q.__name__ = f"q_{name}"
    return q


def q_fact_load(spark, d):
    return build_star(star_sources(spark, d), ["fact_lineitem"])["fact_lineitem"]


def q_split_hierarchy(spark, d):
    _, child = split_hierarchy(_t(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand"], "sk_brand")
    return child


def q_split_hierarchy_nulls(spark, d):
    """Two attributes, one partly null: the parent dimension and the child."""
    part = _t(spark, d, "part").select("p_partkey", "p_type", F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand"))
                                       .alias("p_brand"))
    parent, child = split_hierarchy(part, ["p_brand", "p_type"], "sk_kind")
    return child.select(F.lit("child").alias("side"), "p_partkey", "sk_kind").unionByName(
        parent.withColumn("side", F.lit("parent")), allowMissingColumns=True)


def q_dim_key_verdicts(spark, d):
    """Every source row of a dimension with injected null keys, conflicting rows
    of one key and exact duplicates: its key, or why it was rejected."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    source = (c.withColumn("c_custkey", F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")))
              .unionByName(c.filter(F.col("c_custkey") % 40 == 1).withColumn("c_name", F.concat("c_name", F.lit(" (2)"))))
              .unionByName(c.filter(F.col("c_custkey") % 40 == 3)))
    spec = TableSpec("dim_customer", "customer", [("customer_id", "c_custkey"), ("customer_name", "c_name")],
                     business_key=["customer_id"], sk="sk_customer", on_null_key=REJECT, on_duplicate_key=REJECT)
    valid, rejected = build_table(spec, {"customer": source}, {}, audit_col=None)
    return valid.withColumn("verdict", F.lit("valid")).unionByName(
        rejected.withColumn("verdict", F.element_at("reject_reasons", 1)).drop("reject_reasons"),
        allowMissingColumns=True)


FD_PAIRS = [("nation", "n_nationkey", "n_name"), ("nation", "n_regionkey", "n_name"),
            ("part", "p_partkey", "p_name"), ("part", "p_name", "p_brand"), ("part", "p_brand", "p_type")]


def q_functional_dependency(spark, d):
    out = None
    for table, det, dep in FD_PAIRS:
        r = functional_dependency(_t(spark, d, table), det, dep).select(
            F.lit(table).alias("table_name"), F.lit(det).alias("determinant"), F.lit(dep).alias("dependent"),
            "violating_groups", "holds")
        out = r if out is None else out.unionByName(r)
    return out


def q_infer_types(spark, d):
    return infer_types(_t(spark, d, "customer"))


FK_CANDIDATES = [("orders", "o_custkey", "customer", "c_custkey"),
                 ("lineitem", "l_orderkey", "orders", "o_orderkey"),
                 ("lineitem", "l_partkey", "part", "p_partkey"),
                 ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
                 ("customer", "c_nationkey", "nation", "n_nationkey"),
                 ("supplier", "s_nationkey", "nation", "n_nationkey"),
                 ("nation", "n_regionkey", "region", "r_regionkey"),
                 ("part", "p_size", "nation", "n_nationkey"),
                 ("customer", "c_custkey", "supplier", "s_suppkey")]


def q_fk_containment(spark, d):
    out = None
    for ct, cc, pt, pc in FK_CANDIDATES:
        r = fk_containment(_t(spark, d, ct), cc, _t(spark, d, pt), pc).select(
            F.lit(ct).alias("child_table"), F.lit(cc).alias("child_column"), F.lit(pt).alias("parent_table"),
            F.lit(pc).alias("parent_column"), "distinct_child", "contained", "ratio")
        out = r if out is None else out.unionByName(r)
    return out


STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def q_fact_candidates(spark, d):
    contained = q_fk_containment(spark, d).groupBy(F.col("child_table").alias("table_name")).agg(
        F.count_if(F.col("ratio") == 1.0).alias("contained_fks"))
    # Measure counts come from each table's schema (metadata, one row per table).
    measures = spark.createDataFrame(
        [(t, len(numeric_measures(_t(spark, d, t)))) for t in STAR_TABLES], "table_name string, numeric_measures int")
    ranked = measures.join(contained, "table_name", "left").select(
        "table_name", F.col("numeric_measures").cast("bigint").alias("numeric_measures"),
        F.coalesce(F.col("contained_fks"), F.lit(0)).cast("bigint").alias("contained_fks"))
    w = Window.orderBy(F.desc("contained_fks"), F.desc("numeric_measures"), F.asc("table_name"))
    return ranked.withColumn("rnk", F.row_number().over(w).cast("bigint"))


def _tables(spark, d, names) -> dict[str, DataFrame]:
    return {t: _t(spark, d, t) for t in names}


def q_inclusion_dependencies(spark, d):
    return inclusion_dependencies(_tables(spark, d, STAR_TABLES))


def q_fact_ranking(spark, d):
    return fact_ranking(_tables(spark, d, STAR_TABLES))


KEY_TABLES = ("customer", "part", "lineitem")


def q_minimal_keys(spark, d):
    """Minimal keys of up to three columns; lines are numbered within their
    order by nothing but the data, so several combinations qualify."""
    out = None
    for table in KEY_TABLES:
        keys = minimal_keys(_t(spark, d, table)).select(F.lit(table).alias("table_name"), "*")
        out = keys if out is None else out.unionByName(keys)
    return out


def q_minimal_dependencies(spark, d):
    out = None
    for table in ("part", "customer", "supplier", "nation"):
        found = minimal_dependencies(_t(spark, d, table)).select(F.lit(table).alias("table_name"), "*")
        out = found if out is None else out.unionByName(found)
    return out


def q_cluster_advice(spark, d):
    return cluster_advice(_t(spark, d, "orders"))


def q_clustered_write(spark, d):
    path = staging_path(spark, "lineitem_by_shipdate")
    clustered_write(_t(spark, d, "lineitem"), path, "l_shipdate")
    return spark.read.parquet(path)


CURVE = ("l_shipdate", "l_partkey")


def q_curve_write(spark, d):
    """Lines stored along the curve, as many rows as before."""
    path = staging_path(spark, "lineitem_by_curve")
    clustered_by_curve(_t(spark, d, "lineitem"), CURVE, 32).write.parquet(path)
    return spark.read.parquet(path)


def q_layout_advice(spark, d):
    """One column each, and both along the curve: which filters skip half of the
    files at least, and which layout comes first."""
    li = _t(spark, d, "lineitem")
    found = layout_advice(li, [[CURVE[0]], [CURVE[1]], CURVE], CURVE)
    return found.select("layout", "column_name", (F.col("skipped_share") >= 0.5).alias("skips_half"),
                        (F.col("rnk") == 1).alias("advised"))


def q_run_load(spark, d):
    root = staging_path(spark, "warehouse")
    sources = star_sources(spark, d)
    run_load(spark, star_specs(), sources, root, LOAD_TS)
    return run_load(spark, star_specs(), sources, root, LOAD_TS)


def _replay_specs() -> list[TableSpec]:
    return [
        TableSpec("dim_buyer", "customer", [("customer_id", "c_custkey")], business_key=["customer_id"], sk="sk_buyer"),
        TableSpec("fact_order", "orders", [("order_id", "o_orderkey"), ("customer_id", "o_custkey"),
                                           ("total", cast_decimal("o_totalprice", 12, 2))], kind="fact",
                  lookups=[Lookup(["customer_id"], "dim_buyer", ["customer_id"], "sk_buyer", on_missing=REJECT)])]


def q_reject_replay(spark, d):
    """Two batches of orders and customers and the first batch again: an order
    whose customer comes later waits among the rejects and is then loaded; an
    order of a customer that never comes stays there."""
    root, specs = staging_path(spark, "replay"), _replay_specs()
    customer = _t(spark, d, "customer")
    orders = _t(spark, d, "orders").withColumn("o_custkey", orph("o_orderkey", "o_custkey"))
    early = F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    first = {"customer": customer.filter(F.col("c_custkey") % 3 != 0), "orders": orders.filter(early)}
    second = {"customer": customer.filter(F.col("c_custkey") % 3 == 0), "orders": orders.filter(~early)}
    for batch, sources in (("b1", first), ("b2", second), ("b1", first)):
        run_load(spark, specs, sources, root, audit_col=None, batch_id=batch)
    loaded = read_back(spark, f"{root}/fact_order").select(
        "order_id", "sk_buyer", "total", "load_batch", F.lit("loaded").alias("state"))
    waiting = open_rejects(Warehouse(spark, root), specs[1])
    return loaded.unionByName(waiting.select(
        F.col("source_row.order_id").alias("order_id"), F.lit(-1).cast("bigint").alias("sk_buyer"),
        F.col("source_row.total").alias("total"), "load_batch", F.lit("waiting").alias("state")))


QUERIES: dict[str, Query] = {
    # 2.1
    "dim_readback": q_dim_readback, "append_by_name": q_append_by_name, "snowflaked_chain": q_snowflaked_chain,
    "nested_json": q_nested_json, "json_roundtrip": q_json_roundtrip,
    "document_relations": q_document_relations,
    # 2.2
    "map_columns": q_map_columns, "audit_column": q_audit_column, "conform_schema": q_conform_schema,
    "missing_dim_default": q_missing_dim_default, "filter_not_like": q_filter_not_like,
    "filter_params": q_filter_params, "filter_ci": q_filter_ci,
    # 2.3
    "dim_lookup": q_dim_lookup, "date_lookup": q_date_lookup, "join_composite": q_join_composite,
    "join_multiway_self": q_join_multiway_self, "semi_members": q_semi_members, "append_new_only": q_append_new_only,
    # 2.4
    "listagg_ordered": q_listagg_ordered, "nest_children": q_nest_children,
    "collect_set_by_key": q_collect_set_by_key, "table_profile": q_table_profile,
    "merged_statistics": q_merged_statistics, "row_length": q_row_length, "fill_mean": q_fill_mean,
    # 2.5
    "sort_multi": q_sort_multi, "limit_one": q_limit_one, "set_equality": q_set_equality,
    # 2.6
    "fill_na_string": q_fill_na_string, "fill_zero": q_fill_zero, "fill_min_date": q_fill_min_date,
    "cast_decimal": q_cast_decimal, "cast_strict": q_cast_strict, "cast_try_default": q_cast_try_default,
    "parse_date": q_parse_date, "flag_decode": q_flag_decode, "split_array": q_split_array, "iso_text": q_iso_text,
    # 2.7
    "null_key_check": q_null_key_check, "unresolved_fk_check": q_unresolved_fk_check,
    "qc_single_pass": q_qc_single_pass, "reject_split": q_reject_split, "unique_check": q_unique_check,
    "not_null_check": q_not_null_check, "fk_orphans": q_fk_orphans, "check_violations": q_check_violations,
    "fact_key_unique": q_fact_key_unique, "self_fk_orphans": q_self_fk_orphans, "reconcile": q_reconcile,
    "reconcile_ranges": q_reconcile_ranges, "reconcile_ranges_few": q_reconcile_ranges_few,
    # 2.8
    "surrogate_key": q_surrogate_key, "surrogate_key_incremental": q_surrogate_key_incremental,
    "date_dim": q_date_dim, "dim_region": _dim("dim_region"), "dim_nation": _dim("dim_nation"),
    "dim_part": _dim("dim_part"), "dim_customer": _dim("dim_customer"), "dim_supplier": _dim("dim_supplier"),
    "fact_load": q_fact_load, "split_hierarchy": q_split_hierarchy,
    "split_hierarchy_nulls": q_split_hierarchy_nulls, "dim_key_verdicts": q_dim_key_verdicts,
    "functional_dependency": q_functional_dependency, "infer_types": q_infer_types,
    "minimal_dependencies": q_minimal_dependencies, "minimal_keys": q_minimal_keys,
    "inclusion_dependencies": q_inclusion_dependencies, "fact_ranking": q_fact_ranking,
    "fk_containment": q_fk_containment, "fact_candidates": q_fact_candidates, "cluster_advice": q_cluster_advice,
    "curve_write": q_curve_write, "layout_advice": q_layout_advice,
    "clustered_write": q_clustered_write, "run_load": q_run_load, "reject_replay": q_reject_replay,
}
