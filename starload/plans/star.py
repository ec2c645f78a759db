"""The stand-in star schema on the driver's test tables.

region -> dim_region; nation -> dim_nation (parent region); customer and
supplier -> dims (parent nation; supplier keeps its natural nation key);
part -> dim_part (decimal casts); o_orderdate + l_shipdate -> dim_date;
lineitem joined to orders -> fact_lineitem (keys of part, supplier,
customer, order date, ship date; decimal measures).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StructField, StructType

from starload.functions.scalar import MIN_DATE, cast_decimal
from starload.plans.spec import AHEAD, FAIL, KEEP, Lookup, TableSpec, build_table, dependency_levels, run_level
from starload.sources.tables import read_tables

# Fixed audit timestamp so results are repeatable and comparable.
LOAD_TS = "2024-01-01 00:00:00"

STAR_SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def star_sources(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return read_tables(spark, sf_dir, STAR_SOURCES)


def _dates(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Dates that occur in the data (order and ship dates), each input
    reduced to its distinct dates before the union; null -> 1900-01-01."""
    def one(df: DataFrame, col: str) -> DataFrame:
        return df.select(F.coalesce(F.to_date(F.col(col)), F.lit(MIN_DATE).cast("date")).alias("date_value")).distinct()
    return one(sources["orders"], "o_orderdate").unionByName(one(sources["lineitem"], "l_shipdate"))


def _lines_with_orders(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Fact source: every line with its order's customer and date.  A left
    join, so a line without an order still reaches the checks.  Keys looked up on
    the orders come along."""
    ahead = [c for c in sources["orders"].columns if c.startswith(AHEAD)]
    li = sources["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                                    "l_discount", "l_tax", "l_shipdate")
    o = sources["orders"].select("o_orderkey", "o_custkey", "o_orderdate", *ahead)
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "left")


FACT_SCHEMA = StructType([
    StructField("sk_part", LongType()), StructField("sk_supplier", LongType()),
    StructField("sk_customer", LongType()), StructField("sk_order_date", LongType()),
    StructField("sk_ship_date", LongType()),
    StructField("quantity", DecimalType(12, 2)), StructField("extended_price", DecimalType(12, 2)),
    StructField("discount", DecimalType(4, 2)), StructField("tax", DecimalType(4, 2)),
])


def star_specs(on_missing: str = FAIL, dim_on_missing: str = KEEP) -> list[TableSpec]:
    """The star's specs.  As in the reference, a dimension stores the
    unknown member (-1) for a parent it cannot resolve (``dim_on_missing``),
    while the fact's lookups use ``on_missing`` (fail by default)."""
    text_fill = "na"
    return [
        TableSpec("dim_region", "region",
                  [("region_id", "r_regionkey"), ("region_name", "r_name")],
                  business_key=["region_id"], sk="sk_region", fill={"region_name": text_fill}),
        TableSpec("dim_nation", "nation",
                  [("nation_id", "n_nationkey"), ("nation_name", "n_name"), ("region_id", "n_regionkey")],
                  business_key=["nation_id"], sk="sk_nation", fill={"nation_name": text_fill},
                  lookups=[Lookup(["region_id"], "dim_region", ["region_id"], "sk_region",
                                  on_missing=dim_on_missing, dim_sk="sk_region")]),
        TableSpec("dim_customer", "customer",
                  [("customer_id", "c_custkey"), ("customer_name", "c_name"), ("segment", "c_mktsegment"),
                   ("acctbal", cast_decimal("c_acctbal", 12, 2)), ("nation_id", "c_nationkey")],
                  business_key=["customer_id"], sk="sk_customer",
                  fill={"customer_name": text_fill, "segment": text_fill, "acctbal": "zero"},
                  lookups=[Lookup(["nation_id"], "dim_nation", ["nation_id"], "sk_nation",
                                  on_missing=dim_on_missing, dim_sk="sk_nation")]),
        TableSpec("dim_supplier", "supplier",
                  [("supplier_id", "s_suppkey"), ("supplier_name", "s_name"),
                   ("acctbal", cast_decimal("s_acctbal", 12, 2)), ("nation_id", "s_nationkey")],
                  business_key=["supplier_id"], sk="sk_supplier",
                  fill={"supplier_name": text_fill, "acctbal": "zero"},
                  lookups=[Lookup(["nation_id"], "dim_nation", ["nation_id"], "sk_nation",
                                  on_missing=dim_on_missing, dim_sk="sk_nation")],
                  keep_natural=["nation_id"]),
        TableSpec("dim_part", "part",
                  [("part_id", "p_partkey"), ("part_name", "p_name"), ("brand", "p_brand"),
                   ("part_type", "p_type"), ("size", "p_size"),
                   ("retail_price", cast_decimal("p_retailprice", 10, 2))],
                  business_key=["part_id"], sk="sk_part",
                  fill={"part_name": text_fill, "brand": text_fill, "part_type": text_fill,
                        "size": "zero", "retail_price": "zero"}),
        TableSpec("dim_date", _dates,
                  [("date_value", "date_value"), ("day", F.dayofmonth("date_value")),
                   ("month", F.month("date_value")), ("year", F.year("date_value"))],
                  business_key=["date_value"], sk="sk_date"),
        TableSpec("fact_lineitem", _lines_with_orders,
                  [("part_id", "l_partkey"), ("supplier_id", "l_suppkey"), ("customer_id", "o_custkey"),
                   ("order_date", "o_orderdate"), ("ship_date", "l_shipdate"),
                   ("quantity", cast_decimal("l_quantity", 12, 2)),
                   ("extended_price", cast_decimal("l_extendedprice", 12, 2)),
                   ("discount", cast_decimal("l_discount", 4, 2)), ("tax", cast_decimal("l_tax", 4, 2))],
                  kind="fact",
                  fill={"quantity": "zero", "extended_price": "zero", "discount": "zero", "tax": "zero"},
                  lookups=[Lookup(["part_id"], "dim_part", ["part_id"], "sk_part", on_missing=on_missing),
                           Lookup(["supplier_id"], "dim_supplier", ["supplier_id"], "sk_supplier",
                                  on_missing=on_missing),
                           Lookup(["customer_id"], "dim_customer", ["customer_id"], "sk_customer",
                                  on_missing=on_missing, at=("orders", "o_custkey")),
                           Lookup(["order_date"], "dim_date", ["date_value"], "sk_order_date", date=True,
                                  on_missing=on_missing, at=("orders", "o_orderdate")),
                           Lookup(["ship_date"], "dim_date", ["date_value"], "sk_ship_date", date=True,
                                  on_missing=on_missing)],
                  schema=FACT_SCHEMA),
    ]


def spec_by_name(name: str, on_missing: str = FAIL) -> TableSpec:
    return next(s for s in star_specs(on_missing) if s.target == name)


def build_star(sources: Mapping[str, DataFrame], targets: list[str] | None = None, load_ts: str | None = LOAD_TS,
               audit_col: str | None = "dt_insert", on_missing: str = FAIL,
               materialize_facts: bool = True, parallelism: int = 4) -> dict[str, DataFrame]:
    """Plan the star in memory (no warehouse writes): each table sees its
    parents' planned frames.  Only the tables needed for ``targets`` are
    built.  ``materialize_facts`` evaluates a fact once into a checkpoint
    with its checks observed on the way, instead of a check job followed by
    a second evaluation."""
    specs = {s.target: s for s in star_specs(on_missing)}
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name in wanted:
            return
        wanted.add(name)
        for p in specs[name].parents:
            need(p)

    for t in targets or list(specs):
        need(t)
    built: dict[str, DataFrame] = {}

    def one(spec: TableSpec) -> tuple[str, DataFrame]:
        parents = {p: built[p] for p in spec.parents}
        df, _ = build_table(spec, sources, parents, load_ts, audit_col,
                            materialize_checked=materialize_facts and spec.kind == "fact")
        return spec.target, df

    # Independent tables of a level are built on concurrent driver threads.
    for level in dependency_levels([specs[n] for n in wanted]):
        built.update(run_level(one, level, parallelism))
    return built
