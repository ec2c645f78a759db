"""Every registered query that has DuckDB SQL against it (sf 0.001 here; the
driver runs the same comparison at sf 0.01, see tools/compare.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from starload.plans.registry import QUERIES
from tools.compare import TABLES, digest

from locations import SF_SMALL

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_warehouse_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:5] == ["sk_part", "sk_supplier", "sk_customer", "sk_order_date", "sk_ship_date"]


def test_chunked_listagg_matches_sql_with_small_chunks(spark, con):
    from starload.operators.nest import listagg_ordered

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = listagg_ordered(li, "l_orderkey", "l_partkey", ["l_linenumber", "l_partkey"], alias="part_keys",
                         chunk_size=2)
    sql = ("SELECT l_orderkey, chunk, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) "
           "AS part_keys FROM (SELECT *, CAST((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, "
           "l_partkey) - 1) // 2 AS BIGINT) AS chunk FROM lineitem) GROUP BY l_orderkey, chunk")
    cur = con.execute(sql)
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(orows) > con.execute("SELECT count(DISTINCT l_orderkey) FROM lineitem").fetchone()[0]
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
