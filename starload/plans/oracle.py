"""DuckDB SQL equal to each registered query (the correctness oracle).

Surrogate keys are ``row_number() over (order by key)`` cast to BIGINT;
DuckDB's day/month/year are BIGINT and are cast to INTEGER like Spark's.
"""

from __future__ import annotations

from itertools import combinations

INJ = "CASE WHEN {key} % 7 = 0 THEN NULL ELSE {value} END"
ORPH = "CASE WHEN {key} % 11 = 0 THEN {fk} + 1000000 ELSE {fk} END"


def inj(key: str, value: str) -> str:
    return INJ.format(key=key, value=value)


def orph(key: str, fk: str) -> str:
    return ORPH.format(key=key, fk=fk)


LOAD_TS_SQL = "TIMESTAMP '2024-01-01 00:00:00'"

CUSTOMER_INJ = (f"SELECT c_custkey, {inj('c_custkey', 'c_name')} AS c_name, c_nationkey, "
                f"{inj('c_custkey', 'c_acctbal')} AS c_acctbal, {inj('c_custkey', 'c_mktsegment')} AS c_mktsegment "
                "FROM customer")

DIM_REGION = ("SELECT CAST(row_number() OVER (ORDER BY r_regionkey) AS BIGINT) AS sk_region, "
              "r_regionkey AS region_id, COALESCE(r_name, 'N/A') AS region_name FROM region")

DIM_NATION = (f"SELECT CAST(row_number() OVER (ORDER BY n.n_nationkey) AS BIGINT) AS sk_nation, "
              f"n.n_nationkey AS nation_id, COALESCE(n.n_name, 'N/A') AS nation_name, "
              f"COALESCE(r.sk_region, -1) AS sk_region FROM nation n LEFT JOIN ({DIM_REGION}) r "
              f"ON n.n_regionkey = r.region_id")

DIM_CUSTOMER = (f"SELECT CAST(row_number() OVER (ORDER BY c.c_custkey) AS BIGINT) AS sk_customer, "
                f"c.c_custkey AS customer_id, COALESCE(c.c_name, 'N/A') AS customer_name, "
                f"COALESCE(c.c_mktsegment, 'N/A') AS segment, "
                f"COALESCE(CAST(c.c_acctbal AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2))) AS acctbal, "
                f"COALESCE(n.sk_nation, -1) AS sk_nation "
                f"FROM customer c LEFT JOIN ({DIM_NATION}) n ON c.c_nationkey = n.nation_id")

DIM_SUPPLIER = (f"SELECT CAST(row_number() OVER (ORDER BY s.s_suppkey) AS BIGINT) AS sk_supplier, "
                f"s.s_suppkey AS supplier_id, COALESCE(s.s_name, 'N/A') AS supplier_name, "
                f"COALESCE(CAST(s.s_acctbal AS DECIMAL(12,2)), CAST(0 AS DECIMAL(12,2))) AS acctbal, "
                f"s.s_nationkey AS nation_id, COALESCE(n.sk_nation, -1) AS sk_nation "
                f"FROM supplier s LEFT JOIN ({DIM_NATION}) n ON s.s_nationkey = n.nation_id")

DIM_PART = ("SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS sk_part, p_partkey AS part_id, "
            "COALESCE(p_name, 'N/A') AS part_name, COALESCE(p_brand, 'N/A') AS brand, "
            "COALESCE(p_type, 'N/A') AS part_type, COALESCE(p_size, 0) AS size, "
            "COALESCE(CAST(p_retailprice AS DECIMAL(10,2)), CAST(0 AS DECIMAL(10,2))) AS retail_price FROM part")

DATES = ("SELECT DISTINCT COALESCE(CAST(o_orderdate AS DATE), DATE '1900-01-01') AS date_value FROM orders "
         "UNION SELECT DISTINCT COALESCE(CAST(l_shipdate AS DATE), DATE '1900-01-01') FROM lineitem")

DIM_DATE = (f"SELECT CAST(row_number() OVER (ORDER BY date_value) AS BIGINT) AS sk_date, date_value, "
            f"CAST(day(date_value) AS INTEGER) AS day, CAST(month(date_value) AS INTEGER) AS month, "
            f"CAST(year(date_value) AS INTEGER) AS year FROM ({DATES})")


NEST_CHUNK = 10000


def _chunk(parent: str, order: str) -> str:
    """Chunk of a child within its parent: position // NEST_CHUNK."""
    return f"CAST((row_number() OVER (PARTITION BY {parent} ORDER BY {order}) - 1) // {NEST_CHUNK} AS BIGINT)"


def _audit(select: str) -> str:
    return f"SELECT *, {LOAD_TS_SQL} AS dt_insert FROM ({select})"


def _dec(col: str, p: int, s: int) -> str:
    return f"COALESCE(CAST({col} AS DECIMAL({p},{s})), CAST(0 AS DECIMAL({p},{s})))"


def fact(lineitem: str = "lineitem") -> str:
    return (f"SELECT COALESCE(dp.sk_part, -1) AS sk_part, COALESCE(ds.sk_supplier, -1) AS sk_supplier, "
            f"COALESCE(dc.sk_customer, -1) AS sk_customer, COALESCE(d1.sk_date, -1) AS sk_order_date, "
            f"COALESCE(d2.sk_date, -1) AS sk_ship_date, "
            f"{_dec('src.l_quantity', 12, 2)} AS quantity, {_dec('src.l_extendedprice', 12, 2)} AS extended_price, "
            f"{_dec('src.l_discount', 4, 2)} AS discount, {_dec('src.l_tax', 4, 2)} AS tax "
            f"FROM (SELECT l.*, o.o_custkey, o.o_orderdate FROM {lineitem} l LEFT JOIN orders o "
            f"ON l.l_orderkey = o.o_orderkey) src "
            f"LEFT JOIN ({DIM_PART}) dp ON src.l_partkey = dp.part_id "
            f"LEFT JOIN ({DIM_SUPPLIER}) ds ON src.l_suppkey = ds.supplier_id "
            f"LEFT JOIN ({DIM_CUSTOMER}) dc ON src.o_custkey = dc.customer_id "
            f"LEFT JOIN ({DIM_DATE}) d1 ON CAST(src.o_orderdate AS DATE) = d1.date_value "
            f"LEFT JOIN ({DIM_DATE}) d2 ON CAST(src.l_shipdate AS DATE) = d2.date_value")


FACT = fact()
FACT_TWICE = fact("(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0)")
FACT_BROKEN = fact(f"(SELECT * REPLACE ({orph('l_orderkey', 'l_partkey')} AS l_partkey, "
                   f"{inj('l_orderkey', 'l_suppkey')} AS l_suppkey) FROM lineitem)")

NATION_SK = "SELECT n_nationkey, CAST(row_number() OVER (ORDER BY n_nationkey) AS BIGINT) AS sk_nation FROM nation"

DIM_LOOKUP = (f"SELECT s.c_custkey, s.c_name, COALESCE(dn.sk_nation, -1) AS sk_nation FROM "
              f"(SELECT c_custkey, c_name, {orph('c_custkey', 'c_nationkey')} AS c_nationkey FROM customer) s "
              f"LEFT JOIN ({NATION_SK}) dn ON s.c_nationkey = dn.n_nationkey")

CUSTOMER_EDITED = ("SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 "
                   "ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_nationkey <> 3")


def _profile() -> str:
    parts = []
    for col, numeric in (("c_custkey", False), ("c_name", False), ("c_nationkey", False),
                         ("c_acctbal", True), ("c_mktsegment", False)):
        def text(agg, c=col, n=numeric):
            return f"CAST(CAST({agg}({c}) AS DECIMAL(20,2)) AS VARCHAR)" if n else f"CAST({agg}({c}) AS VARCHAR)"
        parts.append(f"SELECT '{col}' AS column_name, count(*) AS rows, count(*) - count({col}) AS nulls, "
                     f"count(DISTINCT {col}) AS distinct_count, {text('min')} AS min_value, "
                     f"{text('max')} AS max_value FROM ({CUSTOMER_INJ})")
    return " UNION ALL ".join(parts)


def _not_null() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM ({CUSTOMER_INJ})"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))


def _functional_dependency() -> str:
    pairs = [("nation", "n_nationkey", "n_name"), ("nation", "n_regionkey", "n_name"),
             ("part", "p_partkey", "p_name"), ("part", "p_name", "p_brand"), ("part", "p_brand", "p_type")]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{a}' AS determinant, '{b}' AS dependent, "
        f"count(*) FILTER (WHERE k > 1) AS violating_groups, count(*) FILTER (WHERE k > 1) = 0 AS holds "
        f"FROM (SELECT {a}, count(DISTINCT {b}) AS k FROM {t} GROUP BY {a})"
        for t, a, b in pairs)


FK_CANDIDATES = [("orders", "o_custkey", "customer", "c_custkey"),
                 ("lineitem", "l_orderkey", "orders", "o_orderkey"),
                 ("lineitem", "l_partkey", "part", "p_partkey"),
                 ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
                 ("customer", "c_nationkey", "nation", "n_nationkey"),
                 ("supplier", "s_nationkey", "nation", "n_nationkey"),
                 ("nation", "n_regionkey", "region", "r_regionkey"),
                 ("part", "p_size", "nation", "n_nationkey"),
                 ("customer", "c_custkey", "supplier", "s_suppkey")]


def _fk_containment() -> str:
    return " UNION ALL ".join(
        f"SELECT '{ct}' AS child_table, '{cc}' AS child_column, '{pt}' AS parent_table, '{pc}' AS parent_column, "
        f"count(*) AS distinct_child, count(pp.p) AS contained, CAST(count(pp.p) AS DOUBLE) / count(*) AS ratio "
        f"FROM (SELECT DISTINCT {cc} AS v FROM {ct} WHERE {cc} IS NOT NULL) cv "
        f"LEFT JOIN (SELECT DISTINCT {pc} AS p FROM {pt}) pp ON cv.v = pp.p"
        for ct, cc, pt, pc in FK_CANDIDATES)


# Numeric non-key (fractional) columns per table, read from the table schemas.
MEASURE_COUNTS = [("region", 0), ("nation", 0), ("customer", 1), ("supplier", 1), ("part", 1), ("orders", 1),
                  ("lineitem", 4)]


def _fact_candidates() -> str:
    values = ", ".join(f"('{t}', {n})" for t, n in MEASURE_COUNTS)
    return (f"WITH fc AS ({_fk_containment()}), m(table_name, numeric_measures) AS (VALUES {values}), "
            f"c AS (SELECT child_table AS table_name, count(*) FILTER (WHERE ratio = 1.0) AS contained_fks "
            f"FROM fc GROUP BY child_table), "
            f"r AS (SELECT m.table_name, CAST(m.numeric_measures AS BIGINT) AS numeric_measures, "
            f"CAST(COALESCE(c.contained_fks, 0) AS BIGINT) AS contained_fks FROM m LEFT JOIN c "
            f"ON m.table_name = c.table_name) "
            f"SELECT *, CAST(row_number() OVER (ORDER BY contained_fks DESC, numeric_measures DESC, table_name) "
            f"AS BIGINT) AS rnk FROM r")


ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _cluster_advice() -> str:
    dc = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM orders"
                            for c in ORDERS_COLS)
    return (f"WITH d AS ({dc}), n AS (SELECT count(*) AS rows FROM orders), "
            f"r AS (SELECT d.column_name, d.distinct_count, n.rows, "
            f"CAST(d.distinct_count AS DOUBLE) / n.rows AS ratio FROM d, n) "
            f"SELECT *, CAST(row_number() OVER (ORDER BY ratio DESC, column_name) AS BIGINT) AS rnk FROM r")


def _run_load() -> str:
    return " UNION ALL ".join([
        "SELECT 'dim_region' AS table_name, count(*) AS rows FROM region",
        "SELECT 'dim_nation', count(*) FROM nation",
        "SELECT 'dim_customer', count(*) FROM customer",
        "SELECT 'dim_supplier', count(*) FROM supplier",
        "SELECT 'dim_part', count(*) FROM part",
        f"SELECT 'dim_date', count(*) FROM ({DATES})",
        "SELECT 'fact_lineitem', count(*) FROM lineitem"])


ORACLE_SQL: dict[str, str] = {
    # 2.1
    "dim_readback": _audit(DIM_CUSTOMER),
    "append_by_name": ("SELECT c_custkey, c_name, CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS c_mktsegment, "
                       "CASE WHEN c_nationkey < 12 THEN 1 ELSE 2 END AS batch FROM customer"),
    "snowflaked_chain": (f"SELECT dc.customer_id, dc.sk_nation, COALESCE(dn.sk_region, -1) AS sk_region "
                         f"FROM ({DIM_CUSTOMER}) dc LEFT JOIN ({DIM_NATION}) dn ON dc.sk_nation = dn.sk_nation"),
    "nested_json": ("SELECT o_custkey, chunk, CAST(to_json(list({'o_orderkey': o_orderkey, "
                    "'o_orderstatus': o_orderstatus} ORDER BY o_orderkey)) AS VARCHAR) AS orders_json "
                    f"FROM (SELECT *, {_chunk('o_custkey', 'o_orderkey')} AS chunk FROM orders) "
                    "GROUP BY o_custkey, chunk"),
    "json_roundtrip": "SELECT * FROM customer",
    # 2.2
    "map_columns": ("SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id, "
                    "c_mktsegment AS segment FROM customer"),
    "audit_column": f"SELECT c_custkey, c_name, {LOAD_TS_SQL} AS dt_insert FROM customer",
    "conform_schema": ("SELECT CAST(p_partkey AS BIGINT) AS part_id, p_brand AS brand, p_name AS part_name, "
                       "CAST(p_size AS BIGINT) AS size, CAST(p_retailprice AS DECIMAL(10,2)) AS retail_price, "
                       "p_type AS part_type FROM part"),
    "missing_dim_default": "SELECT c_custkey, c_name, CAST(-1 AS BIGINT) AS sk_nation FROM customer",
    "filter_not_like": "SELECT p_partkey, p_brand, p_name FROM part WHERE p_brand NOT LIKE 'Brand#1%'",
    "filter_params": ("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders "
                      "WHERE o_orderstatus = 'O' AND o_totalprice >= 100000.0"),
    "filter_ci": "SELECT c_custkey, c_mktsegment FROM customer WHERE upper(c_mktsegment) = upper('building')",
    # 2.3
    "dim_lookup": DIM_LOOKUP,
    "date_lookup": (f"SELECT o.o_orderkey, o.o_totalprice, COALESCE(dd.sk_date, -1) AS sk_date FROM orders o "
                    f"LEFT JOIN ({DIM_DATE}) dd ON CAST(o.o_orderdate AS DATE) = dd.date_value"),
    "join_composite": ("SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, g.lines_in_group, g.group_quantity "
                       "FROM lineitem l JOIN (SELECT l_orderkey AS g_orderkey, l_linenumber AS g_linenumber, "
                       "count(*) AS lines_in_group, "
                       "CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS group_quantity "
                       "FROM lineitem GROUP BY 1, 2) g "
                       "ON l.l_orderkey = g.g_orderkey AND l.l_linenumber = g.g_linenumber"),
    "join_multiway_self": ("SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, n1.n_name AS cust_nation, "
                           "n2.n_name AS supp_nation FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey "
                           "JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n1 ON c.c_nationkey = n1.n_nationkey "
                           "JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n2 ON s.s_nationkey = n2.n_nationkey"),
    "semi_members": ("SELECT p_partkey, p_name FROM part "
                     "WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')"),
    "append_new_only": ("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' "
                        "THEN 1 ELSE 2 END AS load_batch FROM orders"),
    # 2.4
    "listagg_ordered": ("SELECT l_orderkey, chunk, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, "
                        "l_partkey) AS part_keys "
                        f"FROM (SELECT *, {_chunk('l_orderkey', 'l_linenumber, l_partkey')} AS chunk FROM lineitem) "
                        "GROUP BY l_orderkey, chunk"),
    "nest_children": ("SELECT l_orderkey, chunk, CAST(to_json(list({'l_linenumber': l_linenumber, 'l_partkey': l_partkey, "
                      "'l_suppkey': l_suppkey} ORDER BY l_linenumber, l_partkey, l_suppkey)) AS VARCHAR) AS lines_json "
                      f"FROM (SELECT *, {_chunk('l_orderkey', 'l_linenumber, l_partkey, l_suppkey')} AS chunk "
                      "FROM lineitem) GROUP BY l_orderkey, chunk"),
    "collect_set_by_key": ("SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') "
                           "AS return_flags FROM lineitem GROUP BY l_orderkey"),
    "table_profile": _profile(),
    "fill_mean": (f"WITH c AS (SELECT c_custkey, {inj('c_custkey', 'c_acctbal')} AS acctbal FROM customer) "
                  f"SELECT c_custkey, CAST(COALESCE(acctbal, (SELECT avg(acctbal) FROM c)) AS DECIMAL(12,2)) "
                  f"AS acctbal FROM c"),
    # 2.5
    "sort_multi": ("SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(row_number() OVER (ORDER BY "
                   "o_orderpriority, o_totalprice DESC, o_orderkey) AS BIGINT) AS rnk FROM orders "
                   "ORDER BY rnk"),
    "limit_one": "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 40 ORDER BY p_partkey LIMIT 1",
    "set_equality": (f"WITH l AS (SELECT c_custkey, c_name, c_acctbal FROM customer), "
                     f"r AS (SELECT c_custkey, c_name, c_acctbal FROM ({CUSTOMER_EDITED})), "
                     f"lo AS (SELECT count(*) AS n FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)), "
                     f"ro AS (SELECT count(*) AS n FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)) "
                     f"SELECT 'left_only' AS side, lo.n AS n, lo.n + ro.n = 0 AS equal FROM lo, ro "
                     f"UNION ALL SELECT 'right_only', ro.n, lo.n + ro.n = 0 FROM lo, ro"),
    # 2.6
    "fill_na_string": f"SELECT c_custkey, COALESCE({inj('c_custkey', 'c_mktsegment')}, 'N/A') AS segment FROM customer",
    "fill_zero": f"SELECT c_custkey, COALESCE({inj('c_custkey', 'c_acctbal')}, CAST(0 AS DOUBLE)) AS acctbal FROM customer",
    "fill_min_date": (f"SELECT o_orderkey, COALESCE(CAST({inj('o_orderkey', 'o_orderdate')} AS DATE), "
                      f"DATE '1900-01-01') AS order_date FROM orders"),
    "cast_decimal": "SELECT p_partkey, CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part",
    "cast_strict": "SELECT c_custkey, CAST(regexp_extract(c_name, '[0-9]+', 0) AS BIGINT) AS name_number FROM customer",
    "cast_try_default": ("SELECT p_partkey, COALESCE(TRY_CAST(p_name AS INTEGER), -1) AS name_as_int, "
                         "COALESCE(TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER), -1) AS size_as_int FROM part"),
    "parse_date": ("SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) "
                   "AS order_day, CAST(try_strptime(strftime(o_orderdate, '%Y-%m-%d'), '%d/%m/%Y') AS DATE) "
                   "AS bad_format FROM orders"),
    "flag_decode": "SELECT o_orderkey, o_orderstatus = 'F' AS is_final, o_orderstatus = 'O' AS is_open FROM orders",
    "split_array": ("SELECT p_partkey, CAST(pos - 1 AS INTEGER) AS pos, word FROM (SELECT p_partkey, "
                    "unnest(string_split(p_name, ' ')) AS word, "
                    "unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS pos FROM part)"),
    "iso_text": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date_text FROM orders",
    # 2.7
    "null_key_check": (f"SELECT count(*) FILTER (WHERE k IS NULL) AS null_keys, count(*) AS rows FROM "
                       f"(SELECT {inj('c_custkey', 'c_custkey')} AS k FROM customer)"),
    "unresolved_fk_check": (f"SELECT count(*) FILTER (WHERE sk_nation = -1) AS unresolved_sk_nation, "
                            f"count(*) AS rows FROM ({DIM_LOOKUP})"),
    "qc_single_pass": (f"SELECT count(*) FILTER (WHERE sk_part = -1) AS unresolved_sk_part, "
                       f"count(*) FILTER (WHERE sk_supplier = -1) AS unresolved_sk_supplier, "
                       f"count(*) FILTER (WHERE sk_customer = -1) AS unresolved_sk_customer, "
                       f"count(*) FILTER (WHERE sk_order_date = -1) AS unresolved_sk_order_date, "
                       f"count(*) FILTER (WHERE sk_ship_date = -1) AS unresolved_sk_ship_date, "
                       f"count(*) FILTER (WHERE quantity <= 0) AS nonpositive_quantity, "
                       f"count(*) FILTER (WHERE sk_ship_date < sk_order_date) AS ship_before_order, "
                       f"count(*) AS rows FROM ({FACT_BROKEN})"),
    "reject_split": (f"SELECT c_custkey, CASE WHEN reasons = '' THEN 'valid' ELSE 'rejected' END AS verdict, reasons "
                     f"FROM (SELECT s.c_custkey, concat_ws(',', CASE WHEN s.c_name IS NULL THEN 'null_name' END, "
                     f"CASE WHEN n.n_nationkey IS NULL THEN 'unknown_nation' END) AS reasons FROM "
                     f"(SELECT c_custkey, {inj('c_custkey', 'c_name')} AS c_name, "
                     f"{orph('c_custkey', 'c_nationkey')} AS c_nationkey FROM customer) s "
                     f"LEFT JOIN nation n ON s.c_nationkey = n.n_nationkey)"),
    "unique_check": ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber "
                     "HAVING count(*) > 1"),
    "not_null_check": _not_null(),
    "fk_orphans": (f"SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, {orph('o_orderkey', 'o_custkey')} "
                   f"AS o_custkey FROM orders) s WHERE o_custkey IS NOT NULL AND NOT EXISTS "
                   f"(SELECT 1 FROM customer c WHERE c.c_custkey = s.o_custkey)"),
    "check_violations": ("SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, o.o_orderdate FROM lineitem l "
                         "JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE NOT (l.l_shipdate >= o.o_orderdate)"),
    "fact_key_unique": (f"SELECT sk_part, sk_supplier, sk_customer, sk_order_date, sk_ship_date, count(*) AS n "
                        f"FROM ({FACT_TWICE}) GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1"),
    "self_fk_orphans": ("SELECT c_custkey, c_custkey + 100 AS manager_id FROM customer c1 WHERE NOT EXISTS "
                        "(SELECT 1 FROM customer c2 WHERE c2.c_custkey = c1.c_custkey + 100)"),
    "reconcile": (f"WITH s AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer), "
                  f"t AS ({CUSTOMER_EDITED} UNION ALL SELECT c_custkey + 10000000, c_name, c_acctbal, c_mktsegment "
                  f"FROM customer WHERE c_nationkey = 5), "
                  f"j AS (SELECT CASE WHEN t.c_custkey IS NULL THEN 'missing' WHEN s.c_custkey IS NULL THEN 'extra' "
                  f"WHEN s.c_name IS NOT DISTINCT FROM t.c_name AND s.c_acctbal IS NOT DISTINCT FROM t.c_acctbal "
                  f"AND s.c_mktsegment IS NOT DISTINCT FROM t.c_mktsegment THEN 'match' ELSE 'changed' END AS status "
                  f"FROM s FULL OUTER JOIN t ON s.c_custkey = t.c_custkey) "
                  f"SELECT 'match' AS status, count(*) FILTER (WHERE status = 'match') AS n FROM j "
                  f"UNION ALL SELECT 'changed', count(*) FILTER (WHERE status = 'changed') FROM j "
                  f"UNION ALL SELECT 'missing', count(*) FILTER (WHERE status = 'missing') FROM j "
                  f"UNION ALL SELECT 'extra', count(*) FILTER (WHERE status = 'extra') FROM j"),
    # 2.8
    "surrogate_key": "SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS sk_order, o_orderkey FROM orders",
    "surrogate_key_incremental": (
        "WITH a AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders "
        "WHERE o_orderdate < TIMESTAMP '1999-01-01'), "
        "b AS (SELECT o_orderkey, (SELECT max(sk) FROM a) + row_number() OVER (ORDER BY o_orderkey) AS sk "
        "FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)) "
        "SELECT CAST(sk AS BIGINT) AS sk_order, o_orderkey FROM a UNION ALL "
        "SELECT CAST(sk AS BIGINT), o_orderkey FROM b"),
    "date_dim": DIM_DATE,
    "dim_region": _audit(DIM_REGION),
    "dim_nation": _audit(DIM_NATION),
    "dim_part": _audit(DIM_PART),
    "dim_customer": _audit(DIM_CUSTOMER),
    "dim_supplier": _audit(DIM_SUPPLIER),
    "fact_load": _audit(FACT),
    "split_hierarchy": ("WITH b AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY p_brand) AS BIGINT) AS sk_brand "
                        "FROM (SELECT DISTINCT p_brand FROM part)) "
                        "SELECT p.p_partkey, COALESCE(b.sk_brand, -1) AS sk_brand FROM part p "
                        "LEFT JOIN b ON p.p_brand = b.p_brand"),
    "split_hierarchy_nulls": (
        "WITH p AS (SELECT p_partkey, p_type, CASE WHEN p_partkey % 10 <> 0 THEN p_brand END AS p_brand FROM part), "
        "k AS (SELECT p_brand, p_type, CAST(row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST) "
        "AS BIGINT) AS sk_kind FROM (SELECT DISTINCT p_brand, p_type FROM p)) "
        "SELECT 'child' AS side, p_partkey, sk_kind, CAST(NULL AS VARCHAR) AS p_brand, CAST(NULL AS VARCHAR) AS p_type "
        "FROM p LEFT JOIN k ON p.p_brand IS NOT DISTINCT FROM k.p_brand AND p.p_type IS NOT DISTINCT FROM k.p_type "
        "UNION ALL SELECT 'parent', NULL, sk_kind, p_brand, p_type FROM k"),
    "dim_key_verdicts": (
        "WITH s AS (SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS customer_id, c_name AS customer_name "
        "FROM customer UNION ALL SELECT c_custkey, c_name || ' (2)' FROM customer WHERE c_custkey % 40 = 1 "
        "UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 40 = 3), "
        "k AS (SELECT customer_id FROM s WHERE customer_id IS NOT NULL GROUP BY customer_id "
        "HAVING count(DISTINCT customer_name) > 1) "
        "SELECT customer_id, customer_name, CAST(row_number() OVER (ORDER BY customer_id) AS BIGINT) AS sk_customer, "
        "'valid' AS verdict FROM (SELECT DISTINCT * FROM s WHERE customer_id IS NOT NULL "
        "AND customer_id NOT IN (SELECT customer_id FROM k)) "
        "UNION ALL SELECT DISTINCT customer_id, customer_name, CAST(NULL AS BIGINT), 'duplicate_business_key' FROM s "
        "WHERE customer_id IN (SELECT customer_id FROM k) "
        "UNION ALL SELECT customer_id, customer_name, NULL, 'null_business_key' FROM s WHERE customer_id IS NULL"),
    "functional_dependency": _functional_dependency(),
    "infer_types": None,  # filled below
    "fk_containment": _fk_containment(),
    "fact_candidates": _fact_candidates(),
    "cluster_advice": _cluster_advice(),
    "clustered_write": "SELECT * FROM lineitem",
    "run_load": _run_load(),
}


def _infer_types() -> str:
    # Text of each column as Spark renders it; int = optional sign and
    # digits within int range; double = a decimal number; date = ISO day.
    parts = []
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"):
        t = f"CAST({c} AS VARCHAR)"
        parts.append(
            f"SELECT '{c}' AS column_name, "
            f"CAST(count(TRY_CAST({t} AS INTEGER)) FILTER (WHERE regexp_full_match(trim({t}), '[+-]?[0-9]+')) "
            f"AS DOUBLE) / count({t}) AS share_int, "
            f"CAST(count(TRY_CAST({t} AS DOUBLE)) AS DOUBLE) / count({t}) AS share_double, "
            f"CAST(count(try_strptime({t}, '%Y-%m-%d')) AS DOUBLE) / count({t}) AS share_date FROM customer")
    return " UNION ALL ".join(parts)


ORACLE_SQL["infer_types"] = _infer_types()


# Columns of the star's tables by kind, as the files declare them.
COLUMN_KINDS = {
    "integer": {"region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"],
                "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"],
                "part": ["p_partkey", "p_size"], "orders": ["o_orderkey", "o_custkey"],
                "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]},
    "number": {"customer": ["c_acctbal"], "supplier": ["s_acctbal"], "part": ["p_retailprice"],
               "orders": ["o_totalprice"], "lineitem": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]},
    "text": {"region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"],
             "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"],
             "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"]},
    "time": {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"]},
}
TABLE_COLUMNS = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ORDERS_COLS,
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
}


def _inclusion() -> str:
    """All type-compatible pairs, from the distinct values of every column."""
    parts, stats = [], []
    for kind, tables in COLUMN_KINDS.items():
        columns = [(t, c) for t, cs in tables.items() for c in cs]
        values = " UNION ALL ".join(f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, {c} AS v FROM {t} WHERE {c} IS NOT NULL"
                                    for t, c in columns)
        parts.append(f"SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, count(*) AS contained "
                     f"FROM ({values}) a JOIN ({values}) b ON a.v = b.v GROUP BY ALL")
        stats += [f"SELECT '{kind}' AS kind, '{t}' AS t, '{c}' AS c, count(DISTINCT {c}) AS n, count(*) AS rows, "
                  f"substr('{c}', strpos('{c}', '_') + 1) AS stem FROM {t}" for t, c in columns]
    return (f"WITH both_ AS ({' UNION ALL '.join(parts)}), "
            f"stats AS (SELECT *, n = rows AND rows > 0 AS uniq FROM ({' UNION ALL '.join(stats)})), "
            "pairs AS (SELECT a.t AS child_table, a.c AS child_column, b.t AS parent_table, b.c AS parent_column, "
            "a.kind, a.n AS distinct_child, COALESCE(x.contained, 0) AS contained, "
            "CAST(COALESCE(x.contained, 0) AS DOUBLE) / a.n AS ratio, a.uniq AS child_unique, "
            "b.uniq AS parent_unique, a.stem = b.stem AS name_match, b.n AS parent_values "
            "FROM stats a JOIN stats b ON a.kind = b.kind AND (a.t, a.c) <> (b.t, b.c) "
            "LEFT JOIN both_ x ON x.ct = a.t AND x.cc = a.c AND x.pt = b.t AND x.pc = b.c), "
            "ranked AS (SELECT * EXCLUDE (parent_values), CAST(row_number() OVER (PARTITION BY child_table, "
            "child_column ORDER BY (contained = distinct_child AND distinct_child > 0 AND parent_unique) DESC, "
            "name_match DESC, contained DESC, parent_values, parent_table, parent_column) AS BIGINT) AS rnk "
            "FROM pairs) ")


ORACLE_SQL["inclusion_dependencies"] = _inclusion() + "SELECT * FROM ranked"
ORACLE_SQL["fact_ranking"] = (
    _inclusion() + ", links AS (SELECT child_table, child_column, parent_table FROM ranked "
    "WHERE contained = distinct_child AND distinct_child > 0 AND parent_unique AND name_match "
    "AND child_table <> parent_table "
    "QUALIFY row_number() OVER (PARTITION BY child_table, child_column ORDER BY rnk) = 1), "
    "own AS (SELECT s.t AS table_name, count(l.parent_table) AS \"references\", "
    "count(*) FILTER (WHERE s.kind IN ('integer', 'number') AND l.parent_table IS NULL AND NOT s.uniq) AS measures "
    "FROM stats s LEFT JOIN links l ON l.child_table = s.t AND l.child_column = s.c GROUP BY s.t), "
    "counts AS (SELECT o.table_name, \"references\", (SELECT count(*) FROM links l WHERE l.parent_table = o.table_name) "
    "AS referenced_by, measures FROM own o) "
    "SELECT *, CAST(row_number() OVER (ORDER BY \"references\" DESC, referenced_by, measures DESC, table_name) "
    "AS BIGINT) AS rnk FROM counts")


def _minimal_keys(tables: list[str], most: int) -> str:
    """Every combination counted, then those without a smaller key inside."""
    parts = []
    for t in tables:
        for k in range(1, most + 1):
            for s in combinations(TABLE_COLUMNS[t], k):
                parts.append(f"SELECT '{t}' AS table_name, {list(s)} AS cols, {k} AS k, count(*) AS rows, "
                             f"count(*) > 0 AND count(DISTINCT ({', '.join(s)},)) = count(*) "
                             f"AND {' AND '.join(f'count({c}) = count(*)' for c in s)} AS uniq FROM {t}"
                             if k > 1 else
                             f"SELECT '{t}' AS table_name, {list(s)} AS cols, 1 AS k, count(*) AS rows, "
                             f"count(*) > 0 AND count(DISTINCT {s[0]}) = count(*) AS uniq FROM {t}")
    return (f"WITH sets AS ({' UNION ALL '.join(parts)}), k AS (SELECT * FROM sets WHERE uniq) "
            "SELECT table_name, array_to_string(cols, ',') AS key_columns, CAST(k AS INTEGER) AS n_columns, rows "
            "FROM k a WHERE NOT EXISTS (SELECT 1 FROM k b WHERE b.table_name = a.table_name AND b.k < a.k "
            "AND list_has_all(a.cols, b.cols))")


def _minimal_dependencies(tables: list[str], most: int, error: str) -> str:
    """The rows that a dependency keeps: each determinant's most frequent value."""
    parts = []
    for t in tables:
        for k in range(1, most + 1):
            for x in combinations(TABLE_COLUMNS[t], k):
                for a in TABLE_COLUMNS[t]:
                    if a not in x:
                        parts.append(f"SELECT '{t}' AS t, {list(x)} AS x, '{a}' AS a, CAST(sum(m) AS BIGINT) AS kept, "
                                     f"(SELECT count(*) FROM {t}) AS rows FROM (SELECT max(n) AS m FROM (SELECT "
                                     f"{', '.join(x)}, {a}, count(*) AS n FROM {t} GROUP BY ALL) GROUP BY {', '.join(x)})")
    return (f"WITH d AS ({' UNION ALL '.join(parts)}), holds AS (SELECT * FROM d WHERE kept = rows) "
            "SELECT t AS table_name, array_to_string(x, ',') AS determinant, a AS dependent, "
            "CAST(len(x) AS INTEGER) AS n_columns, rows - kept AS violating_rows, "
            "CAST(rows - kept AS DOUBLE) / rows AS error FROM d "
            f"WHERE rows > 0 AND (kept = rows OR len(x) = 1 AND CAST(rows - kept AS DOUBLE) / rows <= {error}) "
            "AND NOT EXISTS (SELECT 1 FROM holds h WHERE h.t = d.t AND h.a = d.a AND len(h.x) < len(d.x) "
            "AND list_has_all(d.x, h.x))")


ORACLE_SQL["minimal_keys"] = _minimal_keys(["customer", "part", "lineitem"], 3)
ORACLE_SQL["minimal_dependencies"] = _minimal_dependencies(["part", "customer", "supplier", "nation"], 2, "0.05")

ORACLE_SQL["reject_replay"] = (
    "WITH k AS (SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_custkey % 3 = 0, c_custkey) AS BIGINT) AS sk "
    f"FROM customer), o AS (SELECT o_orderkey, {orph('o_orderkey', 'o_custkey')} AS o_custkey, "
    "CAST(o_totalprice AS DECIMAL(12,2)) AS total, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'b1' "
    "ELSE 'b2' END AS load_batch FROM orders) "
    "SELECT o_orderkey AS order_id, COALESCE(sk, -1) AS sk_buyer, total, load_batch, "
    "CASE WHEN sk IS NULL THEN 'waiting' ELSE 'loaded' END AS state FROM o LEFT JOIN k ON o_custkey = c_custkey")

ORACLE_SQL["reconcile_ranges"] = ORACLE_SQL["reconcile"]
ORACLE_SQL["reconcile_ranges_few"] = (
    "WITH r AS (SELECT o_orderkey BETWEEN 1000 AND 1200 AND o_orderkey % 5 = 0 AS gone, "
    "o_orderkey BETWEEN 1000 AND 1200 AND o_orderkey % 5 = 1 AS edited FROM orders) "
    "SELECT 'match' AS status, count(*) FILTER (WHERE NOT gone AND NOT edited) AS n FROM r "
    "UNION ALL SELECT 'changed', count(*) FILTER (WHERE edited) FROM r "
    "UNION ALL SELECT 'missing', count(*) FILTER (WHERE gone) FROM r UNION ALL SELECT 'extra', 0")


ORDERS_NULLS = (f"(SELECT o_orderkey, o_custkey, {inj('o_orderkey', 'o_orderstatus')} AS o_orderstatus, "
                f"{inj('o_orderkey', 'o_totalprice')} AS o_totalprice, o_orderdate, o_orderpriority FROM orders)")


def _statistics() -> str:
    parts = []
    for c in ORDERS_COLS:
        number = c in ("o_orderkey", "o_custkey", "o_totalprice")
        text = c in ("o_orderstatus", "o_orderpriority")
        size = f"strlen({c})" if text else "8"
        ends = (f"min({c})::DOUBLE AS least, max({c})::DOUBLE AS largest, NULL::VARCHAR AS first_text, "
                "NULL::VARCHAR AS last_text" if number else
                f"NULL::DOUBLE AS least, NULL::DOUBLE AS largest, min({c})::VARCHAR AS first_text, "
                f"max({c})::VARCHAR AS last_text" if text else
                "NULL::DOUBLE AS least, NULL::DOUBLE AS largest, "
                f"strftime(min({c}), '%Y-%m-%d %H:%M:%S.%f') AS first_text, "
                f"strftime(max({c}), '%Y-%m-%d %H:%M:%S.%f') AS last_text")
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls, "
            f"CAST(sum(CASE WHEN {c} IS NULL THEN 0 ELSE {size} END) AS BIGINT) AS bytes, {ends}, "
            f"{'TRUE' if number else 'NULL::BOOLEAN'} AS median_within, "
            f"(SELECT {{'v': {c}::VARCHAR, 'n': count(*)}} FROM {ORDERS_NULLS} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC LIMIT 1) AS top FROM {ORDERS_NULLS}")
    return (f"SELECT column_name, rows, nulls, bytes, bytes / rows::DOUBLE AS average_length, least, largest, "
            "first_text, last_text, TRUE AS distinct_within, median_within, "
            "CASE WHEN top.n > rows / 100.0 THEN top.v END AS top_value, "
            f"CASE WHEN top.n > rows / 100.0 THEN top.n END AS top_count FROM ({' UNION ALL '.join(parts)})")


ORACLE_SQL["merged_statistics"] = _statistics()
ORACLE_SQL["row_length"] = (
    f"SELECT max(rows) AS rows, CAST(sum(bytes) AS BIGINT) AS bytes, "
    f"CAST(sum(bytes) AS DOUBLE) / max(rows) AS average_row_length, CAST(ceil(sum(bytes) / 8192) AS BIGINT) AS blocks "
    f"FROM ({_statistics()})")

ORACLE_SQL["curve_write"] = "SELECT * FROM lineitem"


def _layout_advice(files: int = 64, probes: int = 20, bits: int = 6) -> str:
    """The three layouts by ntile, the curve from the bits of both columns' ranks;
    then the share of files whose ends miss each of the equally frequent ranges."""
    curve = " | ".join(f"(((a >> {k}) & 1) << {2 * k + 1}) | (((b >> {k}) & 1) << {2 * k})" for k in range(bits))
    laid = " UNION ALL ".join(
        f"SELECT '{name}' AS layout, ntile({files}) OVER (ORDER BY {order}) AS f, s, p FROM r"
        for name, order in (("l_shipdate", "s"), ("l_partkey", "p"), ("l_shipdate,l_partkey", curve)))
    cuts = " UNION ALL ".join(
        f"SELECT {'quantile_disc(s, %s)' % (i / probes) if i else 'NULL'} AS slo, "
        f"{'quantile_disc(s, %s)' % ((i + 1) / probes) if i + 1 < probes else 'NULL'} AS shi, "
        f"{'quantile_disc(p, %s)' % (i / probes) if i else 'NULL'} AS plo, "
        f"{'quantile_disc(p, %s)' % ((i + 1) / probes) if i + 1 < probes else 'NULL'} AS phi FROM r"
        for i in range(probes))
    shares = " UNION ALL ".join(
        f"SELECT layout, '{column}' AS column_name, avg(CASE WHEN max_{v} < {v}lo OR min_{v} > {v}hi THEN 1.0 "
        "ELSE 0.0 END) AS share FROM ends, cuts GROUP BY layout" for column, v in (("l_shipdate", "s"), ("l_partkey", "p")))
    return (f"WITH r AS (SELECT epoch(l_shipdate) AS s, l_partkey AS p, ntile({1 << bits}) OVER (ORDER BY l_shipdate) - 1 "
            f"AS a, ntile({1 << bits}) OVER (ORDER BY l_partkey) - 1 AS b FROM lineitem), cuts AS ({cuts}), "
            "ends AS (SELECT layout, f, min(s) AS min_s, max(s) AS max_s, min(p) AS min_p, max(p) AS max_p "
            f"FROM ({laid}) GROUP BY layout, f), shares AS ({shares}), "
            "ranked AS (SELECT *, avg(share) OVER (PARTITION BY layout) AS mean FROM shares) "
            "SELECT layout, column_name, share >= 0.5 AS skips_half, mean = max(mean) OVER () AS advised FROM ranked")


ORACLE_SQL["layout_advice"] = _layout_advice()

ORACLE_SQL["document_relations"] = (
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST((row_number() OVER (PARTITION BY l_orderkey "
    "ORDER BY l_linenumber, l_partkey) - 1) % 10000 AS INTEGER) AS position, l_linenumber AS line, "
    "l_partkey AS part_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
