"""Sources and layout: partitioned JDBC options (no database is started:
a stub reader records the options), clustered files, nested JSON."""

from pyspark.sql import functions as F

from starload.operators.layout import clustered_write
from starload.operators.nest import nest_children
from starload.sources.jdbc import jdbc_options, read_jdbc
from starload.sources.json_io import read_json, to_json_column, write_json

from locations import SF_SMALL


class _Row(dict):
    def __getitem__(self, k):
        return dict.__getitem__(self, k)


class _Frame:
    def __init__(self, row):
        self.row = row

    def first(self):
        return self.row


class _Reader:
    def __init__(self, log):
        self.log, self.opts = log, {}

    def format(self, f):
        self.opts["format"] = f
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(dict(self.opts))
        return _Frame(_Row(lo=3, hi=990)) if "query" in self.opts else "table"


class _Spark:
    def __init__(self):
        self.log = []

    @property
    def read(self):
        return _Reader(self.log)


def test_jdbc_partitioned_read_bounds_then_ranges():
    spark = _Spark()
    opts = jdbc_options("jdbc:db://h/x", "EMPLOYEES", user="u", password="p")
    assert read_jdbc(spark, opts, "EMPLOYEE_ID", num_partitions=16) == "table"
    bounds, scan = spark.log
    assert bounds["query"] == "SELECT MIN(EMPLOYEE_ID) AS lo, MAX(EMPLOYEE_ID) AS hi FROM EMPLOYEES"
    assert "dbtable" not in bounds
    assert (scan["partitionColumn"], scan["lowerBound"], scan["upperBound"], scan["numPartitions"]) == (
        "EMPLOYEE_ID", "3", "990", "16")
    assert scan["dbtable"] == "EMPLOYEES" and scan["fetchsize"] == "10000"


def test_jdbc_known_bounds_skip_query_and_plain_read():
    spark = _Spark()
    read_jdbc(spark, jdbc_options("jdbc:db://h/x", "T"), "ID", num_partitions=4, bounds=(1, 100))
    assert len(spark.log) == 1 and spark.log[0]["lowerBound"] == "1"
    spark = _Spark()
    read_jdbc(spark, jdbc_options("jdbc:db://h/x", "T"))
    assert "partitionColumn" not in spark.log[0]


def test_clustered_files_hold_disjoint_ranges(spark, tmp_path):
    path = str(tmp_path / "li")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    clustered_write(li, path, "l_shipdate", num_partitions=4)
    back = spark.read.parquet(path)
    assert back.count() == li.count()
    ranges = sorted((r.lo, r.hi) for r in back.groupBy(F.input_file_name()).agg(
        F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi")).collect())
    assert len(ranges) > 1
    # ordered ranges; adjacent files may share one boundary value (the row-hash
    # tie breaker lets a hot key spread over neighbouring files)
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_nested_json_export_and_multiline_import(spark, tmp_path):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    nested = nest_children(orders, "o_custkey", "o_orderkey", ["o_orderkey", "o_orderstatus"], alias="orders")
    path = str(tmp_path / "nested")
    write_json(nested, path)
    back = read_json(spark, path, nested.schema)
    assert back.count() == nested.count()
    assert back.exceptAll(nested).count() == 0
    one = to_json_column(nested.limit(1)).first().json
    assert one.startswith('{"o_custkey":') and '"orders":[{"o_orderkey":' in one
    doc = tmp_path / "doc.json"
    doc.write_text('{"tables": [\n {"name": "A", "columns": ["x", "y"]},\n {"name": "B", "columns": []}\n]}\n')
    cat = read_json(spark, str(doc), "tables array<struct<name string, columns array<string>>>", multiline=True)
    assert [t.name for t in cat.first().tables] == ["A", "B"]
