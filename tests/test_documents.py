"""Multi-line nested documents as relations, and chunks of a hot parent."""

import json

from pyspark.sql import functions as F

from starload.operators.nest import with_chunks
from starload.sources.documents import read_documents, relations
from pyspark.sql.types import StructType

SCHEMA = (
    "schema string, tables array<struct<name: string, owner: struct<id: int>, "
    "columns: array<struct<name: string, tags: array<string>>>>>")


def test_documents_become_relations(spark, tmp_path):
    catalog = [
        {"schema": "hr", "tables": [
            {"name": "a", "owner": {"id": 1}, "columns": [{"name": "x", "tags": ["k"]}, {"name": "y\nz", "tags": []}]},
            {"name": "b", "owner": None, "columns": []}]},
        {"schema": "empty", "tables": None},
        {"schema": "é", "tables": [{"name": "c", "columns": [{"name": "w"}]}]}]
    for i, doc in enumerate(catalog):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=2, ensure_ascii=False))
    (tmp_path / "broken.json").write_text('{\n "schema": "hr",\n "tables": [')
    docs, bad = read_documents(spark, str(tmp_path), StructType.fromDDL(SCHEMA))
    assert docs.columns == ["schema", "tables"] and docs.count() == 3
    row = bad.first()
    assert row.file.endswith("broken.json") and row.text.startswith("{") and bad.count() == 1
    found = relations(docs, ["schema"], "catalog")
    assert sorted(found) == ["catalog", "catalog.tables", "catalog.tables.columns"]
    assert {r.schema for r in found["catalog"].collect()} == {"hr", "empty", "é"}
    assert sorted((r.schema, r.tables_pos, r.name) for r in found["catalog.tables"].collect()) == [
        ("hr", 0, "a"), ("hr", 1, "b"), ("é", 0, "c")]
    assert sorted((r.schema, r.tables_pos, r.columns_pos, r.name, r.tags) for r in
                  found["catalog.tables.columns"].collect()) == [
        ("hr", 0, 0, "x", ["k"]), ("hr", 0, 1, "y\nz", []), ("é", 0, 0, "w", None)]


def test_chunks_of_a_parent_with_a_third_of_the_rows(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 700).alias("p"),
                                  F.col("id").alias("o"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_chunks(df, ["p"], ["o"], 100)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parents: dict = {}
    for r in rows:
        parents.setdefault(r.p, []).append((r.o, r.chunk))
    assert len(rows) == 9000 and len(parents[None]) == 3000
    for children in parents.values():
        assert [c for _, c in sorted(children)] == [i // 100 for i in range(len(children))]
    assert "__task" in plan.split("Join")[1].split("\n")[0]         # joined on parent and task, not on the parent alone
