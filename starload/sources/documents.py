"""Nested JSON documents as relations.

A document is one JSON value over many lines, a file each; a folder of them is
read side by side.  The schema is declared, so nothing is inferred; a file that
is no JSON is kept, with its text, apart from the rest.  ``relations`` turns nested arrays into tables: the parent's columns, and
per array one row per element with the parent's keys and the element's position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def read_documents(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(documents, unreadable): the documents below ``path``, and (file, text) of
    the files that hold no JSON.  A field of another type than declared is null."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    good = F.try_parse_json("value").isNotNull()
    documents = text.filter(good).select(F.from_json("value", schema).alias("doc"))
    return (documents.select(*[F.col("doc")[f.name].alias(f.name) for f in schema.fields]),
            text.filter(~good).select("file", F.col("value").alias("text")))


def relations(documents: DataFrame, keys: Sequence[str], name: str = "document") -> dict[str, DataFrame]:
    """One table per level: ``name`` with the columns that are no arrays of records,
    and for every such array (at any depth, ``parent.array``) its elements with the
    keys of the document, the positions down to the element, and its fields.  A null
    or empty array has no rows."""
    out: dict[str, DataFrame] = {}

    def level(df: DataFrame, table: str, kept: list[str]) -> None:
        nested = [f.name for f in df.schema.fields
                  if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType)]
        out[table] = df.drop(*nested)
        for array in nested:
            place = f"{array}_pos"
            rows = df.select(*kept, F.posexplode(F.col(f"`{array}`")).alias(place, "__element"))
            fields = [F.col("__element")[f.name].alias(f.name)
                      for f in df.schema[array].dataType.elementType.fields]
            level(rows.select(*kept, place, *fields), f"{table}.{array}", [*kept, place])

    level(documents, name, list(keys))
    return out
