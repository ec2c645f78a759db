"""JSON export of nested records and JSON document sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def to_json_column(df: DataFrame, alias: str = "json") -> DataFrame:
    """Each row as one JSON object text (nested arrays/structs kept)."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(alias))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one file per partition, written by the executors."""
    df.write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """JSON with an explicit schema (no inference pass over the data).
    ``multiline`` reads whole-file documents such as an exported catalog."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)
