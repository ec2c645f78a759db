"""Warehouse sinks and read-back (S2, S3, S4, D2 append-new-only).

A warehouse table is a parquet directory (or a catalog table when a name
without '/' is given); below a root that loads publish to, it is the folders
that the load log names (``published.py``).  Appends match columns by NAME: the frame is first
conformed to the target's schema -- reordered, extra columns dropped,
missing ones null -- so positional writers cannot shift values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql.types import StructType

from starload.operators.lookup import anti_members
from starload.operators.mapping import conform_schema
from starload.sources.published import read_published


def _is_path(target: str) -> bool:
    return "/" in target or ":" in target


def try_read_back(spark: SparkSession, target: str) -> DataFrame | None:
    """The table, or ``None`` when it does not exist yet (one footer read)."""
    if _is_path(target):
        loaded = read_published(spark, target)
        if loaded is not None:
            return loaded
        try:
            return spark.read.parquet(target)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
    return spark.read.table(target) if spark.catalog.tableExists(target) else None


def table_exists(spark: SparkSession, target: str) -> bool:
    return try_read_back(spark, target) is not None


def read_back(spark: SparkSession, target: str) -> DataFrame:
    """Read a loaded table (children re-read parents so stored
    surrogate keys are the ones they reference)."""
    if not _is_path(target):
        return spark.read.table(target)
    loaded = read_published(spark, target)
    return loaded if loaded is not None else spark.read.parquet(target)


def write_table(df: DataFrame, target: str, mode: str = "errorifexists") -> None:
    if _is_path(target):
        df.write.mode(mode).parquet(target)
    else:
        df.write.mode(mode).saveAsTable(target)


def append_by_name(df: DataFrame, target: str, schema: StructType | None = None,
                   exists: bool | None = None) -> DataFrame:
    """S3: append with columns matched by name; extra columns are ignored,
    missing columns become typed nulls.  The target schema is read from the
    table when it exists (callers that already know it pass ``schema``, or
    ``exists=False`` for a first load).  Returns the frame appended."""
    spark = df.sparkSession
    if schema is None and exists is not False:
        current = try_read_back(spark, target)
        schema = current.schema if current is not None else None
    out = conform_schema(df, schema, allow_missing=True) if schema is not None else df
    write_table(out, target, mode="append")
    return out


def append_new_only(df: DataFrame, target: str, business_key: str | Sequence[str],
                    schema: StructType | None = None) -> DataFrame:
    """D2/defect 3: append only rows whose business key is not in the target
    yet, so a rerun of the same load appends nothing.  The key side of the
    anti join is the target's distinct keys."""
    spark = df.sparkSession
    keys = [business_key] if isinstance(business_key, str) else list(business_key)
    existing = try_read_back(spark, target)
    if existing is not None:
        df = anti_members(df, existing, keys)
        schema = schema or existing.schema
    return append_by_name(df, target, schema, exists=existing is not None)
