"""Projection, renaming, null fills, audit column and schema conformance
(P1-P6, X2-X5, A6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DecimalType, NumericType, StringType,
                               StructType, TimestampNTZType, TimestampType)

from starload.functions.scalar import MIN_DATE, NA_TEXT, load_timestamp

ColumnSource = str | Column


def map_columns(df: DataFrame, mapping: Sequence[tuple[str, ColumnSource]] | Mapping[str, ColumnSource]) -> DataFrame:
    """Explicit projection with renames; never ``select('*')``.

    ``mapping`` is ``[(target_name, source_column_or_expression), ...]``; one
    source may feed several targets.
    """
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select([(F.col(src) if isinstance(src, str) else src).alias(tgt) for tgt, src in items])


def add_audit_column(df: DataFrame, load_ts: str | None = None, name: str = "dt_insert") -> DataFrame:
    """Load timestamp column (fixed ``load_ts`` keeps reruns repeatable)."""
    return df.withColumn(name, load_timestamp(load_ts))


def _fill_value(df: DataFrame, name: str, rule, data_type: DataType) -> Column:
    col = F.col(name)
    if rule == "mean":
        # Uncorrelated scalar subquery; Spark runs the one-row aggregate
        # once and inlines the value -- no join, nothing collected by us.
        mean = df.select(F.avg(col)).scalar()
        return F.coalesce(col, mean.cast(data_type))
    if rule == "zero":
        return F.coalesce(col, F.lit(0).cast(data_type))
    if rule == "na":
        return F.coalesce(col, F.lit(NA_TEXT))
    if rule == "min_date":
        if isinstance(data_type, (TimestampType, TimestampNTZType)):
            return F.coalesce(col, F.lit(MIN_DATE).cast(data_type))
        return F.coalesce(F.to_date(col), F.lit(MIN_DATE).cast("date"))
    if isinstance(rule, Column):
        return F.coalesce(col, rule.cast(data_type))
    return F.coalesce(col, F.lit(rule).cast(data_type))


def fill_nulls(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Per-column null policy with typed fills.

    Rule values: ``"na"`` ('N/A'), ``"zero"``, ``"mean"``, ``"min_date"``, a
    literal, or a Column.  Fills keep the column's type (defect: filling a
    decimal with ``0.0`` widens it to double; a DATE filled with text is
    silently skipped).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for name in df.columns:
        if name in rules:
            out.append(_fill_value(df, name, rules[name], types[name]).alias(name))
        else:
            out.append(F.col(name))
    return df.select(out)


def default_fill_rules(df: DataFrame, exclude: Sequence[str] = ()) -> dict[str, str]:
    """The warehouse null policy by type: text -> 'N/A', numbers -> 0,
    dates -> 1900-01-01 (keys in ``exclude`` are never filled)."""
    rules = {}
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, StringType):
            rules[f.name] = "na"
        elif isinstance(f.dataType, NumericType):
            rules[f.name] = "zero"
        elif isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType)):
            rules[f.name] = "min_date"
    return rules


def conform_schema(df: DataFrame, schema: StructType, allow_missing: bool = False) -> DataFrame:
    """P5: final ordered projection with casts to the declared target types.

    Columns are matched by name; extra source columns are dropped; a missing
    column raises unless ``allow_missing`` (then it becomes a typed null).
    Casts are strict (ANSI): a value that does not fit raises.
    """
    have = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name in have:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif allow_missing:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"column {field.name!r} missing; have {sorted(have)}")
    return df.select(cols)


def schema_differences(df: DataFrame, schema: StructType) -> list[tuple[str, str, str]]:
    """Names *and* types compared (the reference's gate compares names only)."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    diffs = []
    for field in schema.fields:
        if field.name not in actual:
            diffs.append((field.name, "missing", field.dataType.simpleString()))
        elif actual[field.name] != field.dataType:
            diffs.append((field.name, actual[field.name].simpleString(), field.dataType.simpleString()))
    for name in actual:
        if name not in schema.names:
            diffs.append((name, actual[name].simpleString(), "extra"))
    return diffs


__all__ = ["map_columns", "add_audit_column", "fill_nulls", "default_fill_rules",
           "conform_schema", "schema_differences", "DecimalType"]
