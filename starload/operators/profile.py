"""Table profiling and model discovery measured on data.

Rows, nulls, minimum and maximum of all columns are one typed aggregate, which
shuffles one row per task.  Exact distinct counts come apart from them, from the
unpivoted (column number, value) cells: a Generate (no shuffle) and a hash
aggregate with map-side partial de-duplication, so a hot value collapses before
the shuffle.  A cell holds its value typed: whole numbers, dates and times as a
long, floating numbers as a double, the rest as text.  ``approx=True`` uses
HyperLogLog++ sketches instead (one pass, fixed memory per column) for very wide
or very large tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, NumericType, ShortType, TimestampNTZType, TimestampType)

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def _display_text(df: DataFrame, name: str) -> Column:
    """Text of a value in profiles: fractional numbers as decimal(20,2),
    dates and timestamps ISO, everything else as Spark text."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, (DoubleType, FloatType, DecimalType)):
        return c.cast(DecimalType(20, 2)).cast("string")
    if isinstance(dt, (TimestampNTZType, TimestampType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if isinstance(dt, DateType):
        return F.date_format(c, "yyyy-MM-dd")
    return c.cast("string")


def _cell(df: DataFrame, number: int, name: str) -> Column:
    """(column number, value) of one column, injective within the column."""
    dt = df.schema[name].dataType
    c = F.col(name)
    whole, real, text = F.lit(None).cast("long"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(dt, (*_INTEGRAL, BooleanType)):
        whole = c.cast("long")
    elif isinstance(dt, DateType):
        whole = F.unix_date(c).cast("long")
    elif isinstance(dt, TimestampType):
        whole = F.unix_micros(c)
    elif isinstance(dt, (DoubleType, FloatType)):
        real = c.cast("double")
    elif isinstance(dt, BinaryType):
        text = F.hex(c)
    else:
        text = c.cast("string")
    return F.struct(F.lit(number).cast("short").alias("k"), c.isNotNull().alias("there"),
                    whole.alias("whole"), real.alias("real"), text.alias("text"))


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """(column_name, distinct_count) per column; nulls are not counted and a
    column with no values reports 0."""
    cols = list(columns or df.columns)
    if approx:
        wide = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in cols])
    else:
        cells = (df.select(F.inline(F.array(*[_cell(df, i, c) for i, c in enumerate(cols)])))
                 .filter("there").select("k", "whole", "real", "text").distinct())
        # Back to one wide row so every column appears, even with 0 values.
        wide = cells.agg(*[F.count_if(F.col("k") == i).alias(c) for i, c in enumerate(cols)])
    return wide.unpivot([], cols, "column_name", "distinct_count").select(
        "column_name", F.col("distinct_count").cast("bigint").alias("distinct_count"))


def table_profile(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """A5: one row per column: rows, nulls, distinct, min and max as text.
    ``approx=True`` counts distinct values by sketches in the same pass; exact
    counts are an aggregate of their own and meet the rest by column name."""
    cols = list(columns or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(F.lit(1)).alias(f"__r{i}"), F.count_if(F.col(c).isNull()).alias(f"__n{i}"),
                 F.min(F.col(c)).alias(f"__lo{i}"), F.max(F.col(c)).alias(f"__hi{i}")]
        if approx:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"__d{i}"))
    wide = df.agg(*aggs)
    rows = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"__r{i}").cast("bigint").alias("rows"),
                 F.col(f"__n{i}").cast("bigint").alias("nulls"),
                 F.col(f"__d{i}").cast("bigint").alias("distinct_count") if approx else F.lit(0).alias("distinct_count"),
                 _display_text(wide, f"__lo{i}").alias("min_value"),
                 _display_text(wide, f"__hi{i}").alias("max_value"))
        for i, c in enumerate(cols)])))
    if approx:
        return rows
    return (rows.drop("distinct_count").join(distinct_counts(df, cols), "column_name")
            .select("column_name", "rows", "nulls", "distinct_count", "min_value", "max_value"))


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column, the share of non-null values (as text) that cast to
    int, to double and parse as an ISO date -- one aggregate for all."""
    cols = list(columns or df.columns)
    aggs = []
    for i, c in enumerate(cols):
        t = F.col(c).cast("string")
        aggs += [F.count(t).alias(f"__nn{i}"),
                 F.count(t.try_cast("int")).alias(f"__i{i}"),
                 F.count(t.try_cast("double")).alias(f"__d{i}"),
                 F.count(F.try_to_date(t, "yyyy-MM-dd")).alias(f"__t{i}")]
    wide = df.agg(*aggs)

    def share(prefix: str, i: int) -> Column:
        return F.try_divide(F.col(f"{prefix}{i}"), F.col(f"__nn{i}")).cast("double")

    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), share("__i", i).alias("share_int"),
                 share("__d", i).alias("share_double"), share("__t", i).alias("share_date"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def functional_dependency(df: DataFrame, determinant: str | Sequence[str], dependent: str) -> DataFrame:
    """Does ``determinant -> dependent`` hold?  One row: the number of
    determinant groups with more than one dependent value, and the verdict.
    A null dependent is no value.  Distinct (det, dep) pairs first (partial aggregation), then per det."""
    det = [determinant] if isinstance(determinant, str) else list(determinant)
    pairs = df.select(*det, dependent).filter(F.col(dependent).isNotNull()).distinct()
    per_det = pairs.groupBy(*det).agg(F.count(F.lit(1)).alias("__k"))
    return per_det.agg(F.count_if(F.col("__k") > 1).alias("violating_groups")).withColumn(
        "holds", F.col("violating_groups") == 0)


def fk_containment(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """Distinct non-null child values, how many occur in the parent
    column, and the ratio -- one row.  Both sides are reduced to distinct
    values before the semi join; the count of contained values is taken in
    the same aggregate as the total (left join flag, no second scan)."""
    values = child.select(F.col(child_col).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
    parent_keys = parent.select(F.col(parent_col).alias("__p")).distinct().withColumn("__hit", F.lit(True))
    flagged = values.join(parent_keys, values["__v"] == parent_keys["__p"], "left")
    out = flagged.agg(F.count(F.lit(1)).alias("distinct_child"),
                      F.count_if(F.col("__hit").isNotNull()).alias("contained"))
    return out.withColumn("ratio", F.try_divide(F.col("contained"), F.col("distinct_child")).cast("double"))


def numeric_measures(df: DataFrame) -> list[str]:
    """Columns that can be fact measures: fractional numeric, not a key."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, _INTEGRAL)
            and not f.name.endswith("key")]


def cluster_advice(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """L1: distinct-to-row ratio per column, ranked (highest first)."""
    cols = list(columns or df.columns)
    rows = df.agg(F.count(F.lit(1)).alias("rows"))
    out = distinct_counts(df, cols, approx=approx).withColumn("rows", rows.scalar())
    out = out.withColumn("ratio", F.try_divide(F.col("distinct_count"), F.col("rows")).cast("double"))
    # One row per column: the ranking window is bounded by the column count.
    w = Window.orderBy(F.desc("ratio"), F.asc("column_name"))
    return out.withColumn("rnk", F.row_number().over(w).cast("bigint"))
