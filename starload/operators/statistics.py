"""Statistics that merge (A5): per batch once, for the table by adding up.

``batch_statistics`` reads a batch once and gives one row per column: rows, nulls,
stored bytes, least and largest value, all exact, and three sketches of bounded
size -- HyperLogLog for distinct values, KLL for quantiles of numbers, frequent
items for heavy values.  The rows are stored with the batch; ``merge_statistics``
adds any number of them up without reading data again, and ``report`` reads the
answers off.

Bounds: distinct counts within 5 % (three standard errors of 2^12 registers),
quantiles within 2 % of the rows, counts of heavy values
exact while a column has fewer distinct values than ``TRACKED`` * 0.75 and
otherwise off by at most 3.5 / ``TRACKED`` of the rows.  Ends of numbers are
doubles: whole numbers beyond 2^53 are rounded.  A batch without rows adds nothing; a column of
nulls has no least, largest, quantile or heavy value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, NumericType, ShortType, StringType, TimestampNTZType,
                               TimestampType)

REGISTERS = 12       # log2
QUANTILE_K = 200
TRACKED = 10_000
BLOCK_BYTES = 8192

_WIDTH = {ByteType: 1, BooleanType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4, LongType: 8,
          DoubleType: 8, TimestampType: 8, TimestampNTZType: 8}


def stored_bytes(name: str, data_type: DataType) -> Column:
    """Bytes of a value as a column file holds it; a null takes none."""
    c = F.col(f"`{name}`")
    if isinstance(data_type, StringType):
        size = F.octet_length(c)
    elif type(data_type) in _WIDTH:
        size = F.lit(_WIDTH[type(data_type)])
    elif isinstance(data_type, DecimalType):
        size = F.lit(4 if data_type.precision <= 9 else 8 if data_type.precision <= 18 else 16)
    else:
        size = F.octet_length(F.to_json(F.struct(c.alias("v"))))
    return F.when(c.isNotNull(), size).otherwise(0).cast("long")


def _text(name: str, data_type: DataType) -> Column:
    """The value as text: ordered as the value for text, dates and timestamps."""
    c = F.col(f"`{name}`")
    if isinstance(data_type, (TimestampType, TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(data_type, (NumericType, StringType, DateType, BooleanType)):
        return c.cast("string")
    return F.to_json(F.struct(c.alias("v")))


def batch_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column of a batch, from one aggregate."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    texts = {f.name: f"t{i}" for i, f in enumerate(fields)}
    prepared = df.select(
        *[F.col(f"`{f.name}`") for f in fields],
        *[_text(f.name, f.dataType).alias(texts[f.name]) for f in fields])
    aggs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c, number = F.col(f"`{f.name}`"), isinstance(f.dataType, NumericType)
        double = (c if number else F.lit(None)).cast("double")
        text = F.col(texts[f.name]) if not number else F.lit(None).cast("string")
        aggs += [F.count(c).alias(f"n{i}"), F.sum(stored_bytes(f.name, f.dataType)).alias(f"b{i}"),
                 F.min(double).alias(f"lo{i}"), F.max(double).alias(f"hi{i}"),
                 F.min(text).alias(f"lt{i}"), F.max(text).alias(f"ht{i}"),
                 F.hll_sketch_agg(texts[f.name], F.lit(REGISTERS)).alias(f"d{i}"),
                 F.kll_sketch_agg_double(double, F.lit(QUANTILE_K)).alias(f"q{i}"),
                 F.expr(f"approx_top_k_accumulate({texts[f.name]}, {TRACKED})").alias(f"h{i}")]
    wide = prepared.agg(*aggs)
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(f.name).alias("column_name"), F.lit(i).alias("position"),
        F.lit("number" if isinstance(f.dataType, NumericType) else "text").alias("kind"), F.col("rows"),
        (F.col("rows") - F.col(f"n{i}")).alias("nulls"), F.coalesce(F.col(f"b{i}"), F.lit(0)).alias("bytes"),
        F.col(f"lo{i}").alias("least"), F.col(f"hi{i}").alias("largest"),
        F.col(f"lt{i}").alias("first_text"), F.col(f"ht{i}").alias("last_text"),
        F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch"),
        F.col(f"h{i}").alias("heavy_sketch")) for i, f in enumerate(fields)])))


def merge_statistics(parts: DataFrame) -> DataFrame:
    """The statistics of all batches together, in the same form (and mergeable again)."""
    return parts.groupBy("column_name", "position", "kind").agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls", "bytes")],
        F.min("least").alias("least"), F.max("largest").alias("largest"),
        F.min("first_text").alias("first_text"), F.max("last_text").alias("last_text"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
        F.expr(f"approx_top_k_combine(heavy_sketch, {TRACKED})").alias("heavy_sketch"))


def report(stats: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75), heavy: int = 3) -> DataFrame:
    """Answers of (merged) statistics: exact counts, lengths and ends, estimated
    distinct values, quantiles of numbers and the heaviest values."""
    measured = (F.col("kind") == "number") & (F.col("rows") > F.col("nulls"))
    ranks = F.when(measured, F.array(*[F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q)))
                                       for q in quantiles]))
    return stats.select(
        "column_name", "position", "rows", "nulls", "bytes",
        F.try_divide(F.col("bytes"), F.col("rows")).cast("double").alias("average_length"),
        "least", "largest", "first_text", "last_text",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"), ranks.alias("quantiles"),
        F.filter(F.expr(f"approx_top_k_estimate(heavy_sketch, {heavy})"), lambda x: x["item"].isNotNull())
        .alias("heavy_values"))


def row_length(stats: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows, bytes, average row length and blocks of the table, exact."""
    total = stats.agg(F.max("rows").alias("rows"), F.sum("bytes").alias("bytes"))
    return total.select("rows", "bytes", F.try_divide(F.col("bytes"), F.col("rows")).cast("double")
                        .alias("average_row_length"),
                        F.ceil(F.col("bytes") / F.lit(block_bytes)).cast("bigint").alias("blocks"))
