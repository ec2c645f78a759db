"""Clustered physical layout (L2).

``repartitionByRange`` gives each output file a disjoint key range and the
in-partition sort makes parquet row-group min/max tight, so a later filter
on the cluster key skips files and row groups (``PushedFilters`` on scan).
A row-hash tie breaker keeps a hot key from landing in one task.

``clustered_by_curve`` orders rows along a Z curve over two or three columns, so a
filter on any of them skips files.  ``file_skipping`` measures how much a layout
skips, and ``layout_advice`` lays the rows out by each candidate, measures, and
ranks the candidates by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType


def clustered(df: DataFrame, keys: str | Sequence[str], num_partitions: int | None = None,
              tiebreak: bool = True) -> DataFrame:
    cols = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(c) for c in cols]
    if tiebreak:
        order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    # No explicit count: shuffle partitions as the upper bound, AQE merges
    # adjacent small ranges (file sizes follow the advisory partition size).
    by_range = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return by_range.sortWithinPartitions(*[F.col(c) for c in cols])


def clustered_write(df: DataFrame, path: str, keys: str | Sequence[str], num_partitions: int | None = None,
                    mode: str = "errorifexists", partition_by: Sequence[str] | None = None) -> None:
    """Write ``df`` range-clustered on ``keys`` as parquet."""
    writer = clustered(df, keys, num_partitions).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


BITS = 6             # of a column's rank on the curve
PROBES = 20          # ranges of equal share that file_skipping asks for


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number in the same order (text by its first six bytes)."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, NumericType):
        return c.cast("double")
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise ValueError(f"{name}: no order for {kind.simpleString()}")


def _quantiles(df: DataFrame, columns: Sequence[str], parts: int) -> dict[str, list[float]]:
    """The inner borders of ``parts`` equally frequent parts of each column, from
    one aggregate: ``parts`` - 1 numbers to the driver."""
    shares = [i / parts for i in range(1, parts)]
    row = df.agg(*[F.approx_percentile(_number(df, c), shares, 10_000).alias(c) for c in columns]).first()
    return {c: list(row[c] or []) for c in columns}


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Place on a Z curve: the bits of the columns' ranks in turn, the first column's
    leading.  A rank is the number of quantile borders below the value, so skewed
    columns weigh like even ones; nulls have rank 0."""
    borders = _quantiles(df, columns, 1 << bits)
    key = F.lit(0).cast("long")

    def below(c: str) -> Column:
        at, value = F.array(*[F.lit(float(b)) for b in borders[c]]).cast("array<double>"), _number(df, c)
        return F.size(F.filter(at, lambda border: border < value)).cast("long")

    for i, c in enumerate(columns):
        rank = below(c)
        for bit in range(bits):
            place = bit * len(columns) + (len(columns) - 1 - i)
            key = key.bitwiseOR(F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), place))
    return key


def clustered_by_curve(df: DataFrame, columns: Sequence[str], num_partitions: int | None = None,
                       bits: int = BITS) -> DataFrame:
    """Rows in ranges of a Z curve over two or three columns; a row-hash tie breaker
    splits places of the curve that hold many rows."""
    if not 2 <= len(columns) <= 3:
        raise ValueError("a curve takes two or three columns")
    keyed = df.withColumn("__curve", curve_key(df, columns, bits))
    order = [F.col("__curve"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    by_range = keyed.repartitionByRange(num_partitions, *order) if num_partitions else keyed.repartitionByRange(*order)
    return by_range.sortWithinPartitions("__curve").drop("__curve")


def _skipping(df: DataFrame, columns: Sequence[str], unit: Column, probes: int) -> DataFrame:
    """(column_name, files, skipped_share): of ``probes`` ranges of equal share per
    column, the mean share of units whose least and largest value miss the range."""
    borders = _quantiles(df, columns, probes)
    ends = df.groupBy(unit.alias("__unit")).agg(
        *[f(_number(df, c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))])
    aggs = [F.count(F.lit(1)).alias("files")]
    for i, c in enumerate(columns):
        cuts = [float("-inf"), *borders[c], float("inf")]
        missed = [F.when((F.col(f"hi{i}") < a) | (F.col(f"lo{i}") > b), 1.0).otherwise(0.0)
                  for a, b in zip(cuts, cuts[1:])]
        aggs.append(F.avg(sum(missed, F.lit(0.0)) / F.lit(len(missed))).alias(f"s{i}"))
    wide = ends.agg(*aggs)                             # one row per file goes in
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("files"),
                                                   F.col(f"s{i}").alias("skipped_share"))
                                          for i, c in enumerate(columns)])))


def file_skipping(stored: DataFrame, columns: Sequence[str], probes: int = PROBES) -> DataFrame:
    """What a stored table skips: (column_name, files, skipped_share)."""
    return _skipping(stored, columns, F.input_file_name(), probes)


def layout_advice(df: DataFrame, candidates: Sequence[Sequence[str]], filtered: Sequence[str], files: int = 64,
                  probes: int = PROBES) -> DataFrame:
    """L1 by measurement: every candidate (one column: ranges; two or three: the
    curve) is laid out over ``files`` parts, of the columns that matter only, and its
    skipping on each ``filtered`` column measured.  Ranked by the mean over them:
    layout, column_name, files, skipped_share, mean_share, rnk."""
    narrow = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*filtered, *[c for x in candidates for c in x]])])
    out = None
    for candidate in candidates:
        laid = (clustered(narrow, list(candidate), files) if len(candidate) == 1
                else clustered_by_curve(narrow, list(candidate), files))
        part = _skipping(laid, filtered, F.spark_partition_id(), probes).select(
            F.lit(",".join(candidate)).alias("layout"), "*")
        out = part if out is None else out.unionByName(part)
    mean = Window.partitionBy("layout")                # as many rows as there are candidates and columns
    return (out.withColumn("mean_share", F.avg("skipped_share").over(mean))
            .withColumn("rnk", F.dense_rank().over(Window.orderBy(F.desc("mean_share"), "layout")).cast("bigint")))
