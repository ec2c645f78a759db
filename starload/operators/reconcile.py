"""Source/target comparison.

``reconcile`` digests each row to one 64-bit hash and folds each side to
(key, count, digest sum) *before* the join: the shuffles carry no compared
columns, and repeated keys never multiply in the join.  ``reconcile_ranges``
digests key ranges first and joins only the ranges that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

MATCH, CHANGED, MISSING, EXTRA = "match", "changed", "missing", "extra"


def row_digest(columns: Sequence[str]):
    # xxhash64 skips nulls, so each column goes in with its null marker:
    # (a, null) and (null, a) hash differently.
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))], F.lit(0))


def _fingerprints(df: DataFrame, keys: Sequence[str], cols: Sequence[str], tag: str) -> DataFrame:
    """Per key: row count and the sum of row digests (as decimal(38,0), so it
    cannot overflow).  Both are algebraic, so the aggregate combines
    map-side and a key repeated in a third of all rows still ends as one
    row -- the full outer join after it is 1:1 per key, never all pairs."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"__n{tag}"),
        F.sum(row_digest(cols).cast("decimal(38,0)")).alias(f"__h{tag}"))


def reconcile_rows(source: DataFrame, target: DataFrame, key: str | Sequence[str],
                   compare: Sequence[str] | None = None) -> DataFrame:
    """Per key: match / changed / missing (in source, not target) / extra.

    A key matches when both sides hold the same multiset of compared rows
    (same count, same digest sum); for unique keys that is row equality."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(compare) if compare is not None else [c for c in source.columns if c not in keys]
    s = _fingerprints(source, keys, cols, "s")
    t = _fingerprints(target, keys, cols, "t")
    # Null keys are keys too: reconcile(x, x) is all match.
    t = t.select([F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)] + ["__nt", "__ht"])
    same = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__k{i}"))
        same = c if same is None else same & c
    joined = s.join(t, same, "full_outer")
    present = F.col("__ns").isNotNull()
    keyed = [F.when(present, F.col(k)).otherwise(F.col(f"__k{i}")).alias(k) for i, k in enumerate(keys)]
    status = (F.when(F.col("__nt").isNull(), F.lit(MISSING))
              .when(F.col("__ns").isNull(), F.lit(EXTRA))
              .when((F.col("__ns") == F.col("__nt")) & (F.col("__hs") == F.col("__ht")), F.lit(MATCH))
              .otherwise(F.lit(CHANGED)))
    return joined.select(*keyed, status.alias("status"))


def reconcile(source: DataFrame, target: DataFrame, key: str | Sequence[str],
              compare: Sequence[str] | None = None) -> DataFrame:
    """Q10: counts per status, from one aggregate unpivoted to four rows
    (every status is present, zero when absent)."""
    rows = reconcile_rows(source, target, key, compare)
    wide = rows.agg(*[F.count_if(F.col("status") == F.lit(s)).alias(s) for s in (MATCH, CHANGED, MISSING, EXTRA)])
    return wide.unpivot([], [MATCH, CHANGED, MISSING, EXTRA], "status", "n")


RANGES = 4096        # key ranges digested in the first pass: what reaches the driver, whatever the rows
INTERVALS = 32       # of differing ranges, pushed to the scan

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)


def _range_of(key: str, lo: int, width: int) -> Column:
    return F.coalesce(F.floor((F.col(key).cast("decimal(38,0)") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(-1))


def _hash_range(keys: Sequence[str], ranges: int) -> Column:
    return F.pmod(row_digest(keys), F.lit(ranges)).cast("int")


def _intervals(ranges: Sequence[int], most: int) -> list[tuple[int, int]]:
    """At most ``most`` intervals that cover the ranges: the widest gaps stay out."""
    ranges = sorted(ranges)
    gaps = sorted(zip(ranges, ranges[1:]), key=lambda g: g[0] - g[1])[:most - 1]
    cuts = sorted(g for g in gaps if g[1] - g[0] > 1)
    starts = [ranges[0], *[b for _, b in cuts]]
    ends = [*[a for a, _ in cuts], ranges[-1]]
    return list(zip(starts, ends))


def differing_ranges(source: DataFrame, target: DataFrame, key: str | Sequence[str],
                     compare: Sequence[str] | None = None, ranges: int = RANGES):
    """First level: both sides folded to one digest per key range in one pass.

    Returns (range of a row as a Column, ranges that differ, rows of the ranges
    that agree, filter that the scan can use).  A single whole-number key is cut
    into ranges of equal width; other keys by their hash.  The shuffle carries a
    row per task and range, no key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    cols = list(compare) if compare is not None else [c for c in source.columns if c not in keys]
    lo = width = None
    bucket = _hash_range(keys, ranges)
    if len(keys) == 1 and all(isinstance(d.schema[keys[0]].dataType, _INTEGRAL) for d in (source, target)):
        ends = (source.select(keys[0]).unionByName(target.select(keys[0]))
                .agg(F.min(keys[0]).alias("lo"), F.max(keys[0]).alias("hi")).first())
        if ends.lo is not None:
            lo, width = int(ends.lo), (int(ends.hi) - int(ends.lo)) // ranges + 1
            bucket = _range_of(keys[0], lo, width)

    def folded(df: DataFrame, side: int) -> DataFrame:
        first = F.xxhash64(row_digest([*keys, *cols])).cast("decimal(38,0)")
        second = F.xxhash64(row_digest([*cols, *keys]), F.lit(7)).cast("decimal(38,0)")
        return df.select(bucket.alias("__range"), F.lit(side).alias("__n"), (first * side).alias("__a"),
                         (second * side).alias("__b"))

    # Source rows count +1, target rows -1: equal ranges sum to nothing.
    both = folded(source, 1).unionByName(folded(target, -1)).groupBy("__range").agg(
        F.sum("__n").alias("n"), F.sum("__a").alias("a"), F.sum("__b").alias("b"),
        F.count_if(F.col("__n") > 0).alias("rows"))
    found = both.collect()                       # at most ``ranges`` + 1 rows
    differ = sorted(r["__range"] for r in found if r.n or r.a or r.b)
    agreed = sum(r.rows for r in found if not (r.n or r.a or r.b))
    pushed = None
    if lo is not None and differ:
        k = F.col(keys[0])
        whole = [r for r in differ if r >= 0]
        for a, b in _intervals(whole, INTERVALS) if whole else []:
            part = k.between(lo + a * width, min(lo + (b + 1) * width - 1, int(ends.hi)))
            pushed = part if pushed is None else pushed | part
        if differ[0] < 0:
            pushed = k.isNull() if pushed is None else pushed | k.isNull()
    return bucket, differ, agreed, pushed


def reconcile_ranges(source: DataFrame, target: DataFrame, key: str | Sequence[str],
                     compare: Sequence[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """Q10 in two levels: counts per status as ``reconcile``, but only the rows of
    key ranges whose digests differ are read again and joined.

    Two tables that agree shuffle no key at all; a few changed rows cost the
    ranges they lie in.  A row of a range that agrees counts as one match, so with
    a unique key the counts are those of ``reconcile``.
    """
    bucket, differ, agreed, pushed = differing_ranges(source, target, key, compare, ranges)
    spark = source.sparkSession
    if not differ:
        return spark.createDataFrame([(s, agreed if s == MATCH else 0) for s in (MATCH, CHANGED, MISSING, EXTRA)],
                                     "status string, n long")

    def part(df: DataFrame) -> DataFrame:
        return (df.filter(pushed) if pushed is not None else df).filter(bucket.isin(differ))

    counts = reconcile(part(source), part(target), key, compare)
    return counts.withColumn("n", F.col("n") + F.when(F.col("status") == MATCH, F.lit(agreed)).otherwise(F.lit(0)))


def set_difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Multiset difference sizes both ways and the equality verdict.

    Both ``exceptAll`` directions are counted in one pass: rows are tagged
    +1 (left) / -1 (right), summed per distinct row (map-side partial sums),
    and the positive / negative remainders are the two difference sizes.
    """
    cols = left.columns
    tagged = (left.select(*cols, F.lit(1).alias("__side"))
              .unionByName(right.select(*cols, F.lit(-1).alias("__side"))))
    per_row = tagged.groupBy(*cols).agg(F.sum("__side").alias("__d"))
    wide = per_row.agg(
        F.coalesce(F.sum(F.when(F.col("__d") > 0, F.col("__d"))), F.lit(0)).cast("bigint").alias("left_only"),
        F.coalesce(F.sum(F.when(F.col("__d") < 0, -F.col("__d"))), F.lit(0)).cast("bigint").alias("right_only"))
    wide = wide.withColumn("equal", (F.col("left_only") + F.col("right_only")) == 0)
    return wide.unpivot(["equal"], ["left_only", "right_only"], "side", "n").select("side", "n", "equal")
