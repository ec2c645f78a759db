"""Dimension lookups and membership joins.

Join strategy: none is forced.  The lookup side carries just the business key
and the surrogate key; AQE broadcasts it when its measured size is small, and
otherwise splits skewed fact partitions (left outer / semi / anti joins keep the
large side splittable).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.scalar import UNKNOWN_SK

# How a foreign key resolved: kept apart although parity mode folds all to -1.
STATUS_FOUND = "found"
STATUS_NULL = "null_key"
STATUS_ORPHAN = "orphan"
STATUS_NO_DIM = "no_dimension"


def _as_list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def dim_lookup(df: DataFrame, dim: DataFrame, fk: str | Sequence[str],
               dim_key: str | Sequence[str] | None = None, sk: str = "sk",
               sk_as: str | None = None, unknown: int = UNKNOWN_SK,
               keep_fk: bool = False, status_col: str | None = None,
               broadcast: bool = False) -> DataFrame:
    """Left outer equi-join on the business key, take the surrogate key,
    unknown -> ``-1``, drop the natural key (P4).

    ``fk`` columns of ``df`` match ``dim_key`` columns of ``dim`` by
    position.  Only ``dim_key`` + ``sk`` of the dimension are read (column
    pruning reaches the scan).  The dimension must be unique on its key --
    otherwise the lookup multiplies fact rows (checked by ``unique_check``).
    ``status_col`` adds found / null_key / orphan so null and orphan keys stay
    distinguishable.  ``broadcast=True`` is for a
    side whose size the caller has bounded.
    """
    fks = _as_list(fk)
    keys = _as_list(dim_key) if dim_key is not None else fks
    out_sk = sk_as or sk
    # Aliased key names avoid the ambiguous same-name drop of the reference.
    tmp = [f"__lk_{i}" for i in range(len(keys))]
    lookup = dim.select([F.col(k).alias(t) for k, t in zip(keys, tmp)] + [F.col(sk).alias("__lk_sk")])
    if broadcast:
        lookup = F.broadcast(lookup)
    cond = None
    for f, t in zip(fks, tmp):
        c = df[f] == lookup[t]
        cond = c if cond is None else cond & c
    joined = df.join(lookup, cond, "left")
    result = joined.withColumn(out_sk, F.coalesce(F.col("__lk_sk").cast("bigint"), F.lit(unknown).cast("bigint")))
    if status_col:
        any_null = None
        for f in fks:
            c = F.col(f).isNull()
            any_null = c if any_null is None else any_null | c
        result = result.withColumn(
            status_col,
            F.when(any_null, F.lit(STATUS_NULL))
            .when(F.col("__lk_sk").isNull(), F.lit(STATUS_ORPHAN))
            .otherwise(F.lit(STATUS_FOUND)))
    result = result.drop("__lk_sk", *tmp)
    if not keep_fk:
        result = result.drop(*[f for f in fks if f != out_sk])
    return result


def date_lookup(df: DataFrame, date_dim: DataFrame, date_col: str, sk: str = "sk_date",
                dim_date_col: str = "date_value", sk_as: str | None = None,
                keep_fk: bool = False, broadcast: bool = False) -> DataFrame:
    """Lookup on a derived key, ``to_date`` of a timestamp/text column.
    Still a hash equi-join: the key is computed before the join."""
    key = f"__date_{date_col}"
    with_key = df.withColumn(key, F.to_date(F.col(date_col)))
    out = dim_lookup(with_key, date_dim, key, dim_date_col, sk=sk, sk_as=sk_as, keep_fk=False,
                     broadcast=broadcast)
    return out if keep_fk else out.drop(date_col)


def missing_dim_default(df: DataFrame, fk: str | Sequence[str], sk_as: str,
                        unknown: int = UNKNOWN_SK, status_col: str | None = None) -> DataFrame:
    """The parent dimension is absent -> every row gets the unknown member."""
    out = df.withColumn(sk_as, F.lit(unknown).cast("bigint"))
    if status_col:
        out = out.withColumn(status_col, F.lit(STATUS_NO_DIM))
    return out.drop(*_as_list(fk))


def _distinct_keys(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The key side of a semi/anti join, pre-aggregated before any shuffle.

    Keys are de-duplicated per (key, input task): map-side partial aggregation
    collapses a hot key to one row per task, and because that grouping is
    not the join key the join gets its own exchange -- which AQE can split
    when one key holds a large share of the big side, or turn into a broadcast
    when it measures a small one.  Duplicate keys left on this side do not
    change a semi or anti join.
    """
    selected = df.select([F.col(k).alias(n) for k, n in zip(keys, names)])
    return (selected.withColumn("__task", F.spark_partition_id())
            .distinct().drop("__task"))


def semi_members(df: DataFrame, other: DataFrame, on: str | Sequence[str],
                 other_on: str | Sequence[str] | None = None) -> DataFrame:
    """J7 (``in``): rows of ``df`` whose key occurs in ``other``."""
    left = _as_list(on)
    right = _as_list(other_on) if other_on is not None else left
    tmp = [f"__m_{i}" for i in range(len(left))]
    keys = _distinct_keys(other, right, tmp)
    cond = None
    for lk, t in zip(left, tmp):
        c = df[lk] == keys[t]
        cond = c if cond is None else cond & c
    return df.join(keys, cond, "left_semi")


def anti_members(df: DataFrame, other: DataFrame, on: str | Sequence[str],
                 other_on: str | Sequence[str] | None = None) -> DataFrame:
    """J7 (``not in`` without SQL's null trap): rows of ``df`` whose key does
    not occur in ``other``.  A null key is never 'in' anything, so it is kept."""
    left = _as_list(on)
    right = _as_list(other_on) if other_on is not None else left
    tmp = [f"__m_{i}" for i in range(len(left))]
    keys = _distinct_keys(other, right, tmp)
    cond = None
    for lk, t in zip(left, tmp):
        c = df[lk] == keys[t]
        cond = c if cond is None else cond & c
    return df.join(keys, cond, "left_anti")


def join_on_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                 right_keys: Sequence[str] | None = None, how: str = "inner", split_hot: bool = False) -> DataFrame:
    """Equi-join on a composite key given as two aligned column lists.

    A right side that is already distributed by the key, as an aggregate on it,
    has no exchange in the join, and without one AQE cannot split a hot key of the
    left side.  ``split_hot=True`` distributes the right side anew (its rows travel
    twice), so both sides have their own exchange."""
    if split_hot:
        right = right.hint("rebalance")
    right_keys = list(right_keys) if right_keys is not None else list(left_keys)
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, cond, how)
