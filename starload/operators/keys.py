"""Surrogate keys without a single-task window.

``row_number() over (order by k)`` without PARTITION BY moves every row to
one task.  Instead:

1. range-partition on the order keys (plus a row-hash tie breaker, so a
   key shared by a third of all rows still spreads over several ranges),
   sort inside each partition and record ``(partition, position)`` in the
   same pass -- ``monotonically_increasing_id`` keeps the partition in its
   upper 31 bits and the row position in its lower 33 bits;
2. materialise that frame with a reliable checkpoint: range bounds are
   sampled, so the numbering must come from a single evaluation;
3. count rows per partition -- one number per partition, a list bounded by
   the partition count -- and turn the running sum into per-partition
   offsets on the driver;
4. ``sk = start + offsets[partition] + position``: the offsets are an array
   literal inside the projection, so no join and no second aggregate runs
   when the keyed frame is evaluated later.

The result equals ``row_number() over (order by keys)`` (ties broken by the
row hash) and needs one shuffle of the data plus the checkpoint write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.session import materialize

_PID = "__sk_pid"
_POS = "__sk_pos"


def _order_columns(df: DataFrame, order_by: Sequence[str | Column], tiebreak: bool) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if tiebreak:
        cols.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    return cols


def assign_surrogate_keys(df: DataFrame, order_by: str | Sequence[str | Column], sk: str = "sk",
                          start: int | Column = 1, num_partitions: int | None = None,
                          tiebreak: bool = True, first: bool = True,
                          stats: dict | None = None, checks: Mapping[str, Column] | None = None,
                          scratch: Sequence[str] = ()) -> DataFrame:
    """Dense sequential keys ``start, start+1, ...`` in ``order_by`` order.

    ``start`` may be a Column (e.g. a scalar subquery ``max(sk) + 1``).
    ``tiebreak`` adds a hash of the whole row as the last order key: it
    spreads a repeated key over several ranges, but it references every
    column; callers whose keys are unique (de-duplicated dimensions) turn it
    off so unused columns can be pruned.
    The output keeps the input columns and puts ``sk`` first when ``first``.
    ``stats`` (a dict) receives ``rows`` and the total of every aggregate in
    ``checks`` (whole numbers) -- from the per-partition count job that
    numbering needs anyway, so callers get row counts and key checks without
    another pass.  ``scratch`` columns serve the checks and are dropped.
    """
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    cols = [c for c in df.columns if c not in scratch]
    checks = dict(checks or {})
    ordering = _order_columns(df, order, tiebreak)
    out_cols = [sk, *cols] if first else [*cols, sk]
    start_col = start if isinstance(start, Column) else F.lit(start)

    # Without an explicit count the exchange uses spark.sql.shuffle.partitions
    # (sized for the cluster) and AQE merges adjacent small ranges; merged
    # ranges stay in key order, and the partition id is taken after merging.
    by_range = (df.repartitionByRange(num_partitions, *ordering) if num_partitions
                else df.repartitionByRange(*ordering))
    ranged = (by_range
              .sortWithinPartitions(*ordering)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id()
                          - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    ranged = materialize(ranged)
    per_part = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n"),
                                       *[c.alias(f"check_{n}") for n, c in checks.items()]).collect()
    counts = {r[_PID]: r["n"] for r in per_part}
    if stats is not None:
        stats["rows"] = sum(counts.values())
        for name in checks:
            stats[name] = sum(r[f"check_{name}"] or 0 for r in per_part)
    offsets, running = [], 0
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(running)
        running += counts.get(pid, 0)
    offset_of = (F.element_at(F.array(*[F.lit(o).cast("bigint") for o in offsets]), F.col(_PID) + 1)
                 if offsets else F.lit(0).cast("bigint"))
    keyed = ranged.withColumn(sk, (start_col.cast("bigint") + offset_of + F.col(_POS)).cast("bigint"))
    return keyed.select(*out_cols)


def assign_surrogate_keys_incremental(new_rows: DataFrame, existing: DataFrame, business_key: str | Sequence[str],
                                      sk: str = "sk", order_by: Sequence[str] | None = None,
                                      num_partitions: int | None = None) -> DataFrame:
    """Keys only for rows whose business key is not yet in ``existing``,
    continuing after ``max(existing.sk)``.

    The new rows are found by a left-anti join against the distinct existing
    keys; the offset is a scalar subquery, so nothing passes through Python.
    Returns only the newly keyed rows.
    """
    from starload.operators.lookup import anti_members

    bk = [business_key] if isinstance(business_key, str) else list(business_key)
    fresh = anti_members(new_rows, existing, bk)
    start = F.coalesce(existing.select(F.max(F.col(sk))).scalar(), F.lit(0)) + F.lit(1)
    return assign_surrogate_keys(fresh, order_by or bk, sk=sk, start=start, num_partitions=num_partitions)
