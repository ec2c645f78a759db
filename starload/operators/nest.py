"""Grouped nesting: ordered string lists, parent rows with arrays of child
records, distinct sets per key (A2-A4, S5 text).

By default these aggregates build one output value per group, so a group's
children meet in one task; the groups of the registered queries are bounded
by the parent (lines per order, orders per customer).  ``chunk_size`` makes
any parent safe: children are numbered in (parent, order) order by the
distributed surrogate-key algorithm and grouped per (parent, chunk), so a
row and a task hold at most ``chunk_size`` children.  Ordering is explicit
(``array_sort`` on a struct whose first fields are the order keys, or
``WITHIN GROUP``), never the arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def with_chunks(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str], chunk_size: int,
                chunk_col: str = "chunk") -> DataFrame:
    """Number children within their parent without a per-parent task.

    Global positions in (parent, order keys) order come from the
    distributed surrogate-key numbering (range partitioning splits a hot
    parent over many tasks).  A parent's first position is taken per (parent,
    task) and then over the few tasks that hold the parent; the join back is on
    (parent, task), so no key of it holds more rows than one task does.
    ``chunk = (position - first) div chunk_size``.
    """
    from starload.operators.keys import assign_surrogate_keys

    # The numbered frame reads a checkpoint: its partitions are the same in both branches.
    numbered = assign_surrogate_keys(df, [*group_by, *order_by], sk="__pos").withColumn("__task", F.spark_partition_id())
    names = [f"__g_{g}" for g in group_by]
    parent = Window.partitionBy(*names)
    first = (numbered.groupBy(*[F.col(g).alias(n) for g, n in zip(group_by, names)],
                              F.col("__task").alias("__t")).agg(F.min("__pos").alias("__p"))
             .withColumn("__first", F.min("__p").over(parent)).drop("__p"))
    same = F.col("__task") == F.col("__t")
    for g, n in zip(group_by, names):        # a null parent is a parent
        same = same & F.col(g).eqNullSafe(F.col(n))
    return (numbered.join(first, same).drop(*names, "__task", "__t")
            .withColumn(chunk_col, ((F.col("__pos") - F.col("__first")) / F.lit(chunk_size)).cast("bigint"))
            .drop("__pos", "__first"))


def listagg_ordered(df: DataFrame, group_by: str | Sequence[str], value: str,
                    order_by: str | Sequence[str], sep: str = ",", alias: str = "list",
                    chunk_size: int | None = None) -> DataFrame:
    """A2: ``LISTAGG(value, sep) WITHIN GROUP (ORDER BY ...)`` per group.

    ``chunk_size`` bounds a row: a group becomes rows (group, chunk, text)
    of at most ``chunk_size`` values each, in order -- for parents that can
    hold an unbounded share of the rows."""
    groups, order = _cols(group_by), _cols(order_by)
    if chunk_size:
        df = df.select(*dict.fromkeys([*groups, *order, value]))
        df, groups = with_chunks(df, groups, order, chunk_size), [*groups, "chunk"]
    order_sql = ", ".join(f"`{c}`" for c in order)
    sep_sql = sep.replace("'", "''")
    expr = F.expr(f"listagg(cast(`{value}` as string), '{sep_sql}') within group (order by {order_sql})")
    return df.groupBy(*groups).agg(expr.alias(alias))


def nest_children(df: DataFrame, group_by: str | Sequence[str], order_by: str | Sequence[str],
                  fields: Sequence[str], alias: str = "children", as_json: bool = False,
                  chunk_size: int | None = None) -> DataFrame:
    """A3: one row per parent key with the ordered array of child records.

    Children are structs of ``order_by`` + ``fields`` sorted by the order
    keys; the order-key fields are dropped from the emitted records unless
    listed in ``fields``.  ``as_json`` renders the array with ``to_json``.
    ``chunk_size`` emits (parent, chunk, array) rows of at most that many
    children, in order, so no row or task holds an unbounded parent.
    """
    order = _cols(order_by)
    groups = _cols(group_by)
    if chunk_size:
        df = df.select(*dict.fromkeys([*groups, *order, *fields]))
        df, groups = with_chunks(df, groups, order, chunk_size), [*groups, "chunk"]
    record_fields = list(fields)
    sort_struct = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                           F.struct(*[F.col(c) for c in record_fields]).alias("__rec"))
    collected = F.array_sort(F.collect_list(sort_struct))
    records = F.transform(collected, lambda s: s["__rec"])
    if as_json:
        records = F.to_json(records)
    return df.groupBy(*groups).agg(records.alias(alias))


def collect_set_by_key(df: DataFrame, group_by: str | Sequence[str], value: str,
                       alias: str = "values", sep: str | None = ",") -> DataFrame:
    """A4: sorted distinct values per key (as text when ``sep`` is given)."""
    values = F.array_sort(F.collect_set(F.col(value)))
    if sep is not None:
        values = F.array_join(values, sep)
    return df.groupBy(*_cols(group_by)).agg(values.alias(alias))
