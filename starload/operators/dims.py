"""Dimension builders.

A dimension is: explicit mapping -> typed casts -> null fills -> business
key check -> de-duplication on the business key -> surrogate keys ->
parent lookups -> audit column -> ordered target projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.scalar import MIN_DATE
from starload.operators.keys import assign_surrogate_keys
from starload.operators.lookup import dim_lookup, missing_dim_default
from starload.operators.mapping import add_audit_column, fill_nulls, map_columns


COPIES, CONFLICT = "__key_copies", "__key_conflict"


def dedupe_on_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per business key (defect 2: the date dimension was never de-duplicated).

    The kept row is the smallest one by its other columns -- deterministic,
    so a stage recomputed after an executor loss yields the same attributes
    (``dropDuplicates`` keeps whichever row arrives first).  When a consumer
    reads only the key (a lookup), the row aggregate is pruned away.
    ``collapse_on_key`` also tells which keys had differing rows.
    """
    return collapse_on_key(df, key).select(*df.columns)


def collapse_on_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``dedupe_on_key`` with two more columns: ``COPIES``, the rows the key
    had, and ``CONFLICT``, whether they differ (exact duplicates do not)."""
    keys = list(key)
    others = [c for c in df.columns if c not in keys]
    copies = F.count(F.lit(1)).alias(COPIES)
    if not others:
        return df.groupBy(*keys).agg(copies).withColumn(CONFLICT, F.lit(False)).select(*df.columns, COPIES, CONFLICT)
    row = F.struct(*[F.col(c) for c in others])
    kept = df.groupBy(*keys).agg(copies, F.min(row).alias("__row"), F.max(row).alias("__top"))
    return (kept.withColumn(CONFLICT, ~F.col("__row").eqNullSafe(F.col("__top")))
            .select(*keys, *[F.col("__row")[c].alias(c) for c in others], COPIES, CONFLICT)
            .select(*df.columns, COPIES, CONFLICT))


def build_dimension(source: DataFrame, mapping: Sequence[tuple[str, str | Column]], business_key: Sequence[str],
                    sk: str, fill: Mapping[str, object] | None = None,
                    parents: Sequence[tuple[str | Sequence[str], DataFrame | None, str | Sequence[str], str, str]] = (),
                    load_ts: str | None = None, audit_col: str | None = "dt_insert",
                    dedupe: bool = True) -> DataFrame:
    """Build one dimension with surrogate keys.

    ``parents`` entries are ``(fk_cols, parent_dim_or_None, parent_key_cols,
    parent_sk, sk_as)``; a ``None`` parent gives the unknown member (J4).
    """
    df = map_columns(source, mapping)
    if fill:
        df = fill_nulls(df, fill)
    if dedupe:
        df = dedupe_on_key(df, business_key)
    df = assign_surrogate_keys(df, list(business_key), sk=sk, tiebreak=not dedupe)
    for fk, parent, parent_key, parent_sk, sk_as in parents:
        if parent is None:
            df = missing_dim_default(df, fk, sk_as)
        else:
            df = dim_lookup(df, parent, fk, parent_key, sk=parent_sk, sk_as=sk_as)
    if audit_col:
        df = add_audit_column(df, load_ts, audit_col)
    return df


def date_dim(date_columns: Sequence[tuple[DataFrame, str]], sk: str = "sk_date",
             load_ts: str | None = None, audit_col: str | None = None) -> DataFrame:
    """D3: date dimension from dates that occur in the data, never generated.

    Each input contributes the distinct ``to_date`` of one column (partial
    distinct per input before the union); null dates become 1900-01-01
    *before* day/month/year are derived (defect 1).  Columns: sk,
    date_value, day, month, year.
    """
    parts = None
    for df, col in date_columns:
        d = df.select(F.coalesce(F.to_date(F.col(col)), F.lit(MIN_DATE).cast("date")).alias("date_value")).distinct()
        parts = d if parts is None else parts.unionByName(d)
    dates = parts.distinct()
    keyed = assign_surrogate_keys(dates, "date_value", sk=sk, tiebreak=False)
    out = keyed.select(sk, "date_value",
                       F.dayofmonth("date_value").alias("day"),
                       F.month("date_value").alias("month"),
                       F.year("date_value").alias("year"))
    if audit_col:
        out = add_audit_column(out, load_ts, audit_col)
    return out


def split_hierarchy(df: DataFrame, attributes: Sequence[str], sk: str) -> tuple[DataFrame, DataFrame]:
    """Move hierarchy attributes into their own dimension.

    Returns ``(parent_dim, child)``: the distinct attribute combinations with
    surrogate keys, and the input with the attributes replaced by ``sk``.
    """
    attrs = list(attributes)
    parent = assign_surrogate_keys(df.select(*attrs).distinct(), attrs, sk=sk, tiebreak=False)
    # Null-safe: a row whose attributes are partly null has its parent as well.
    keys = parent.select(*[F.col(a).alias(f"__p_{a}") for a in attrs], F.col(sk).alias("__p_sk"))
    same = None
    for a in attrs:
        c = F.col(a).eqNullSafe(F.col(f"__p_{a}"))
        same = c if same is None else same & c
    child = (df.join(keys, same, "left").withColumn(sk, F.col("__p_sk"))
             .drop("__p_sk", *attrs, *[f"__p_{a}" for a in attrs]))
    return parent, child
