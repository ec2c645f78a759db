"""Data-quality checks (Q1-Q9, A1).

Counting checks are folded into one aggregate so a whole check set is one
job over the data (the reference runs one ``count()`` job per check, each
re-evaluating the full plan).  Row-level checks return DataFrames; they are
never collected -- only the one-row summaries are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.functions.scalar import UNKNOWN_SK


class LoadCheckError(ValueError):
    """A fail-mode check found violations; the load stops before writing."""


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def count_checks(df: DataFrame, checks: Mapping[str, Column], rows_col: str | None = "rows") -> DataFrame:
    """A1: one aggregate with ``count_if(violation)`` per named check.

    ``checks`` maps output name -> boolean Column that is TRUE on a violating
    row (NULL counts as not violating).  Returns a one-row DataFrame.
    """
    aggs = [F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in checks.items()]
    if rows_col:
        aggs.append(F.count(F.lit(1)).alias(rows_col))
    return df.agg(*aggs)


def null_key_check(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Q1: count of rows with a null in any business-key column."""
    cond = None
    for k in _cols(key):
        c = F.col(k).isNull()
        cond = c if cond is None else cond | c
    return count_checks(df, {"null_keys": cond})


def unresolved_fk_check(df: DataFrame, sk_columns: Sequence[str], unknown: int = UNKNOWN_SK) -> DataFrame:
    """Q2: count of unknown-member keys per surrogate-key column, one pass."""
    return count_checks(df, {f"unresolved_{c}": F.col(c) == F.lit(unknown) for c in sk_columns})


def enforce(summary: DataFrame, message: str = "load check failed") -> dict[str, int]:
    """Fail-mode gate: collect the ONE summary row, raise if any check > 0."""
    row = summary.first().asDict()
    bad = {k: v for k, v in row.items() if k != "rows" and v}
    if bad:
        raise LoadCheckError(f"{message}: {bad}")
    return row


def reject_split(df: DataFrame, rules: Mapping[str, Column], reasons_col: str = "reject_reasons"):
    """Q3: attach the array of failed rule names; return (valid, rejected).

    Both halves come from the same annotated frame, so valid + rejected =
    input.  Callers persist/checkpoint the annotated frame before writing
    both halves when the source is expensive.
    """
    reason_exprs = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    annotated = df.withColumn(reasons_col, F.filter(F.array(*reason_exprs), lambda x: x.isNotNull()))
    valid = annotated.filter(F.size(reasons_col) == 0).drop(reasons_col)
    rejected = annotated.filter(F.size(reasons_col) > 0)
    return valid, rejected


def annotate_rejects(df: DataFrame, rules: Mapping[str, Column], reasons_col: str = "reject_reasons") -> DataFrame:
    reason_exprs = [F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return df.withColumn(reasons_col, F.filter(F.array(*reason_exprs), lambda x: x.isNotNull()))


def unique_check(df: DataFrame, key: str | Sequence[str], count_col: str = "n") -> DataFrame:
    """Q4/Q8: key values occurring more than once, with their counts.

    A hash aggregate with map-side partial counts: a hot key costs one
    partial row per map task, not one shuffled row per occurrence.
    """
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def not_null_check(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q5: (column_name, null_count) for each column, from ONE aggregate."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "null_count")


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str | Sequence[str],
               parent_key: str | Sequence[str] | None = None) -> DataFrame:
    """Q6: child rows whose non-null FK has no parent row.

    Rows with a null FK column pass (SQL foreign-key semantics).  The
    parent side is reduced to distinct keys before the anti join.
    """
    from starload.operators.lookup import anti_members

    fks = _cols(fk)
    notnull = None
    for k in fks:
        c = F.col(k).isNotNull()
        notnull = c if notnull is None else notnull & c
    return anti_members(child.filter(notnull), parent, fks, _cols(parent_key) if parent_key else fks)


def check_violations(df: DataFrame, predicate: str | Column) -> DataFrame:
    """Q7: rows where a CHECK predicate is FALSE; NULL passes, as in SQL."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~p)


def self_fk_orphans(df: DataFrame, key: str, ref: str) -> DataFrame:
    """Q9: rows whose self-reference (e.g. manager id) names no row of the
    same table; null references pass."""
    return fk_orphans(df, df, ref, key)
