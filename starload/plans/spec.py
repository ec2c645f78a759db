"""Declarative target-table specifications.

A ``TableSpec`` replaces the reference's generated per-table function: the
column mapping, business key, null policy, lookups, checks and reject mode
of one warehouse table.  ``build_table`` turns a spec into a DataFrame
plan; nothing is executed except the checks the spec asks to enforce.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.functions.scalar import UNKNOWN_SK
from starload.operators.dims import CONFLICT, COPIES, collapse_on_key
from starload.operators.keys import assign_surrogate_keys
from starload.operators.lookup import STATUS_FOUND, STATUS_ORPHAN, dim_lookup, missing_dim_default
from starload.operators.mapping import add_audit_column, conform_schema, fill_nulls, map_columns
from starload.operators.quality import LoadCheckError, annotate_rejects, count_checks
from starload.session import materialize

FAIL, REJECT, KEEP = "fail", "reject", "keep"
REASONS = "reject_reasons"
AHEAD = "__ahead_"


@dataclass
class Lookup:
    """Resolve ``fk`` columns against dimension ``dim`` (by ``dim_key``) into
    ``sk_as``.  ``date=True`` joins on ``to_date`` of the single fk column.
    ``on_missing``: fail / reject / keep (keep = store the -1 member).
    ``at``: the source table (and its column) a single, unfilled fk comes from, where
    that has fewer rows than the joined source: looked up there, before the join."""
    fk: list[str]
    dim: str
    dim_key: list[str]
    sk_as: str
    date: bool = False
    on_missing: str = FAIL
    dim_sk: str | None = None   # default: the dimension's first sk_ column
    at: tuple[str, str] | None = None

    @property
    def ahead(self) -> str:
        """The column that carries a key looked up before the join; null: not found."""
        return f"{AHEAD}{self.sk_as}"

    def sk_of(self, dim: DataFrame) -> str:
        return self.dim_sk or next(c for c in dim.columns if c.startswith("sk_"))


@dataclass
class TableSpec:
    target: str
    source: str | Callable[[Mapping[str, DataFrame]], DataFrame]
    columns: list[tuple[str, str | Column]]
    kind: str = "dimension"                      # dimension | fact
    business_key: list[str] = field(default_factory=list)
    sk: str | None = None                        # own surrogate key (dimensions)
    fill: dict[str, object] = field(default_factory=dict)
    lookups: list[Lookup] = field(default_factory=list)
    checks: dict[str, str] = field(default_factory=dict)   # name -> SQL predicate that must hold
    on_null_key: str = FAIL
    on_duplicate_key: str = FAIL                 # differing rows of one key: fail / reject all / keep the smallest
    on_check: str = FAIL
    schema: StructType | None = None             # declared target types / column order
    cluster_by: list[str] = field(default_factory=list)
    keep_natural: list[str] = field(default_factory=list)  # natural keys kept (D7)

    @property
    def parents(self) -> list[str]:
        return sorted({lk.dim for lk in self.lookups})


def topological_order(specs: list[TableSpec]) -> list[TableSpec]:
    """Parents before children; dimensions before facts; stable."""
    by_name = {s.target: s for s in specs}
    done: list[TableSpec] = []
    seen: set[str] = set()
    visiting: set[str] = set()

    def visit(s: TableSpec) -> None:
        if s.target in seen:
            return
        if s.target in visiting:
            raise ValueError(f"cycle through {s.target}")
        visiting.add(s.target)
        for p in s.parents:
            if p in by_name:
                visit(by_name[p])
        visiting.discard(s.target)
        seen.add(s.target)
        done.append(s)

    for s in sorted(specs, key=lambda s: s.kind != "dimension"):
        visit(s)
    return done


def dependency_levels(specs: list[TableSpec]) -> list[list[TableSpec]]:
    """Specs grouped so every table's parents sit in an earlier level; the
    tables of one level are independent and can load concurrently."""
    names = {s.target for s in specs}
    level: dict[str, int] = {}
    for s in topological_order(specs):
        level[s.target] = 1 + max((level[p] for p in s.parents if p in names), default=-1)
        if s.kind != "dimension":
            level[s.target] = max(level[s.target], 1 + max(
                (level[d.target] for d in specs if d.kind == "dimension" and d.target in level), default=-1))
    out: list[list[TableSpec]] = []
    for s in topological_order(specs):
        while len(out) <= level[s.target]:
            out.append([])
        out[level[s.target]].append(s)
    return [lv for lv in out if lv]


def run_level(fn, items: list, max_workers: int) -> list:
    """Run ``fn`` over one level's items on driver threads (Spark schedules
    their jobs side by side); the first error is raised after all finish."""
    if max_workers <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=min(max_workers, len(items))) as pool:
        futures = [pool.submit(fn, x) for x in items]
    return [f.result() for f in futures]


def source_frame(spec: TableSpec, sources: Mapping[str, DataFrame]) -> DataFrame:
    return spec.source(sources) if callable(spec.source) else sources[spec.source]


def _key_null(cols: list[str]) -> Column:
    cond = None
    for k in cols:
        c = F.col(k).isNull()
        cond = c if cond is None else cond | c
    return cond


def mapped_rows(spec: TableSpec, sources: Mapping[str, DataFrame],
                dims: Mapping[str, DataFrame | None] | None = None) -> DataFrame:
    """The spec's columns from its source, nulls filled.  With ``dims``, the keys of
    lookups that name a smaller source table are found there and carried along."""
    sources, carried = dict(sources), []
    for lk in spec.lookups:
        dim = (dims or {}).get(lk.dim)
        if lk.at is None or dim is None:
            continue
        table, column = lk.at
        key, status = f"__key_{lk.sk_as}", f"__st_{lk.sk_as}"
        side = sources[table].withColumn(key, F.to_date(F.col(column)) if lk.date else F.col(column))
        side = dim_lookup(side, dim, key, lk.dim_key, sk=lk.sk_of(dim), sk_as=lk.ahead, status_col=status)
        sources[table] = side.withColumn(lk.ahead, F.when(F.col(status) == F.lit(STATUS_FOUND), F.col(lk.ahead))).drop(status)
        carried.append((lk.ahead, lk.ahead))
    df = map_columns(source_frame(spec, sources), [*spec.columns, *carried])
    return fill_nulls(df, spec.fill) if spec.fill else df


def any_of(reasons: list[str]) -> Column:
    """Whether a row has one of these reasons."""
    return F.exists(F.col(REASONS), lambda r: r.isin(reasons)) if reasons else F.lit(False)


@dataclass
class Planned:
    """A table's rows with their reasons, before valid and rejected part."""
    df: DataFrame                                   # with REASONS; a dimension is numbered already
    fail: dict[str, Column]                         # rules that stop the load, still to be counted
    rejecting: list[str]                            # reasons that reject a row
    key_rejects: list[DataFrame] = field(default_factory=list)


def plan_table(spec: TableSpec, mapped: DataFrame, dims: Mapping[str, DataFrame | None],
               existing: DataFrame | None = None, stats: dict | None = None,
               source_col: str | None = None) -> Planned:
    """Look up and judge every mapped row; number a dimension's valid rows.

    Where lookups or checks can reject, a dimension is numbered after them, so
    stored keys are dense: rejected rows are ordered behind the valid ones in the
    same numbering, and fail-mode rules are counted in its per-partition job.
    Otherwise it is numbered first, which spares the range sampling the lookups.
    ``source_col`` keeps the mapped row as a struct (columns named ``__...`` are
    carried through, but are no part of it).
    """
    df = mapped
    rules: dict[str, Column] = {}
    modes: dict[str, str] = {}
    key_rejects: list[DataFrame] = []
    is_dim = spec.kind == "dimension" and bool(spec.business_key)
    source = F.struct(*[c for c in mapped.columns if not c.startswith("__")])
    if is_dim and spec.on_null_key == REJECT:
        key_rejects.append(df.filter(_key_null(spec.business_key)).withColumn(
            REASONS, F.array(F.lit("null_business_key"))))
    elif spec.business_key and not is_dim:
        rules["null_business_key"] = _key_null(spec.business_key)
        modes["null_business_key"] = spec.on_null_key
    for name, predicate in spec.checks.items():
        rules[f"check_{name}"] = ~F.expr(predicate)
        modes[f"check_{name}"] = spec.on_check

    null = _key_null(spec.business_key) if spec.business_key else None
    start: int | Column = 1
    if is_dim:
        # Fail mode numbers null keys too and counts them there; reject mode
        # removes them first (they went to the rejects).
        keyed = df.filter(~null) if spec.on_null_key == REJECT else df
        if spec.on_duplicate_key == REJECT:
            conflicts = collapse_on_key(keyed, spec.business_key).filter(F.col(CONFLICT)).select(*spec.business_key)
            key_rejects.append(keyed.distinct().join(conflicts, spec.business_key, "left_semi")
                               .select(*keyed.columns)
                               .withColumn(REASONS, F.array(F.lit("duplicate_business_key"))))
        keyed = collapse_on_key(keyed, spec.business_key)
        if spec.on_duplicate_key == REJECT:
            keyed = keyed.filter(~F.col(CONFLICT) | null)
        if existing is not None:
            from starload.operators.lookup import anti_members
            keyed = anti_members(keyed, existing, spec.business_key)
            start = F.coalesce(existing.select(F.max(F.col(spec.sk))).scalar(), F.lit(0)) + F.lit(1)
        df = keyed
    late = is_dim and (any(lk.on_missing == REJECT for lk in spec.lookups)
                       or bool(spec.checks) and spec.on_check == REJECT)

    def number(df: DataFrame, checks: dict[str, Column], refused: Column | None) -> DataFrame:
        # Counted per source row (nulls) and per key (differing rows); a key already
        # stored keeps its stored row and is not numbered again.
        if spec.on_null_key == FAIL:
            checks["null_business_key"] = F.sum(F.when(null, F.col(COPIES)))
        if spec.on_duplicate_key == FAIL:
            checks["duplicate_business_key"] = F.count_if(F.col(CONFLICT) & ~null)
        apart = {} if refused is None else {"refused": F.count_if(refused)}
        sk_stats: dict = {}
        # Unique after de-duplication: no tie breaker needed.
        df = assign_surrogate_keys(df, [*([] if refused is None else [refused]), *spec.business_key], sk=spec.sk,
                                   start=start, stats=sk_stats, tiebreak=False, checks={**checks, **apart},
                                   scratch=(COPIES, CONFLICT))
        bad = {n: sk_stats[n] for n in checks if sk_stats[n]}
        if bad:
            raise LoadCheckError(f"{spec.target}: {bad}")
        if stats is not None:
            stats["rows"] = sk_stats["rows"] - sk_stats.get("refused", 0)
        return df

    if is_dim and not late:
        df = number(df, {}, None)
    if source_col:
        df = df.withColumn(source_col, source)
        key_rejects = [r.withColumn(source_col, source) for r in key_rejects]

    for lk in spec.lookups:
        dim = dims.get(lk.dim)
        status = f"__st_{lk.sk_as}"
        if dim is None:
            df = missing_dim_default(df, lk.fk, lk.sk_as, status_col=status)
        elif lk.ahead in df.columns:
            found = F.col(lk.ahead)
            df = (df.withColumn(lk.sk_as, F.coalesce(found, F.lit(UNKNOWN_SK).cast("bigint")))
                  .withColumn(status, F.when(found.isNull(), F.lit(STATUS_ORPHAN)).otherwise(F.lit(STATUS_FOUND)))
                  .drop(lk.ahead, *[c for c in lk.fk if c not in spec.keep_natural]))
        elif lk.date:
            dim_sk = lk.sk_of(dim)
            key = f"__date_{lk.sk_as}"
            df = df.withColumn(key, F.to_date(F.col(lk.fk[0])))
            df = dim_lookup(df, dim, key, lk.dim_key, sk=dim_sk, sk_as=lk.sk_as, status_col=status)
            if lk.fk[0] not in spec.keep_natural:
                df = df.drop(lk.fk[0])
        else:
            dim_sk = lk.sk_of(dim)
            df = dim_lookup(df, dim, lk.fk, lk.dim_key, sk=dim_sk, sk_as=lk.sk_as, status_col=status,
                            keep_fk=bool(set(lk.fk) & set(spec.keep_natural)))
        rules[f"unresolved_{lk.sk_as}"] = F.col(status) != F.lit("found")
        modes[f"unresolved_{lk.sk_as}"] = lk.on_missing

    df = annotate_rejects(df, rules, REASONS) if rules else df.withColumn(REASONS, F.array().cast("array<string>"))
    df = df.drop(*[c for c in df.columns if c.startswith("__st_")])
    fail = {n: F.array_contains(F.col(REASONS), n) for n, m in modes.items() if m == FAIL}
    rejecting = [n for n, m in modes.items() if m == REJECT]
    if not late:
        return Planned(df, fail, rejecting, key_rejects)
    df = number(df, {n: F.count_if(c) for n, c in fail.items()}, any_of(rejecting))
    return Planned(df, {}, rejecting, key_rejects)


def split_rejected(spec: TableSpec, plan: Planned, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Valid and rejected rows of a planned table."""
    rejected = None
    if plan.rejecting:
        refused = any_of(plan.rejecting)
        rejected = df.filter(refused)
        if spec.sk and spec.sk in df.columns:
            rejected = rejected.drop(spec.sk)
        df = df.filter(~refused)
    for more in plan.key_rejects:
        rejected = more if rejected is None else rejected.unionByName(more, allowMissingColumns=True)
    return df.drop(REASONS), rejected


def build_table(spec: TableSpec, sources: Mapping[str, DataFrame], dims: Mapping[str, DataFrame | None],
                load_ts: str | None = None, audit_col: str | None = "dt_insert",
                existing: DataFrame | None = None,
                materialize_checked: bool = False, stats: dict | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Plan one target table.  Returns ``(valid, rejected_or_None)``.

    ``existing`` (the target as loaded so far) makes a dimension load append
    only new business keys, numbering them after the stored maximum.
    ``materialize_checked`` checkpoints a fact once and observes the fail-mode
    counts during that same pass (``Observation``); otherwise they are counted
    in ONE aggregate.  ``stats`` receives a dimension's row count.
    """
    plan = plan_table(spec, mapped_rows(spec, sources, dims), dims, existing, stats)
    df, summary = plan.df, {}
    stored = df.columns if plan.rejecting else [c for c in df.columns if c != REASONS]
    if spec.kind != "dimension" and materialize_checked:
        if plan.fail:
            observed = Observation(f"checks_{spec.target}")
            df = materialize(df.observe(observed, *[F.count_if(c).alias(n) for n, c in plan.fail.items()])
                             .select(*stored))
            summary = observed.get
        else:
            df = materialize(df.select(*stored))
    elif plan.fail:
        summary = count_checks(df, plan.fail, rows_col=None).first().asDict()
    bad = {k: v for k, v in summary.items() if v}
    if bad:
        raise LoadCheckError(f"{spec.target}: {bad}")
    valid, rejected = split_rejected(spec, plan, df)
    return finished(spec, valid, load_ts, audit_col), rejected


def finished(spec: TableSpec, valid: DataFrame, load_ts: str | None, audit_col: str | None) -> DataFrame:
    """Declared types and column order, and the audit column."""
    if spec.schema is not None:
        valid = conform_schema(valid, spec.schema, allow_missing=False)
    return add_audit_column(valid, load_ts, audit_col) if audit_col else valid


__all__ = ["Lookup", "TableSpec", "topological_order", "dependency_levels", "run_level", "build_table",
           "source_frame", "mapped_rows", "plan_table", "Planned", "split_rejected", "finished", "any_of",
           "FAIL", "REJECT", "KEEP", "UNKNOWN_SK"]
