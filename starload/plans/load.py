"""Load a whole star in dependency order, all or nothing.

Parents come first: a table's parents are read back from what this load or an
earlier one has stored, so children reference stored surrogate keys.  Every
table goes into a fresh folder, once; fail-mode checks are observed by that very
write (facts) or by the numbering (dimensions).  After the last table one record
publishes all of them (``sources/published.py``): a load that fails or dies before
leaves readers with what they had, and the next load begins there.

Dimensions append business keys not yet stored (numbering continues after the
stored maximum).  A fact's rows belong to their load batch, and loading a batch
again replaces it, its rejects included, also by nothing.

Rejected rows go to ``<table>_rejected`` with their reasons and the mapped row
(``source_row``).  Those rejected for a missing parent alone are tried again with
every later batch: a fact row that now resolves is stored under the batch it came
with and noted in ``<table>_resolved``; a dimension row gets its key.  Loading its
own batch again supersedes both, so no order of reruns loads a row twice.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.operators.layout import clustered
from starload.operators.lookup import anti_members
from starload.operators.mapping import add_audit_column, conform_schema
from starload.operators.quality import LoadCheckError, count_checks
from starload.plans.spec import (REASONS, REJECT, TableSpec, any_of, dependency_levels, finished, mapped_rows,
                                 plan_table, run_level, split_rejected, topological_order)
from starload.sources.published import Warehouse
from starload.sources.warehouse import read_back, try_read_back

log = logging.getLogger("starload.load")

BATCH_COL = "load_batch"
SOURCE, REJECT_ID = "source_row", "reject_id"
_BATCH, _AGAIN = "__batch", "__again"      # of a row on its way: its batch; the reject it was


def _batch_id(spark: SparkSession, load_ts: str | None, batch_id: str | None = None) -> str:
    if batch_id is not None:
        return str(batch_id)
    if not load_ts:
        raise ValueError("load_ts or batch_id is required: a clock would make every rerun a new batch")
    return spark.range(1).select(F.date_format(F.lit(load_ts).cast("timestamp_ntz"), "yyyyMMddHHmmss")).first()[0]


def _parent(wh: Warehouse, table: str) -> DataFrame | None:
    loaded = wh.read(table)
    return loaded if loaded is not None else try_read_back(wh.spark, f"{wh.root}/{table}")


def _rejects(spec: TableSpec) -> bool:
    return (any(lk.on_missing == REJECT for lk in spec.lookups) or bool(spec.checks) and spec.on_check == REJECT
            or REJECT in (spec.on_null_key, spec.on_duplicate_key) and bool(spec.business_key))


def _replayable(spec: TableSpec) -> bool:
    return any(lk.on_missing == REJECT for lk in spec.lookups)


def open_rejects(wh: Warehouse, spec: TableSpec, batch: str | None = None) -> DataFrame | None:
    """Rows that only miss a parent and have not been loaded since (those of
    ``batch`` left out: a rerun judges its own rows anew)."""
    rejected = wh.read(f"{spec.target}_rejected", without=batch)
    if rejected is None:
        return None
    waiting = rejected.filter(F.forall(REASONS, lambda r: r.startswith("unresolved_")))
    if spec.kind == "dimension":
        stored = wh.read(spec.target)
        return anti_members(waiting, stored, spec.business_key) if stored is not None else waiting
    resolved = wh.read(f"{spec.target}_resolved", without=batch)
    return anti_members(waiting, resolved, [BATCH_COL, REJECT_ID]) if resolved is not None else waiting


def _reject_id() -> F.Column:
    """The row's identity within its batch; repeated rows share it."""
    return F.sha2(F.to_json(SOURCE), 256)


def _load_dimension(wh: Warehouse, spec: TableSpec, sources: Mapping[str, DataFrame], load_ts: str | None,
                    audit_col: str | None, batch: str) -> None:
    existing = _parent(wh, spec.target)
    mapped = mapped_rows(spec, sources)
    waiting = open_rejects(wh, spec, batch) if _replayable(spec) else None
    if waiting is not None:
        mapped = mapped.unionByName(waiting.select(f"{SOURCE}.*"))
    parents = {p: _parent(wh, p) for p in spec.parents}
    plan = plan_table(spec, mapped, parents, existing, source_col=SOURCE if _rejects(spec) else None)
    if plan.fail:
        bad = {n: v for n, v in count_checks(plan.df, plan.fail, rows_col=None).first().asDict().items() if v}
        if bad:
            raise LoadCheckError(f"{spec.target}: {bad}")
    valid, rejected = split_rejected(spec, plan, plan.df)
    if rejected is not None:
        if waiting is not None:       # still waiting: noted already
            rejected = anti_members(rejected, waiting, spec.business_key)
        rejected = rejected.withColumn(REJECT_ID, _reject_id()).withColumn(BATCH_COL, F.lit(batch))
        folder = wh.new_folder(f"{spec.target}_rejected")
        rejected.write.parquet(f"{wh.root}/{folder}")
        wh.stage(f"{spec.target}_rejected", batch, folder, True, rejected.schema)
    valid = finished(spec, valid.drop(SOURCE), load_ts, audit_col)
    if existing is not None:
        valid = conform_schema(valid, existing.schema, allow_missing=True)
    if spec.cluster_by:
        valid = clustered(valid, spec.cluster_by)
    folder = wh.new_folder(spec.target)
    valid.write.parquet(f"{wh.root}/{folder}")
    wh.stage(spec.target, batch, folder, False, valid.schema)


def _load_fact(wh: Warehouse, spec: TableSpec, sources: Mapping[str, DataFrame], load_ts: str | None,
               audit_col: str | None, batch: str) -> None:
    """One write: valid, rejected and resolved rows part by folder."""
    waiting = open_rejects(wh, spec, batch) if _replayable(spec) else None
    parents = {p: _parent(wh, p) for p in spec.parents}
    # Rejects that are tried again have only the mapped row: with them, every key is looked up there.
    rows = (mapped_rows(spec, sources, parents if waiting is None else None)
            .withColumn(_BATCH, F.lit(batch)).withColumn(_AGAIN, F.lit(None).cast("string")))
    if waiting is not None:
        rows = rows.unionByName(waiting.select(f"{SOURCE}.*", F.col(BATCH_COL).alias(_BATCH),
                                               F.col(REJECT_ID).alias(_AGAIN)))
    splits = _rejects(spec)
    plan = plan_table(spec, rows, parents, source_col=SOURCE if splits else None)
    df, observed = plan.df, Observation(f"checks_{spec.target}")
    if plan.fail:
        df = df.observe(observed, *[F.count_if(c).alias(n) for n, c in plan.fail.items()])
    helpers = (REASONS, SOURCE, _BATCH, _AGAIN)
    target = ([F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields] if spec.schema is not None
              else [F.col(c) for c in df.columns if c not in helpers])
    if splits:
        again, refused = F.col(_AGAIN).isNotNull(), any_of(plan.rejecting)
        verdicts = (F.when(refused & again, F.expr("cast(array() as array<string>)"))     # noted already
                    .when(refused, F.array(F.lit("rejected")))
                    .when(again, F.array(F.lit("valid"), F.lit("resolved"))).otherwise(F.array(F.lit("valid"))))
        df = df.withColumn("verdict", F.explode(verdicts))
        noted = F.col("verdict") == "rejected"
        out = df.select(*target, F.col(_BATCH).alias(BATCH_COL), F.when(noted, F.col(REASONS)).alias(REASONS),
                        F.when(noted, F.col(SOURCE)).alias(SOURCE),
                        F.when(noted, _reject_id()).otherwise(F.col(_AGAIN)).alias(REJECT_ID), "verdict",
                        F.col(_BATCH).alias("batch"))
    else:
        out = df.select(*target, F.col(_BATCH).alias(BATCH_COL))
    if audit_col:
        out = add_audit_column(out, load_ts, audit_col)
    if spec.cluster_by:
        out = clustered(out, spec.cluster_by)
    folder = wh.new_folder(spec.target)
    parts = ("verdict", "batch") if splits else ()
    (out.write.partitionBy(*parts) if parts else out.write).parquet(f"{wh.root}/{folder}")
    bad = {n: v for n, v in observed.get.items() if v} if plan.fail else {}
    if bad:
        raise LoadCheckError(f"{spec.target}: {bad}")

    def schema(*without: str) -> StructType:
        return StructType([f for f in out.schema.fields if f.name not in (*parts, *without)])

    valid, audited = schema(REASONS, SOURCE, REJECT_ID), [audit_col] if audit_col else []
    valid = StructType([f for n in [*[x for x in valid.names if x != BATCH_COL and x not in audited], *audited,
                                    BATCH_COL] for f in valid.fields if f.name == n])
    if not splits:
        wh.stage(spec.target, batch, folder, True, valid)
        return
    # The folders written: one per verdict and batch.
    found = {(r.verdict, r.batch) for r in wh.spark.read.schema(out.schema).parquet(f"{wh.root}/{folder}")
             .groupBy("verdict", "batch").agg(F.count(F.lit(1))).collect()}
    for verdict, table, kind in (("valid", spec.target, valid), ("rejected", f"{spec.target}_rejected", schema()),
                                 ("resolved", f"{spec.target}_resolved",
                                  StructType([f for f in out.schema.fields if f.name in (BATCH_COL, REJECT_ID)]))):
        for b in [batch, *sorted(b for v, b in found if v == verdict and b != batch)]:
            there = f"{folder}/verdict={verdict}/batch={_escaped(b)}" if (verdict, b) in found else None
            wh.stage(table, b, there, b == batch, kind)


def _escaped(value: str) -> str:
    """A partition value as Spark names its folder."""
    return "".join(f"%{ord(c):02X}" if c in "\"#%'*/:=?\\{[]^\x7f" or ord(c) < 32 else c for c in value)


def load_table(wh: Warehouse, spec: TableSpec, sources: Mapping[str, DataFrame], load_ts: str | None = None,
               audit_col: str | None = "dt_insert", batch: str = "") -> None:
    """Write one table's rows of this load, unpublished."""
    one = _load_dimension if spec.kind == "dimension" else _load_fact
    one(wh, spec, sources, load_ts, audit_col, batch)


def run_load(spark: SparkSession, specs: list[TableSpec], sources: Mapping[str, DataFrame], target_root: str,
             load_ts: str | None = None, audit_col: str | None = "dt_insert",
             batch_id: str | None = None, parallelism: int = 4, verify: bool = False) -> DataFrame:
    """Load every spec level by level (parents before children, facts
    last); the independent tables of a level load concurrently on up to
    ``parallelism`` driver threads.  A failure stops the load after its
    level, and nothing of it is published.  ``verify`` reconciles every
    dimension's business keys with its source after its level and stops the
    load on any difference (Q10 gate), before children build on it.  Returns
    (table_name, rows) read back from the warehouse."""
    order = topological_order(specs)
    wh = Warehouse(spark, target_root)
    batch = _batch_id(spark, load_ts, batch_id)

    def one(spec: TableSpec) -> None:
        log.info("loading %s", spec.target)
        try:
            load_table(wh, spec, sources, load_ts, audit_col, batch)
        except Exception:
            log.error("load stopped at %s", spec.target)
            raise

    for level in dependency_levels(specs):
        run_level(one, level, parallelism)
        if verify and any(s.kind == "dimension" for s in level):
            load_gate(reconcile_load(spark, level, sources, target_root, read=wh.read))
    wh.publish()
    counts = None
    for spec in order:
        c = wh.read(spec.target).agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(spec.target).alias("table_name"), "rows")
        counts = c if counts is None else counts.unionByName(c)
    return counts


def reconcile_load(spark: SparkSession, specs: list[TableSpec], sources: Mapping[str, DataFrame],
                   target_root: str, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Q10 after a load: per dimension, business keys of the source against
    the keys stored in the target (match / missing / extra; attributes are
    not compared because the target adds keys and audit columns).  Null
    source keys are left out: they never receive a surrogate key.  ``read``
    reads a stored table by name (a running load's own, unpublished ones)."""
    from starload.operators.mapping import map_columns
    from starload.operators.reconcile import reconcile
    from starload.plans.spec import source_frame

    out = None
    for spec in topological_order(specs):
        if spec.kind != "dimension" or not spec.business_key:
            continue
        keys = list(spec.business_key)
        src = map_columns(source_frame(spec, sources), [c for c in spec.columns if c[0] in keys])
        src = src.dropna(subset=keys).distinct()
        stored = read(spec.target) if read else read_back(spark, f"{target_root.rstrip('/')}/{spec.target}")
        tgt = stored.select(*keys)
        r = reconcile(src, tgt, keys, compare=[]).select(F.lit(spec.target).alias("table_name"), "status", "n")
        out = r if out is None else out.unionByName(r)
    return out


def load_gate(summary: DataFrame) -> None:
    """Stop when any reconciled table has missing, extra or changed rows."""
    from starload.operators.quality import LoadCheckError

    bad = summary.filter((F.col("status") != "match") & (F.col("n") > 0)).collect()
    if bad:
        raise LoadCheckError(f"reconciliation failed: {[(r.table_name, r.status, r.n) for r in bad]}")
