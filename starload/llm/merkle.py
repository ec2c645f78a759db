"""Merkle manifest of a table (operator 12).

Every row is a leaf: the SHA-256 of its fields, each length-prefixed, so no two
different records hash the same text.  Leaves of one group ascend by a key;
every ``FAN`` consecutive nodes (a run) have one parent, level upon level, until
one node, the group's subroot, is left.  The subroots, in order of their group,
form one more tree over the same steps; its end is the root.

Per level, lag and lead columns at the offsets 1 .. FAN - 1, masked by a node's
slot and its run's length, are its siblings on either side; the first child of
a run hashes itself and its masked leads to the parent.  A window holds one run,
so a group with a third of all rows is as many windows as it has runs.

Positions come from one range sort by (group, key, leaf): each partition counts
its rows by group, and running sums of these counts give a row's place in its
group.  The way down joins a node to its parent's path on (group, run), eight
children to a parent; nothing is joined on the group alone but single rows.

Every level is staged below ``spark.checkpoint.dir``; only their number is
known to the driver.  All steps are DataFrame functions.

Defined cases: a null field is ``-`` and a null text is never tampered with; an
empty text is ``0:``; texts of any length are one value of one row.  A null
group is a group, the first; null keys come first.  Rows of one key ascend by
their leaf, and repeated rows are leaves each (which of them has which place
makes no difference).  An empty table has an empty manifest.  Input columns keep
their names inside one struct and can clash with none of the operator's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.llm._work import Workspace

FAN = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """SHA-256 in hex of the parts in a row; a null part is nothing."""
    return F.sha2(F.concat_ws("", *parts), 256)


def record(fields: Sequence[str | Column]) -> Column:
    """The leaf of a record."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                    for t in texts])


def _numbered(ws: Workspace, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` (grp, key, h, row) with ``pos``, the place in the group, and ``n``,
    the group's size."""
    order = ["grp", F.asc_nulls_first("key"), "h", "spread"]
    # ``spread`` deals equal rows to several ranges.
    ranged = (rows.withColumn("spread", F.monotonically_increasing_id())
              .repartitionByRange(*order).sortWithinPartitions(*order)
              .select("grp", "h", "row", F.monotonically_increasing_id().alias("at")))
    ranged = ws.stage(ranged, f"{name}-sorted").withColumn("part", F.shiftright("at", 33))
    stretch = ranged.groupBy("grp", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretch.select(
        F.col("grp").alias("g"), F.col("part").alias("p"), F.sum("rows").over(group).alias("n"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    placed = ranged.join(offsets, (F.col("grp") == F.col("g")) & (F.col("part") == F.col("p")))
    return ws.stage(placed.select("grp", (F.col("at") + F.col("shift")).alias("pos"), "n", "h", "row"), f"{name}-0")


def _runs(nodes: DataFrame) -> tuple[DataFrame, list[Column], list[Column]]:
    """The nodes that have a parent, with their run; and their siblings, the lags
    and the leads, in order."""
    nodes = nodes.filter(F.col("n") > 1).withColumn("run", F.floor(F.col("pos") / FAN))
    window = Window.partitionBy("grp", "run").orderBy("pos")
    slot = F.col("pos") % FAN
    length = F.least(F.lit(FAN), F.col("n") - F.col("run") * FAN)
    lags = [F.when(slot >= o, F.lag("h", o).over(window)) for o in range(FAN - 1, 0, -1)]
    leads = [F.when(slot + o < length, F.lead("h", o).over(window)) for o in range(1, FAN)]
    return nodes, lags, leads


def _levels(ws: Workspace, rows: DataFrame, name: str) -> list[DataFrame]:
    """The nodes of every level, the leaves first."""
    levels = [_numbered(ws, rows, name)]
    widest = levels[0].agg(F.max("n")).first()[0] or 0
    while widest > 1:
        nodes, _, leads = _runs(levels[-1].drop("row"))
        parents = (nodes.withColumn("parent", digest(F.col("h"), *leads)).filter(F.col("pos") % FAN == 0)
                   .select("grp", F.col("run").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"),
                           F.col("parent").alias("h")))
        levels.append(ws.stage(parents, f"{name}-{len(levels)}"))
        widest = -(-widest // FAN)
    return levels


def _ends(levels: list[DataFrame]) -> DataFrame:
    """The last node of every group."""
    out = None
    for nodes in levels:
        last = nodes.filter(F.col("n") == 1).select("grp", "h")
        out = last if out is None else out.unionByName(last)
    return out


def _paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves' rows with ``path``, (left, right) siblings level by level, and
    ``ends``, the last nodes passed.  ``above`` has the path and the ends that
    follow each group's last node."""
    parents = None
    for nodes in reversed(levels):
        row = ["row"] if "row" in nodes.columns else []
        last = (nodes.filter(F.col("n") == 1).join(above, "grp")
                .select("grp", "pos", *row, "h", "path", F.concat(F.array("h"), F.col("ends")).alias("ends")))
        if parents is not None:
            under, lags, leads = _runs(nodes)
            step = F.struct(F.concat_ws("", *lags).alias("left"), F.concat_ws("", *leads).alias("right"))
            own = under.select("grp", "run", "pos", *row, "h", step.alias("step"))
            up = parents.select("grp", F.col("pos").alias("run"), "path", "ends")
            last = last.unionByName(own.join(up, ["grp", "run"]).select(
                "grp", "pos", *row, "h", F.concat(F.array("step"), F.col("path")).alias("path"), "ends"))
        parents = last
    return parents


def manifest(ws: Workspace, rows: DataFrame, leaf: Column, group: str, key: str) -> DataFrame:
    """One row per row of ``rows``: ``row`` (a struct of all its columns), ``leaf``,
    ``subroot``, ``root`` and ``path``, an array of the siblings' joined digests
    (left, right) from the leaf's level to the root.  Read it while ``ws`` is open."""
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))   # null first, then bytewise
    leaves = rows.select(grp.alias("grp"), F.col(key).alias("key"), leaf.alias("h"),
                         F.struct(*[F.col(c) for c in rows.columns]).alias("row"))
    levels = _levels(ws, leaves, "leaves")
    subroots = _ends(levels).select(F.lit("").alias("grp"), F.col("grp").alias("key"), "h",
                                    F.struct("grp").alias("row"))
    tops = _levels(ws, subroots, "subroots")
    nothing = _ends(tops).select("grp", F.expr("cast(array() as array<struct<left:string,right:string>>)")
                                 .alias("path"), F.expr("cast(array() as array<string>)").alias("ends"))
    above = _paths(tops, nothing).select(F.col("row.grp").alias("grp"), "path", "ends")
    return _paths(levels, above).select(
        "row", F.col("h").alias("leaf"), F.col("ends")[0].alias("subroot"), F.col("ends")[1].alias("root"), "path")


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings in order."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(path: Column, leaf: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def check_tampering(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` and, for every row, whether its proof still
    leads to the root when the texts of a third of the rows are lower-cased."""
    def leaf(text: Column) -> Column:
        return record(["doc_id", "source", "lang", "n_chars", text])

    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    original = leaf(F.col("text"))
    narrow = docs.select("doc_id", "lang", original.alias("leaf"),
                         F.when(hit, leaf(lowered(F.col("text")))).otherwise(original).alias("found"))
    with Workspace(docs.sparkSession, "merkle") as ws:
        tree = manifest(ws, narrow, F.col("leaf"), "lang", "doc_id")
        folded = fold(F.col("path"), F.col("row.found"))
        return ws.finish(tree.select(
            F.col("row.doc_id").alias("doc_id"), "leaf", "subroot", "root",
            proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
