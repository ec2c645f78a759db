"""Approximate nearest neighbours by cosine (operator 13).

Candidates are unit vectors; the chord between two unit vectors is a metric that
falls as their cosine rises.  Every shard holds a vantage-point tree: a node's
vantage is a row, its other rows are split at the median chord to it, and the
node keeps the smallest and largest chord of either half.  For a query at chord
d from the vantage, no row of a half lies nearer than ``max(near - d, d - far)``
(the triangle inequality).  A half is left out if ``factor`` times that bound is
beyond the query's k-th chord so far: factor 1 is an exact search, a larger
factor skips halves that could still hold a neighbour.

All queries of a task walk a tree together: a node takes the queries that still
need it, and the half that most of them lie closer to is walked first.  Scores
are the cosines of the original vectors in double precision, summed component
by component; whatever comes within rounding of the k-th is scored.

Measured recall of the 5 nearest (2,000 and 51,282 vectors of 64 components,
whose distances hardly differ): see README.  ``FACTOR`` is what the query uses.

Defined cases: null, empty or zero vectors and vectors with null or non-finite
components take no part, nor do rows without an id.  Exact repeats of a row count
once; different vectors under one id are candidates each, and queries each, but
never find their own id.  Vectors of another length than the query's are no
candidates.  Ties go to the smaller id.  An empty table gives no rows; columns
other than the id and the vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm._vectors import (BLOCK, SHARD, Best, array, arrays, first, matrix, meet, packs, usable)
from starload.llm._work import Workspace

K = 5
FACTOR = 1.0
LEAF = 64
SLACK = 1e-7      # chords of rounded unit vectors are right to about 1e-8
ROUNDING = 1e-12  # and their products to about 1e-15


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two: same cosines, squares neither overflow nor vanish."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    return np.ldexp(vectors, -exponent[:, None])


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, every sum taken in component order."""
    def total(x):
        return np.add.accumulate(x, axis=1)[:, -1]
    return np.clip(total(a * b) / np.sqrt(total(a * a) * total(b * b)), -1.0, 1.0)


def _chords(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * dots, 0.0))


def build(table: pa.Table) -> pa.Table:
    """The rows in tree order.  A node (lo, hi, mid, four chords) is the rows lo to
    hi: its vantage at lo, the near half up to mid, the far half after it; a leaf
    has mid -1."""
    units = _units(_scaled(matrix(table)))
    order = np.arange(len(units))
    spans, bounds, todo = [], [], [(0, len(units))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= LEAF:
            spans.append((lo, hi, -1))
            bounds.append((0.0,) * 4)
            continue
        own = order[lo:hi]
        away = _chords(units[own] @ units[own[0]])
        vantage = int(np.argmax(away))          # a row at the rim splits best
        own[[0, vantage]] = own[[vantage, 0]]
        chord = _chords(units[own[1:]] @ units[own[0]])
        sort = np.argsort(chord, kind="stable")
        order[lo:hi] = np.concatenate([own[:1], own[1:][sort]])
        chord, half = chord[sort], len(sort) // 2
        spans.append((lo, hi, lo + 1 + half))
        bounds.append((chord[0], chord[half - 1], chord[half], chord[-1]))
        todo += [(lo + 1, lo + 1 + half), (lo + 1 + half, hi)]
    return arrays(table.take(pa.array(order)), spans=np.array(spans, dtype=np.int64).ravel(),
                  bounds=np.array(bounds, dtype=np.float64).ravel())


def search(shard: pa.Table, blocks: list[pa.Table], k: int = K, factor: float = FACTOR) -> pa.Table:
    """(query, vec_id, score) of the shard's k nearest rows of each query."""
    spans, bounds = array(shard, "spans").reshape(-1, 3), array(shard, "bounds").reshape(-1, 4)
    node_of = {(int(lo), int(hi)): n for n, (lo, hi, _) in enumerate(spans)}
    ids, rows = shard.column("vec_id").to_numpy(), _scaled(matrix(shard))
    units, out = _units(rows), []
    for block in blocks:
        asked = _scaled(matrix(block))
        if asked.shape[1] != rows.shape[1]:
            continue
        own, asked_units = block.column("vec_id").to_numpy(), _units(asked)
        best = Best(len(asked), k)

        def take(who: np.ndarray, lo: int, hi: int, dots: np.ndarray) -> None:
            close = (dots >= best.bar[who][:, None] - ROUNDING) & (ids[lo:hi] != own[who][:, None])
            q, c = np.nonzero(close)
            best.add(who[q], cosines(asked[who[q]], rows[lo + c]), ids[lo + c])

        todo = [(0, len(ids), np.arange(len(asked)), np.zeros(len(asked)))]
        while todo:
            lo, hi, who, least = todo.pop()
            need = factor * least <= _chords(best.bar[who]) + SLACK
            who = who[need]
            if not len(who):
                continue
            node = node_of[lo, hi]
            mid, (near0, near1, far0, far1) = int(spans[node, 2]), bounds[node]
            if mid < 0:
                take(who, lo, hi, asked_units[who] @ units[lo:hi].T)
                continue
            dots = asked_units[who] @ units[lo]
            take(who, lo, lo + 1, dots[:, None])
            chord = _chords(dots)
            near = np.maximum(np.maximum(near0 - chord, chord - near1), 0.0)
            far = np.maximum(np.maximum(far0 - chord, chord - far1), 0.0)
            halves = [(mid, hi, who, far), (lo + 1, mid, who, near)]
            todo += halves if (near <= far).mean() >= 0.5 else halves[::-1]
        query, score, vec_id = best.found()
        out.append(pa.table({"query": pa.array(block.column("query").to_numpy()[query], pa.int64()),
                             "vec_id": pa.array(vec_id, pa.int64()), "score": pa.array(score, pa.float64())}))
    empty = pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                      "score": pa.array([], pa.float64())})
    return pa.concat_tables([empty, *out])


def nearest(table: DataFrame, asks: Column, k: int = K, factor: float = FACTOR, key: str = "vec_id",
            vector: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """For the rows where ``asks`` holds, their ``k`` nearest rows of the table:
    query_id, rank, vec_id, score."""
    takes_part = F.col(key).isNotNull() & usable(vector) & F.exists(vector, lambda x: x != 0)
    rows = (table.filter(takes_part)
            .select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"),
                    F.coalesce(asks, F.lit(False)).alias("asks")).distinct())
    with Workspace(table.sparkSession, "vp-tree") as ws:
        queries = ws.stage(rows.filter("asks").select(F.monotonically_increasing_id().alias("query"),
                                                      "vec_id", "vector"), "queries")
        found = meet(packs(ws, rows.select("vec_id", "vector"), shard, "shards", build),
                     packs(ws, queries, block, "blocks"),
                     lambda s, b: search(s, b, k, factor), "query long, vec_id long, score double")
        names = queries.select("query", F.col("vec_id").alias("query_id"))
        return ws.finish(first(found, k, "query").join(names, "query")
                         .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
