"""Hard-negative mining by inner product (operator 11).

Vectors become integers, ``floor(scale * x)``, so every inner product is exact.
A candidate x gets one more component, ``sqrt(M^2 - |x|^2)`` with M the largest
norm of its shard, and a query a zero: the inner products stay, all candidates
have norm M, and a larger inner product is a smaller distance,
``d^2 = |q|^2 + M^2 - 2 q.x``.

Every shard holds a cover tree of the augmented rows.  A node at scale s splits
into children at s / ``BASE``: centres chosen farthest first are more than the
child scale apart (separation), every row joins its nearest centre within it
(covering), and the node's own centre is the first (nesting); levels at which a
node is its only child are left out.  A node keeps its covering radius r, the
largest distance of its rows to the centre, at most the scale of its level.

For a query at distance d from a centre c, the triangle inequality bounds the
inner product with all rows below by the distances d - r and d + r, and
Cauchy-Schwarz by ``q.c +- |q| r``.  Level by level, nodes whose bounds miss the
query's window are dropped with all below them.  Their leaves are then opened
best bound first, a few at a time, until no bound reaches the k-th score found;
an opened leaf is scored whole, in integers.  Nothing is lost.

Defined cases: rows without an id or label, with a null or empty vector or null
or non-finite components take no part, nor do rows whose own inner product could
pass 2^62, as scores would not fit a long.  Exact repeats of a row count once;
different rows under one id all take part, and an anchor never meets its own id.
Vectors of another length than the anchor's are no candidates.  Ties go to the
smaller id; a positive of negative score has an empty window.  Fewer rows than
asked for are all returned; an empty table gives no rows.  Columns other than
the id, the label and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm._vectors import SHARD, Best, array, arrays, first, matrix, meet, packs, usable
from starload.llm._work import Workspace

BASE = 1.3
LEAF = 64
BLOCK = 256        # anchors in one block; each has up to POSITIVES windows
POSITIVES, NEGATIVES = 5, 5
LOWEST = (80, 100)  # a negative scores at least this share of the positive's score
UNBOUNDED = 2**62

FOUND = "query long, slot int, vec_id long, score long"


def integers(table: pa.Table, scale: int) -> np.ndarray:
    """Rows of whole numbers (as doubles)."""
    return np.floor(scale * matrix(table))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products, exact: in doubles where every sum stays below 2^53, in
    64-bit integers otherwise."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def augmented(rows: np.ndarray) -> tuple[np.ndarray, float]:
    square = (rows * rows).sum(axis=1)
    most = float(square.max(initial=0.0))
    return np.hstack([rows, np.sqrt(most - square)[:, None]]), most


def builder(scale: int) -> Callable[[pa.Table], pa.Table]:
    """Builds the shard's tree: rows in tree order, nodes as (first row = centre,
    end, parent, depth, leaf) and their radii."""
    def build(table: pa.Table) -> pa.Table:
        points, _ = augmented(integers(table, scale))

        def distances(rows: np.ndarray, centre: int) -> np.ndarray:
            return np.sqrt(((points[rows] - points[centre]) ** 2).sum(axis=1))

        order = np.arange(len(points))
        nodes, radii = [], []
        away = distances(order, 0)
        todo = [(0, len(order), -1, 0, away, float(away.max()))]
        while todo:
            lo, hi, parent, depth, away, scale_here = todo.pop()
            me, radius = len(nodes), float(away.max())
            leaf = hi - lo <= LEAF or radius == 0.0
            nodes.append((lo, hi, parent, depth, leaf))
            radii.append(radius)
            if leaf:
                continue
            below = scale_here / BASE
            while below >= radius:                # levels where the node is its only child
                below /= BASE
            own, owner, nearest, centres = order[lo:hi].copy(), np.zeros(hi - lo, dtype=np.int64), away, 1
            while nearest.max() > below:
                chord = distances(own, own[int(nearest.argmax())])
                closer = chord < nearest
                owner[closer] = centres
                nearest = np.minimum(nearest, chord)
                centres += 1
            sort = np.lexsort((nearest, owner))   # by child, its centre (distance 0) first
            order[lo:hi], away = own[sort], nearest[sort]
            cuts = np.searchsorted(owner[sort], np.arange(centres + 1))
            todo += [(lo + a, lo + b, me, depth + 1, away[a:b], below) for a, b in zip(cuts[:-1], cuts[1:])]
        return arrays(table.take(pa.array(order)), nodes=np.array(nodes, dtype=np.int64).ravel(),
                      radii=np.array(radii, dtype=np.float64))
    return build


class Tree:
    def __init__(self, shard: pa.Table, scale: int):
        self.rows = integers(shard, scale)
        self.ids = shard.column("vec_id").to_numpy()
        self.labels = shard.column("label").to_numpy()
        self.lo, self.hi, self.parent, self.depth, leaf = array(shard, "nodes").reshape(-1, 5).T
        self.leaves = np.flatnonzero(leaf)
        self.radius = array(shard, "radii")
        _, self.most = augmented(self.rows)

    def bounds(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product of each query with the rows of each node."""
        centre = products(asked, self.rows[self.lo]).astype(np.float64)
        square = (asked * asked).sum(axis=1, keepdims=True)
        both = square + self.most
        d, r = np.sqrt(np.maximum(both - 2 * centre, 0.0)), self.radius
        reach = np.sqrt(square) * r
        slack = 1.0 + 1e-9 * both
        most = np.minimum((both - np.maximum(d - r, 0.0) ** 2) / 2, centre + reach) + slack
        least = np.maximum((both - (d + r) ** 2) / 2, centre - reach) - slack
        return least, most

    def search(self, asked: np.ndarray, row: np.ndarray, low: np.ndarray, high: np.ndarray,
               fits: Callable[[np.ndarray, slice], np.ndarray], k: int) -> Best:
        """The k best rows of each slot: query ``row``, scores from ``low`` to ``high``,
        rows that ``fits(row, span)`` allows."""
        best = Best(len(row), k, np.int64, -UNBOUNDED)
        least, most = self.bounds(asked)
        alive = np.zeros((len(row), len(self.lo)), dtype=bool)
        for depth in range(int(self.depth.max(initial=-1)) + 1):
            at = np.flatnonzero(self.depth == depth)
            open_ = (most[row][:, at] >= low[:, None]) & (least[row][:, at] <= high[:, None])
            alive[:, at] = open_ if depth == 0 else open_ & alive[:, self.parent[at]]
        bound = np.where(alive[:, self.leaves], np.minimum(most[row][:, self.leaves], high[:, None]), -np.inf)
        order = np.argsort(-bound, axis=1, kind="stable")
        at, width = 0, 1
        while at < len(self.leaves):
            turn = order[:, at:at + width]
            value = np.take_along_axis(bound, turn, axis=1)
            slot, place = np.nonzero((value > -np.inf) & (value >= best.bar[:, None]))
            if not len(slot):
                break
            leaf = turn[slot, place]
            by_leaf = np.argsort(leaf, kind="stable")
            slot, leaf = slot[by_leaf], leaf[by_leaf]
            starts = np.flatnonzero(np.diff(leaf, prepend=-1))
            found = []
            for a, b in zip(starts, [*starts[1:], len(leaf)]):
                node, who = self.leaves[leaf[a]], slot[a:b]
                span = slice(int(self.lo[node]), int(self.hi[node]))
                score = products(asked[row[who]], self.rows[span])
                good = ((score >= low[who][:, None]) & (score <= high[who][:, None])
                        & (score >= best.bar[who][:, None]) & fits(row[who], span))
                w, c = np.nonzero(good)
                found.append((who[w], score[w, c], self.ids[span][c]))
            best.add(*[np.concatenate(x) for x in zip(*found)])
            at, width = at + width, width * 4
        return best


def search(shard: pa.Table, blocks: list[pa.Table], k: int, scale: int, lowest: tuple[int, int] | None) -> pa.Table:
    """Without ``lowest``: the k best rows of the anchor's label.  With it: for each
    of the anchor's ``positives`` (scores) the k best rows of other labels from
    that share of the score up to the score."""
    tree, out = Tree(shard, scale), []
    for block in blocks:
        asked = integers(block, scale)
        if asked.shape[1] != tree.rows.shape[1]:
            continue
        own, label = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
        if lowest is None:
            row = np.arange(len(asked))
            slot = np.zeros(len(asked), dtype=np.int32)
            low, high = np.full(len(asked), -UNBOUNDED), np.full(len(asked), UNBOUNDED)
        else:
            scores = block.column("positives").to_pylist()
            row = np.repeat(np.arange(len(asked)), [len(s) for s in scores])
            slot = np.concatenate([np.arange(len(s), dtype=np.int32) for s in scores])
            high = np.array([p for s in scores for p in s], dtype=np.int64)
            low = np.array([-(-lowest[0] * p // lowest[1]) for s in scores for p in s], dtype=np.int64)

        def fits(rows: np.ndarray, span: slice) -> np.ndarray:
            same = tree.labels[span] == label[rows][:, None]
            return (same if lowest is None else ~same) & (tree.ids[span] != own[rows][:, None])

        at, score, ids = tree.search(asked, row, low, high, fits, k).found()
        out.append(pa.table({"query": pa.array(block.column("query").to_numpy()[row[at]], pa.int64()),
                             "slot": pa.array(slot[at], pa.int32()), "vec_id": pa.array(ids, pa.int64()),
                             "score": pa.array(score, pa.int64())}))
    kinds = pa.schema([("query", pa.int64()), ("slot", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    return pa.concat_tables([kinds.empty_table(), *out])


def mine(table: DataFrame, anchors: Column, scale: int = 256, positives: int = POSITIVES,
         negatives: int = NEGATIVES, lowest: tuple[int, int] = LOWEST, key: str = "vec_id", label: str = "label",
         vector: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """For the rows where ``anchors`` holds and each of their positives, the hard
    negatives: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score."""
    most = F.sqrt(F.lit(2.0**62) / F.size(vector)) - 1
    whole = usable(vector) & F.forall(vector, lambda x: F.abs(x.cast("double")) * scale < most)
    rows = (table.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & whole)
            .select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                    F.col(vector).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks")).distinct())
    with Workspace(table.sparkSession, "cover-tree") as ws:
        queries = ws.stage(rows.filter("asks").select(F.monotonically_increasing_id().alias("query"),
                                                      "vec_id", "label", "vector"), "anchors")
        shards = packs(ws, rows.drop("asks"), shard, "shards", builder(scale))
        found = meet(shards, packs(ws, queries, block, "blocks"),
                     lambda s, b: search(s, b, positives, scale, None), FOUND)
        nearest = ws.stage(first(found, positives, "query"), "positives")
        scores = nearest.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("all"))
        windows = queries.join(scores.select("query", F.col("all.score").alias("positives")), "query")
        found = meet(shards, packs(ws, windows, block, "windows"),
                     lambda s, b: search(s, b, negatives, scale, lowest), FOUND)
        hard = first(found, negatives, "query", "slot")
        pairs = nearest.select("query", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"),
                               F.col("score").alias("positive_score"))
        names = queries.select("query", F.col("vec_id").alias("anchor_id"))
        return ws.finish(hard.join(pairs, ["query", "slot"]).join(names, "query").select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
            F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
