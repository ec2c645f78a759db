"""Exact substring removal with a logarithmic family of suffix indexes (operator 5).

Every byte covered by a ``MATCH``-byte string that also starts anywhere else is
removed.  Suffixes are indexed sparsely: of each MATCH-byte window only the
suffix at its anchor, the smallest ``SEED``-byte hash inside it, leftmost first.
Equal windows have equal anchors, so no match is lost, and one suffix in about
sixty is kept.  Consecutive windows with the same anchor form a span.

1. Documents arrive in batches.  A batch's suffixes are written sorted by the
   hash of their first SEED bytes, in buckets: its suffix array.  It is
   merge-scanned against itself and against every existing level (bucketed sort-merge
   joins, without an exchange); suffixes met elsewhere are candidates.  Before
   the next batch, levels of equal rank are merged into one of the next rank.
2. Candidate spans found twice as a whole are covered whole.
3. Where a span is alone, all distinct spans of its anchor are cut into blocks
   of up to BLOCK windows at fixed distances from the anchor.  The bytes common
   to a block's windows must be found twice for any of its windows to be; a
   block found twice as a whole is covered whole; only the windows of blocks
   in between are compared one by one (anchor, common bytes and window: 192
   hash bits).
4. Covered intervals are applied to the texts.

Only steps 2 and 3 decide; step 1 cannot miss a match.

Rows are identified by the hash of (doc_id, text).  Defined cases: null text is
empty; repeated rows are documents of their own that repeat one another, so
their bytes go; texts below MATCH bytes lose nothing; no key needs to be unique
or non-null.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx
from starload.llm._work import Workspace, extended

MATCH = 200
SEED = 80
BATCHES = 4
_POSITION = np.uint64((1 << 28) - 1)
STRETCH = 1 << 27              # windows whose anchors are sought at once; their positions fit _POSITION

BLOCK = 16

SUFFIX = "key long, rid long, at int, lo int, hi int, span long"


def row_id() -> Column:
    return F.xxhash64("doc_id", "text")


def smallest(seeds: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of every ``width`` consecutive hashes, leftmost first.

    Hashes are compared by the bits above a position within the stretch, so a text
    has no greatest length."""
    out = np.empty(max(len(seeds) - width + 1, 0), dtype=np.int64)
    for lo in range(0, len(out), STRETCH):
        part = seeds[lo:lo + STRETCH + width - 1]
        ranked = (part & ~_POSITION) | np.arange(len(part), dtype=np.uint64)
        out[lo:lo + STRETCH] = (tx.window_min(ranked, width) & _POSITION).astype(np.int64) + lo
    return out


def anchors(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, tx.PrefixHash, np.ndarray]:
    """Spans of windows with one anchor: (row, first window, last window), the
    prefix hash and the anchor positions, all flat."""
    prefix = tx.PrefixHash(chunk.data)
    none = np.zeros(0, dtype=np.int64)
    if len(chunk.data) < MATCH:
        return none, none, none, prefix, none
    anchor = smallest(prefix.windows(SEED), MATCH - SEED + 1)
    per = np.maximum(chunk.lengths() - MATCH + 1, 0)
    row = np.repeat(np.arange(chunk.n), per)
    start = np.repeat(chunk.off[:-1] - (np.cumsum(per) - per), per) + np.arange(len(row))
    own = anchor[start]
    if len(own) == 0:
        return none, none, none, prefix, none
    new = np.ones(len(own), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1
    return row[first], start[first], start[last], prefix, own[first]


def suffixes(docs: DataFrame) -> DataFrame:
    """Sparse suffixes of rows (rid, text)."""
    def run(batches):
        for part, chunk in tx.chunks(batches):
            row, first, last, prefix, at = anchors(chunk)
            base = chunk.off[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(tx.signed(prefix.slices(at, at + SEED))), part.column(0).take(pa.array(row)),
                 pa.array((at - base).astype(np.int32)), pa.array((first - base).astype(np.int32)), pa.array((last + MATCH - base).astype(np.int32)),
                 pa.array(tx.signed(prefix.slices(first, last + MATCH)))],
                names=["key", "rid", "at", "lo", "hi", "span"])

    return docs.mapInArrow(run, SUFFIX)


class SuffixIndex:
    """Levels of sorted suffix tables; ranks grow geometrically."""

    def __init__(self, ws: Workspace):
        self.ws = ws
        self.buckets = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[tuple[int, DataFrame]] = []
        self.met: list[DataFrame] = []

    def add(self, batch: DataFrame) -> None:
        """Index a batch of suffixes; remember the keys it shares."""
        self._merge()
        new = self.ws.bucketed(batch, "suffixes", "key", self.buckets)
        shared = new.groupBy("key").count().filter("count > 1").select("key")
        for _, level in self.levels:
            shared = shared.unionByName(new.select("key").join(level.select("key"), "key", "left_semi"))
        self.met.append(self.ws.stage(shared.distinct(), "met"))
        self.levels.append((0, new))

    def _merge(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, x), (_, y) = self.levels.pop(), self.levels.pop()
            both = self.ws.bucketed(x.unionByName(y), "suffixes", "key", self.buckets)
            for old in (x, y):
                self.ws.drop(old._staged)
            self.levels.append((rank + 1, both))

    def candidates(self) -> DataFrame:
        """Every indexed suffix whose key was met elsewhere."""
        keys = self.met[0]
        for more in self.met[1:]:
            keys = keys.unionByName(more)
        keys = self.ws.bucketed(keys.distinct(), "keys", "key", self.buckets)
        found = None
        for _, level in self.levels:
            part = level.join(keys, "key", "left_semi")
            found = part if found is None else found.unionByName(part)
        found = self.ws.stage(found, "candidates")
        for _, level in self.levels:
            self.ws.drop(level._staged)
        self.levels = []
        return found


def _blocks(probe: DataFrame) -> DataFrame:
    """Blocks of the listed spans: the hash of the bytes common to all windows the
    block could hold, of the block as it is, and of each of its windows."""
    def run(batches):
        for part, chunk in tx.chunks(batches):
            lists = part.column(part.schema.get_field_index("spans"))
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            fields = lists.flatten()
            columns = [fields.field(i).to_numpy(zero_copy_only=False) for i in range(5)]
            row = np.repeat(np.arange(chunk.n), sizes)
            prefix = tx.PrefixHash(chunk.data, 1)
            step = 1 << 14
            for begin in range(0, len(row), step):
                key, at, lo, hi, alone = (c[begin:begin + step] for c in columns)
                base = chunk.off[row[begin:begin + step]]
                origin = at.astype(np.int64) - (MATCH - SEED)       # first window the anchor can have
                first, last = (lo - origin) // BLOCK, (hi - MATCH - origin) // BLOCK
                n = last - first + 1
                span = np.repeat(np.arange(len(n)), n)
                block = first[span] + np.arange(len(span)) - np.repeat(np.cumsum(n) - n, n)
                start = origin[span] + block * BLOCK
                low = np.maximum(start, lo[span])
                high = np.minimum(start + BLOCK - 1, hi[span] - MATCH)
                count = high - low + 1
                shift = base[span]
                core = prefix.slices(start + BLOCK - 1 + shift, start + MATCH + shift)
                full = prefix.slices(low + shift, high + MATCH + shift) ^ tx.mix((low - start).astype(np.uint64))
                each = np.repeat(np.arange(len(span)), count)
                window = low[each] + shift[each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
                lists_out = pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(count)), pa.int32()),
                    pa.array(tx.signed(prefix.slices(window, window + MATCH))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[span]), pa.array(block.astype(np.int32)), pa.array(tx.signed(core)),
                     pa.array(tx.signed(full)), part.column(0).take(pa.array(row[begin:begin + step][span])),
                     pa.array(low.astype(np.int32)), lists_out, pa.array(alone[span])],
                    names=["key", "block", "core", "full", "rid", "lo", "windows", "alone"])

    return probe.mapInArrow(run, "key long, block int, core long, full long, rid long, lo int, "
                                 "windows array<long>, alone boolean")


def _pieces(blocks: DataFrame, ws: Workspace) -> DataFrame:
    """(rid, lo, hi): what of the spans that are alone is covered."""
    place = ["key", "block", "core"]
    counts = ws.stage(blocks.groupBy(*place, "full").agg(F.count("*").alias("n"), F.bool_or("alone").alias("alone")),
                      "block-counts")
    unsure = (counts.groupBy(*place).agg(F.count("*").alias("kinds"), F.bool_or(F.expr("n = 1 AND alone")).alias("open"))
              .filter("kinds > 1 AND open").select(*place))
    windows = (blocks.join(unsure, place, "left_semi")
               .select(*place, "rid", "lo", "alone", F.posexplode("windows").alias("i", "window")))
    windows = ws.stage(windows, "windows")
    twice = windows.groupBy(*place, "window").count().filter("count > 1").drop("count")
    single = (windows.filter("alone").join(twice, [*place, "window"], "left_semi")
              .select("rid", (F.col("lo") + F.col("i")).alias("lo"), (F.col("lo") + F.col("i") + MATCH).alias("hi")))
    whole = (blocks.filter("alone")
             .select(*place, "full", "rid", "lo", (F.col("lo") + F.size("windows") - 1 + MATCH).alias("hi"))
             .join(counts.filter("n > 1").select(*place, "full"), [*place, "full"], "left_semi")
             .select("rid", "lo", "hi"))
    whole = ws.stage(whole.unionByName(single), "pieces")
    ws.discard(blocks, counts, windows)
    return whole


def covered(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(rid, parts): for every row (rid, text) with removed bytes, intervals [lo, hi)
    whose union is removed; at most one per start, so a list is bounded by its text."""
    index = SuffixIndex(ws)
    for batch in range(BATCHES):
        index.add(suffixes(docs.filter(F.pmod("rid", F.lit(BATCHES)) == batch)))
    found = index.candidates()
    spans = ws.stage(found.groupBy("key", "span").agg(F.count("*").alias("n"),
                                                      F.min(F.struct("rid", "at", "lo", "hi")).alias("one")), "spans")
    whole = ws.stage(found.join(spans.filter("n > 1").select("key", "span"), ["key", "span"], "left_semi")
                     .select("rid", "lo", "hi"), "whole-spans")
    ws.discard(found)
    alone = spans.filter("n = 1").select("key").distinct()
    probe = (spans.join(alone, "key", "left_semi")
             .select("one.rid", F.struct("key", "one.at", "one.lo", "one.hi", (F.col("n") == 1).alias("alone")).alias("s"))
             .groupBy("rid").agg(F.collect_list("s").alias("spans")))
    probe = docs.join(probe.hint("merge"), "rid").select("rid", "text", "spans")
    blocks = ws.stage(_blocks(probe), "blocks")
    ws.discard(spans)
    pieces = _pieces(blocks, ws)
    longest = pieces.unionByName(whole).groupBy("rid", "lo").agg(F.max("hi").alias("hi"))
    out = ws.stage(longest.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("parts")), "covered")
    ws.discard(pieces, whole)
    return out


def merged(parts) -> np.ndarray:
    """Sorted disjoint intervals (n, 2) of a list of {lo, hi}; touching ones join."""
    if not parts:
        return np.zeros((0, 2), dtype=np.int64)
    at = np.array(sorted((p["lo"], p["hi"]) for p in parts), dtype=np.int64)
    reach = np.maximum.accumulate(at[:, 1])
    first = np.flatnonzero(np.append(True, at[1:, 0] > reach[:-1]))
    return np.stack((at[first, 0], reach[np.append(first[1:], len(at)) - 1]), axis=1)


def kept_bytes(raw: bytes, spans: np.ndarray) -> bytes:
    edges = [0, *spans.ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def removal(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    with Workspace(docs.sparkSession, "suffix") as ws:
        docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("rid", row_id())
        parts = covered(docs.select("rid", "text"), ws)
        joined = docs.join(parts.hint("merge"), "rid", "left").select("doc_id", "text", "parts")

        def run(batches):
            for batch in batches:
                out = []
                for text, own in zip(batch.column(1), batch.column(2), strict=True):
                    raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                    spans = merged(own.as_py())
                    out.append((len(raw), int((spans[:, 1] - spans[:, 0]).sum()), len(spans),
                                hashlib.sha256(kept_bytes(raw, spans)).hexdigest()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)),
                     pa.array([o[3] for o in out], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        id_type = docs.schema["doc_id"].dataType.simpleString()
        return ws.finish(joined.mapInArrow(
            run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"))


def strip(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the repeated bytes gone from ``text``; a
    character of which only some bytes are covered goes whole.  ``__removed``
    tells whether the row lost any byte."""
    marked = docs.withColumn("__rid", row_id())
    with Workspace(docs.sparkSession, "suffix") as ws:
        parts = ws.finish(covered(marked.select(F.col("__rid").alias("rid"), "text"), ws))
    parts = parts.toDF("__rid", "__parts")
    joined = marked.join(parts.hint("merge"), "__rid", "left").select(*docs.columns, "__parts")
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts, changed = [], []
            for text, own in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                changed.append(own.is_valid)
                if own.is_valid:
                    texts.append(kept_bytes(text.as_buffer().to_pybytes(), merged(own.as_py())).decode(errors="ignore"))
                else:
                    texts.append(text.as_py())
            cols = [pa.array(texts, pa.string()) if i == at else batch.column(i)
                    for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(changed)], names=[*names, "__removed"])

    return joined.mapInArrow(run, extended(docs.schema.fields, "__removed boolean"))
