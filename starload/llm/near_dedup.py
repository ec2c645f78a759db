"""Near-duplicate groups by MinHash bands and odd sketches (operator 4).

1. Every text becomes its set of distinct five-word shingles (64-bit hashes of
   A-Z-lowered words); from it come a digest of the set, ``SAMPLES`` MinHash
   values, their bands, and an odd sketch: each (position, value) sample flips
   one bit of a ``BITS``-bit parity map.
2. Rows with the same set form a class; one document stands for it.
3. Class documents that share a band meet through the band's smallest document
   (a star per band, never all pairs).  The XOR population count of two odd
   sketches estimates the number of differing samples and so the similarity;
   pairs far below the bar go no further.
4. Remaining pairs are confirmed on their full shingle sets.
5. Confirmed links are contracted to components.  Bands whose members are then
   still in several components are searched again between components only, so
   a link that the star missed is found as well.  Their members get a second,
   finer odd sketch first, so that only pairs close to the bar are confirmed.

Two sets at similarity 0.75 share no band with probability
(1 - 0.75**4)**32 < 6e-6; both sketch bars lie over four standard errors below
0.75.

Rows are identified by (doc_id, text); repeated rows share a class.  Defined
cases: null or empty text, or text without words, has an empty set and is
linked with nothing; fewer than five words form one shingle; rows with one
doc_id are one node, and a null doc_id is never a node: such a row gets a null
component and is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx
from starload.llm._components import components
from starload.llm._work import Workspace

SHINGLE = 5
SAMPLES = 128
ROWS = 4                       # samples per band
BITS = 512
#: Estimated similarity below which a pair is not confirmed: 0.75 less over four
#: standard errors of the samples and of the sketch.
ESTIMATE_BAR = 0.5
#: The finer sketch of documents in bands with several components.
FINE_SAMPLES, FINE_BITS, FINE_BAR = 2048, 16384, 0.70

_rng = np.random.default_rng(404)
_XOR = _rng.integers(0, 2**32, size=FINE_SAMPLES, dtype=np.uint32)
_MUL = _rng.integers(0, 2**31, size=FINE_SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _rng.integers(1, 2**63, size=ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(chunk: tx.Chunk) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row."""
    w = chunk.words(lower=True)
    hashes = w.hashes()
    shingles = w.shingles(hashes, SHINGLE)
    out = []
    for first, n in zip(w.row_off[:-1].tolist(), w.count.tolist(), strict=True):
        if n >= SHINGLE:
            out.append(np.unique(shingles[first:first + n - SHINGLE + 1]))
        elif n:
            out.append(tx.sequence_hash(hashes[first:first + n]))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def min_hashes(sets: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """Minima over 32-bit permutations of the set's hashes."""
    low = (sets >> np.uint64(32)).astype(np.uint32)
    best = np.full(samples, 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, (1 << 17) // samples)
    for at in range(0, len(low), step):
        part = (low[at:at + step, None] ^ _XOR[:samples]) * _MUL[:samples]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        np.minimum(best, part.min(axis=0), out=best)
    return best


def odd_sketches(samples: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Parity maps (n, bits / 64) of MinHash samples (n, k)."""
    n, k = samples.shape
    spot = tx.mix(samples.astype(np.uint64) * np.uint64(k) + np.arange(k, dtype=np.uint64)) % np.uint64(bits)
    flips = np.zeros((n, bits), dtype=np.uint8)
    np.add.at(flips, (np.arange(n)[:, None], spot.astype(np.int64)), 1)
    return np.packbits(flips & 1, axis=1, bitorder="little").view(np.uint64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    grouped = samples.reshape(len(samples), -1, ROWS).astype(np.uint64)
    keys = (grouped * _BAND).sum(axis=2, dtype=np.uint64)
    return tx.mix(keys + np.arange(grouped.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


SIGNATURES = "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    def run(batches):
        for part, chunk in tx.chunks(batches):
            sets = shingle_sets(chunk)
            samples = np.array([min_hashes(s) for s in sets], dtype=np.uint32).reshape(-1, SAMPLES)
            keys, sketch = band_keys(samples), odd_sketches(samples)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 _lists(keys), _lists(sketch)],
                names=["doc_id", "n_shingles", "digest", "bands", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SIGNATURES)


def _lists(m: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()),
                                    pa.array(tx.signed(m.ravel())))


def estimate_ok(a: str, b: str, samples: int = SAMPLES, bits: int = BITS, bar: float = ESTIMATE_BAR):
    """Whether two sketches may come from sets over the bar.

    d differing samples flip 2d cells; the XOR then has an expected
    bits / 2 * (1 - (1 - 2 / bits)**(2d)) bits, which grows with d, so the bar
    on the similarity is a bar on the population count.
    """
    most = bits / 2 * (1 - (1 - 2 / bits) ** (2 * samples * (1 - bar)))
    apart = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(apart, F.lit(0), lambda total, x: total + x) <= int(most)


def _size_ok(a: str, b: str):
    return 100 * F.least(a, b) >= 75 * F.greatest(a, b)


def fine_sketches(texts: DataFrame) -> DataFrame:
    def run(batches):
        for part, chunk in tx.chunks(batches):
            samples = [min_hashes(s, FINE_SAMPLES) for s in shingle_sets(chunk)]
            for at in range(0, len(samples), 256):
                sketch = odd_sketches(np.array(samples[at:at + 256]), FINE_BITS)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(at, 256), _lists(sketch)],
                                                 names=["doc_id", "fine"])

    return texts.mapInArrow(run, "doc_id long, fine array<long>")


def confirm(ws: Workspace, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the bar.

    Texts move by sort-merge joins at any size: a third of all rows may be in
    pairs, and no side has a bound.
    """
    joined = (pairs.join(texts.toDF("a", "text_a").hint("merge"), "a")
              .join(texts.toDF("b", "text_b").hint("merge"), "b").select("a", "b", "text_a", "text_b"))

    def run(batches):
        for part, chunk in tx.chunks(batches, "text_a", tx.CHUNK_BYTES // 2):
            other = tx.Chunk(part.column(3))
            ok = []
            for x, y in zip(shingle_sets(chunk), shingle_sets(other), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= 75 * (len(x) + len(y) - both) and both > 0)
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep)],
                                             names=["a", "b"])

    return ws.stage(joined.mapInArrow(run, "a long, b long").distinct(), "links")


def groups(docs: DataFrame, ws: Workspace) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    sig = ws.stage(signatures(docs), "signatures")
    full = sig.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = ws.stage(full.groupBy("digest").agg(F.min("doc_id").alias("of"), F.count("*").alias("size"))
                       .filter("size > 1").select("digest", "of"), "classes")
    copies = (full.select("doc_id", "digest").join(classes, "digest")
              .select(F.col("doc_id").alias("a"), F.col("of").alias("b")).filter("a <> b").distinct())
    copies = ws.stage(copies, "copies")
    alone = ws.stage(full.join(copies.select(F.col("a").alias("doc_id")).distinct(), "doc_id", "left_anti")
                     .dropDuplicates(["doc_id", "digest"]), "class-documents")

    bands = alone.select(F.explode(F.array_distinct("bands")).alias("band"), "doc_id")
    stars = ws.stage(bands.groupBy("band").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top"))
                     .filter("b <> top").select("band", "b"), "bands")
    met = ws.stage(bands.join(stars, "band"), "met")
    ids = met.select("doc_id").distinct()
    texts = ws.stage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                     .join(ids.hint("merge"), "doc_id", "left_semi"), "texts")

    near = met.select(F.col("doc_id").alias("a"), "b").filter("a <> b").distinct()
    facts = alone.select("doc_id", "n_shingles", "sketch")
    side = lambda c: facts.toDF(c, f"n_{c}", f"sketch_{c}")
    near = (near.join(side("a"), "a").join(side("b"), "b")
            .filter(_size_ok("n_a", "n_b") & estimate_ok("sketch_a", "sketch_b")).select("a", "b"))
    near = ws.stage(near, "candidates")
    links = confirm(ws, near, texts)

    first = components(ws, links)
    members = ws.stage(met.select("band", "doc_id").join(first, F.col("doc_id") == F.col("node"), "left")
                       .select("band", "doc_id", F.coalesce("component", "doc_id").alias("component")), "members")
    open_bands = (members.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                  .filter("lo <> hi").select("band"))
    rest = ws.stage(members.join(open_bands, "band", "left_semi"), "open-bands")
    fine = fine_sketches(texts.join(rest.select("doc_id").distinct(), "doc_id", "left_semi"))
    facts = alone.select("doc_id", "n_shingles", "sketch", "bands")
    rest = ws.stage(rest.join(facts, "doc_id").join(fine, "doc_id"), "open-members")
    own = lambda c: rest.select("band", *[F.col(x).alias(f"{y}{c}") for x, y in (
        ("doc_id", ""), ("component", "c_"), ("n_shingles", "n_"), ("sketch", "sketch_"), ("fine", "fine_"),
        ("bands", "bands_"))])
    # Two documents may share many bands: their pair is made in the smallest.
    meeting = F.array_min(F.array_intersect("bands_a", "bands_b"))
    between = (own("a").join(own("b"), "band")
               .filter((F.col("c_a") > F.col("c_b")) & _size_ok("n_a", "n_b")
                       & estimate_ok("sketch_a", "sketch_b")
                       & estimate_ok("fine_a", "fine_b", FINE_SAMPLES, FINE_BITS, FINE_BAR)
                       & (F.col("band") == meeting))
               .select("a", "b").distinct())
    done = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    more = confirm(ws, ws.stage(between.join(done, ["a", "b"], "left_anti"), "between"), texts)

    everything = components(ws, links.unionByName(more).unionByName(copies))
    return (sig.select("doc_id", "n_shingles").join(everything, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, and whether it is the document
    that stays."""
    with Workspace(docs.sparkSession, "near-dedup") as ws:
        found = groups(docs, ws)
        return ws.finish(found.withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicate(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, one document of each group; rows without a doc_id
    stay.  Different texts under one doc_id are nodes of their own, of which the
    one of smallest text hash has the doc_id and the others come after all
    doc_ids below 2**62; rows equal in both count once."""
    named = docs.filter("doc_id IS NOT NULL").withColumn("__hash", F.xxhash64(F.col("text").cast("string")))
    several = (named.groupBy("doc_id").agg(F.min("__hash").alias("__lo"), F.max("__hash").alias("__hi"))
               .filter("__lo <> __hi").select("doc_id", "__lo"))
    late = F.xxhash64("doc_id", "__hash").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    named = named.join(several, "doc_id", "left").withColumn(
        "__node", F.when(F.col("__hash") != F.col("__lo"), late).otherwise(F.col("doc_id").cast("long")))
    found = near_duplicates(named.select(F.col("__node").alias("doc_id"), "text"))
    gone = found.filter("NOT kept").select(F.col("doc_id").alias("__node")).distinct()
    left = named.join(gone.hint("merge"), "__node", "left_anti").dropDuplicates(["__node"])
    return left.select(docs.columns).unionByName(docs.filter("doc_id IS NULL"))
