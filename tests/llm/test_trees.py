"""Searches over vectors and the Merkle manifest against brute force: nulls,
non-finite and zero vectors, repeats, ties, other lengths, clashing columns,
empty tables, and packs small enough that many shards and blocks meet."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starload.llm import cover_tree, merkle, vp_tree
from starload.llm._vectors import array, load, matrix

NAN, INF = float("nan"), float("inf")
FIELDS = "vec_id long, embedding array<double>, label int, score string, rank int, query string, vector long"


def rows_of(n=260, dim=6, seed=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    out = []
    for i in range(n):
        c = centres[i % 5]
        out.append((i, [x + rng.gauss(0, 0.4) for x in c], rng.randrange(4)))
    out += [out[10], out[10], (300, out[20][1], out[20][2]), (301, out[20][1], 9), (302, out[20][1], 9)]
    out += [(20, [x + 0.5 for x in out[20][1]], 1)]                            # another row under one id
    out += [(400, None, 1), (401, [], 1), (402, [0.0] * dim, 1), (403, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
            (404, [NAN] * dim, 1), (405, [INF] + [1.0] * (dim - 1), 1), (None, out[3][1], 1), (406, out[4][1], None),
            (500, [1.0, 2.0, 3.0], 1), (501, [1.0, 2.0, 2.5], 1), (502, [3.0, -1.0, 2.0], 2),
            (600, [1e300] * dim, 1), (601, [1e-300] * dim, 1), (602, [-1e9] * dim, 2)]
    return out


@pytest.fixture(scope="module")
def vectors(spark):
    data = rows_of()
    random.Random(1).shuffle(data)
    full = [(i, v, label, "s", 7, "q", 1) for i, v, label in data]
    return spark.createDataFrame(full, FIELDS).repartition(5), data


def finite(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def exact_cosine(a, b):
    def unit(v):
        m = max(abs(x) for x in v)
        v = [x / m for x in v]
        n = math.sqrt(math.fsum(x * x for x in v))
        return [x / n for x in v]
    return math.fsum(x * y for x, y in zip(unit(a), unit(b)))


def distinct(data, *, labelled):
    seen = {(i, tuple(v), label if labelled else 0) for i, v, label in data
            if i is not None and finite(v) and (label is not None or not labelled)}
    return sorted(seen)


def test_nearest_equals_brute_force(vectors):
    df, data = vectors
    rows = [r for r in distinct(data, labelled=False) if any(r[1])]
    got = vp_tree.nearest(df, F.col("vec_id") % 20 == 0, shard=16, block=4).collect()
    mine = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got)
    want = []
    for q, v, _ in [r for r in rows if r[0] % 20 == 0]:
        best = sorted((-round(exact_cosine(v, w), 12), i) for i, w, _ in rows if i != q and len(w) == len(v))[:5]
        want += [(q, rank, i, round(-s, 9) + 0.0) for rank, (s, i) in enumerate(best, 1)]
    assert mine == sorted(want)
    assert {r.query_id for r in got} >= {20, 300, 500, 600} and max(r.rank for r in got) == 5
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 500] == [501, 502]   # its length only


def test_factor_one_is_exact_and_a_larger_one_only_loses_neighbours(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    data = centres[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 16))
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)],
                               "vec_id long, embedding array<double>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    truth = {q: set(np.argsort(-np.where(np.arange(3000) == q, -2, unit @ unit[q]))[:5]) for q in range(0, 3000, 50)}

    def recall(factor):
        got = vp_tree.nearest(df, F.col("vec_id") % 50 == 0, factor=factor).collect()
        return sum(r.vec_id in truth[r.query_id] for r in got) / (5 * len(truth))

    assert recall(1.0) == 1.0
    assert 0.9 <= recall(1.5) <= 1.0


def test_vantage_point_tree_skips_what_the_bounds_exclude(monkeypatch):
    """On clustered rows fewer pairs are multiplied than all."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 24))
    data = centres[rng.integers(0, 30, 4000)] + 0.02 * rng.normal(size=(4000, 24))
    tree = vp_tree.build(pa.table({"vec_id": pa.array(range(4000)), "vector": pa.array(data.tolist())}))
    spans = array(tree, "spans").reshape(-1, 3)
    assert sorted(tree.column("vec_id").to_pylist()) == list(range(4000)) and (spans[:, 2] >= 0).any()
    scored = []
    exact = vp_tree.cosines
    monkeypatch.setattr(vp_tree, "cosines", lambda a, b: scored.append(len(a)) or exact(a, b))
    block = pa.table({"query": pa.array([0]), "vec_id": pa.array([17]), "vector": pa.array([data[17].tolist()])})
    found = vp_tree.search(tree, [block])
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    want = np.argsort(-np.where(np.arange(4000) == 17, -2, unit @ unit[17]))[:5]
    assert set(found.column("vec_id").to_pylist()) == set(want) and sum(scored) < 400


def brute_negatives(data, step, positives=5, negatives=5):
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in distinct(data, labelled=True)
            if all(abs(x) * 256 < math.sqrt(2**62 / len(v)) - 1 for x in v)]
    out = []

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    for a, v, label in [r for r in rows if r[0] % step == 0]:
        others = [(-dot(v, w), i, k) for i, w, k in rows if i != a and len(w) == len(v)]
        for p, positive, _ in sorted(x for x in others if x[2] == label)[:positives]:
            fit = sorted((s, i) for s, i, k in others if k != label and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(a, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(vectors):
    df, data = vectors
    want = brute_negatives(data, 20)
    for shard, block in ((16, 4), (4096, 256)):
        got = cover_tree.mine(df, F.col("vec_id") % 20 == 0, shard=shard, block=block)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 100


def test_products_are_exact_beyond_doubles():
    a = np.array([[2.0**28 + 1, 1.0]])
    assert cover_tree.products(a, a)[0, 0] == (2**28 + 1) ** 2 + 1


def test_cover_tree_nests_covers_and_separates():
    rng = np.random.default_rng(8)
    data = np.concatenate([rng.normal(size=(1500, 5)), np.repeat(rng.normal(size=(1, 5)), 300, axis=0)])
    tree = cover_tree.builder(256)(pa.table({
        "vec_id": pa.array(range(len(data))), "label": pa.array([0] * len(data)), "vector": pa.array(data.tolist())}))
    points, _ = cover_tree.augmented(cover_tree.integers(tree, 256))
    nodes, radii = array(tree, "nodes").reshape(-1, 5), array(tree, "radii")
    assert sorted(tree.column("vec_id").to_pylist()) == list(range(len(data)))
    for n, (lo, hi, parent, depth, leaf) in enumerate(nodes):
        away = np.linalg.norm(points[lo:hi] - points[lo], axis=1)
        assert away.max() <= radii[n] + 1e-6                                   # the radius covers all rows below
        children = nodes[nodes[:, 2] == n]
        if leaf:
            assert hi - lo <= cover_tree.LEAF or radii[n] == 0
            continue
        assert lo in children[:, 0]                                            # nesting
        assert sum(children[:, 1] - children[:, 0]) == hi - lo
        widest = max(radii[nodes[:, 2] == n])
        centres = points[children[:, 0]]
        apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + 1e18 * np.eye(len(centres))
        assert apart.min() > widest - 1e-6                                     # separation


def test_searches_of_nothing(vectors):
    df, _ = vectors
    none = df.limit(0)
    assert vp_tree.nearest(none, F.col("vec_id") % 5 == 0).collect() == []
    assert cover_tree.mine(none, F.col("vec_id") % 5 == 0).collect() == []
    assert vp_tree.nearest(df, F.col("vec_id") == -5).collect() == []
    alone = df.filter("vec_id = 402 or vec_id = 600")
    assert vp_tree.nearest(alone, F.col("vec_id") == 600).collect() == []
    assert cover_tree.mine(df.filter("vec_id = 500 or vec_id = 501"), F.col("vec_id") == 500).collect() == []


# ---------------------------------------------------------------- Merkle manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha(*map(enc, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))

    def small(text):
        return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    def tree(hashes):
        """Siblings (left, right) of every leaf, and what remains."""
        paths, at = [[] for _ in hashes], list(range(len(hashes)))
        while len(hashes) > 1:
            for i, pos in enumerate(at):
                run = hashes[pos // 8 * 8:pos // 8 * 8 + 8]
                paths[i].append(("".join(run[:pos % 8]), "".join(run[pos % 8 + 1:])))
            hashes = [sha(*hashes[i:i + 8]) for i in range(0, len(hashes), 8)]
            at = [pos // 8 for pos in at]
        return paths, hashes[0] if hashes else None

    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        low[g] = tree([leaf(r, r["text"]) for r in groups[g]])
    above, root = tree([low[g][1] for g in order])
    out = []
    for rank, g in enumerate(order):
        for r, path in zip(groups[g], low[g][0]):
            whole = path + above[rank]
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            h = leaf(r, small(r["text"]) if hit else r["text"])
            for left, right in whole:
                h = sha(left, h, right)
            out.append((r["doc_id"] if r["doc_id"] is not None else -1, leaf(r, r["text"]), low[g][1], root,
                        sha(*[a + b for a, b in whole]), h, h == root))
    return sorted(out)


@pytest.fixture(scope="module")
def manifest_rows(spark):
    rng = random.Random(4)
    rows = [dict(doc_id=i, text=rng.choice(["Some Text ", "lower only ", "É日本 A "]) * (i % 7), lang="en",
                 source="s" if i % 3 else None, n_chars=i) for i in range(530)]
    rows += [dict(doc_id=600 + i, text="de Text", lang="de", source="x", n_chars=1) for i in range(9)]
    rows += [dict(doc_id=700 + i, text="Null lang", lang=None, source="x", n_chars=None) for i in range(3)]
    rows += [dict(doc_id=800 + i, text="alone", lang=f"l{i}é", source="", n_chars=1) for i in range(11)]
    rows += [dict(doc_id=900, text=None, lang="", source="x", n_chars=0),
             dict(doc_id=901, text="LONG " * 200_000, lang="en", source="x", n_chars=0),
             dict(doc_id=None, text="No Id", lang="en", source="x", n_chars=0)]
    rows += [dict(rows[5]), dict(rows[5]), dict(rows[5], text="Other Text under the id")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 as grp", "2 as pos", "3 as h", "4 as row", "5 as leaf", "'p' as path").repartition(4), rows


def test_manifest_equals_brute_force(manifest_rows):
    df, rows = manifest_rows
    out = merkle.check_tampering(df)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((r.doc_id if r.doc_id is not None else -1, *tuple(r)[1:]) for r in out.collect())
    assert got == brute_manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 2


def test_manifest_of_one_row_and_of_none(manifest_rows):
    df, _ = manifest_rows
    assert merkle.check_tampering(df.limit(0)).collect() == []
    one = merkle.check_tampering(df.filter("doc_id = 900")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified
    assert one.proof_sha256 == hashlib.sha256(b"").hexdigest()


def test_manifest_windows_hold_one_run(manifest_rows):
    nodes = manifest_rows[0].selectExpr("lang as grp", "doc_id as pos", "530L as n", "text as h")
    under, lags, leads = merkle._runs(nodes)
    plan = under.select(F.concat_ws("", *lags, *leads))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(grp" in plan and "run" in plan.split("hashpartitioning(grp")[1].split(")")[0]
    assert "SinglePartition" not in plan and "Python" not in plan
