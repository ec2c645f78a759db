"""Quality rules with risk-controlled cutoffs (operator 1).

Measured per document in one vectorised pass: word, symbol, duplicate-line and
repeated-word counts.  Each rule's share falls into one of ``STEPS`` + 1
buckets; a rule rejects a document whose bucket is at least the rule's cutoff.

Cutoffs are learned per stratum from labelled documents.  For each rule the
cutoffs are tested from lenient to strict (a fixed sequence, which needs no
further correction); each test is the exact binomial tail of the good holdout
documents it would reject against the allowed rate, at level
``delta / (strata * rules)`` (Bonferroni).  The first failed test ends the
sequence.  With probability 1 - delta, no rule in any stratum rejects more than
``alpha / rules`` of the good documents, so all rules of a stratum together
reject at most ``alpha``.  Among certified cutoffs the one with the best gain
(share of bad documents minus share of good ones rejected) is used, if any has
a gain.  A stratum with too few labels certifies nothing: its documents face
the base rules alone.

Defined cases: null or empty text has no words and fails the base rules; a null
stratum is a stratum of its own; labels repeated for a document count once and
as good only if all say so; null labels and labels of unknown documents are
ignored; each input row, repeated or not, gives one result row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx
from starload.llm._work import Workspace

STEPS = 64
ALPHA = 0.02
DELTA = 0.05
RULES = ("symbols", "dup_lines", "repeats", "long_words")
WORD_LENGTH_AT_TOP = 64     # mean word length that fills the last bucket

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _repeats(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, key) digest, and which entries equal the one before."""
    both = tx.mix(key + row.astype(np.uint64) * tx.U64(0x9FB21C651E98DF25))
    order = np.argsort(both, kind="stable")
    ranked = both[order]
    same = np.zeros(len(ranked), dtype=bool)
    same[1:] = ranked[1:] == ranked[:-1]
    return order, same


def _measure(chunk: tx.Chunk) -> dict[str, np.ndarray]:
    n, data = chunk.n, chunk.data
    w = chunk.words()
    per_row = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[chunk.off])
    out = {"n_words": w.count,
           "word_chars": per_row(w.inside & ((data & 0xC0) != 0x80)),
           "n_symbols": per_row(_SYMBOL[data])}
    prefix = tx.PrefixHash(data)

    full = chunk.off[:-1][np.diff(chunk.off) > 0]
    breaks = np.flatnonzero(data == 10) + 1
    start = np.unique(np.concatenate((full, breaks[breaks < len(data)])))
    end = np.append(start[1:], len(data))
    if len(start):
        end = np.where(data[end - 1] == 10, end - 1, end)
    worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[worded], end[worded]
    line_row = np.searchsorted(chunk.off, start, side="right") - 1
    order, same = _repeats(line_row, prefix.slices(start, end))
    out["n_lines"] = np.bincount(line_row, minlength=n)
    out["n_dup_lines"] = np.bincount(line_row[order[same]], minlength=n)

    windows = w.shingles(prefix.slices(w.start, w.end), 5)
    at = np.flatnonzero(w.shingle_ok(5))
    order, same = _repeats(w.row[at], windows[at])
    twice = same.copy()
    twice[:-1] |= same[1:]
    found = at[order[twice]]
    cover = np.zeros(len(w.start) + 5, dtype=np.int64)
    np.add.at(cover, found, 1)
    np.add.at(cover, found + 5, -1)
    covered = np.cumsum(cover)[:len(w.start)] > 0
    out["n_repeat_words"] = np.bincount(w.row[covered], minlength=n)
    return out


def features(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The measured columns of every row, beside the columns named in ``keep``."""
    narrow = docs.select(*keep, F.col(text).alias("text"))
    fields = [f for f in narrow.schema.fields if f.name in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                       + [f"{c} long" for c in FEATURES])

    def run(batches):
        for part, chunk in tx.chunks(batches):
            got = _measure(chunk)
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(c)) for c in keep]
                + [pa.array(got[c].astype(np.int64)) for c in FEATURES], names=[*keep, *FEATURES])

    return narrow.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def buckets() -> Column:
    """Array of each rule's bucket, in the order of RULES."""
    def bucket(part, whole, top=1):
        share = F.col(part) / F.greatest(F.col(whole), F.lit(1)) / top
        return F.least(F.floor(share * STEPS), F.lit(STEPS)).cast("int")
    return F.array(bucket("n_symbols", "word_chars"), bucket("n_dup_lines", "n_lines"),
                   bucket("n_repeat_words", "n_words"),
                   bucket("word_chars", "n_words", WORD_LENGTH_AT_TOP))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            h *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return h


def binomial_tail(k: int, n: int, p: float) -> float:
    """Exact P(X <= k) for X ~ Binomial(n, p), as an incomplete beta function."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    a, b, x = n - k, k + 1, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def _certify(good: np.ndarray, bad: np.ndarray, allowed: float, level: float) -> int:
    """Best certified cutoff of one rule from its bucket counts; STEPS + 1 if none."""
    n, n_bad = int(good.sum()), int(bad.sum())
    best, gain = STEPS + 1, 0.0
    for cut in range(STEPS, 0, -1):
        rejected = int(good[cut:].sum())
        if n == 0 or binomial_tail(rejected, n, allowed) > level:
            break
        now = bad[cut:].sum() / max(n_bad, 1) - rejected / n
        if now > gain:
            best, gain = cut, now
    return best


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, cuts) from labelled rows (stratum, good, buckets).

    The rows are first counted by (stratum, rule, bucket), so a stratum reaches
    its task as at most ``2 * len(RULES) * (STEPS + 1)`` counts.
    """
    counts = (labelled.select("stratum", "good", F.posexplode("buckets").alias("rule", "bucket"))
              .groupBy("stratum", "rule", "bucket")
              .agg(F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad")))
    strata = labelled.select("stratum").distinct().count()
    level = delta / (max(strata, 1) * len(RULES))
    allowed = alpha / len(RULES)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        cuts = []
        for rule in range(len(RULES)):
            mine = rows[rows["rule"] == rule]
            good, bad = np.zeros(STEPS + 1, dtype=np.int64), np.zeros(STEPS + 1, dtype=np.int64)
            good[mine["bucket"]] = mine["n_good"]
            bad[mine["bucket"]] = mine["n_bad"]
            cuts.append(_certify(good, bad, allowed, level))
        return pd.DataFrame({"stratum": [rows["stratum"].iloc[0]], "cuts": [cuts]})

    return counts.groupBy("stratum").applyInPandas(choose, "stratum string, cuts array<int>")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of ``docs``: its counts, the base verdict, the rules that
    reject it and ``kept``."""
    with Workspace(docs.sparkSession, "quality") as ws:
        found = features(docs.select("doc_id", "text", F.col(stratum).cast("string").alias("stratum")),
                         "doc_id", "stratum")
        found = ws.stage(found, "features").withColumn("buckets", buckets())
        marks = (labels.filter("quality IS NOT NULL").groupBy("doc_id")
                 .agg((F.min("quality") == 1).alias("good")))
        learned = cutoffs(found.join(marks, "doc_id").select("stratum", "good", "buckets"), alpha, delta)
        learned = ws.stage(learned, "cutoffs").withColumnRenamed("stratum", "of")
        rejects = F.transform(F.arrays_zip("buckets", "cuts"), lambda x: x["buckets"] >= x["cuts"])
        out = (found.join(learned, F.col("stratum").eqNullSafe(F.col("of")), "left")
               .withColumn("base_failed", base_failed())
               .withColumn("by_rule", F.coalesce(rejects, F.array_repeat(F.lit(False), len(RULES))))
               .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       "base_failed",
                       (~F.col("base_failed") & ~F.exists("by_rule", lambda x: x)).alias("kept"),
                       *[F.col("by_rule")[i].alias(f"rejected_by_{r}") for i, r in enumerate(RULES)]))
        return ws.finish(out)
