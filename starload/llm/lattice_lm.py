"""Language-model scores from a subword lattice (operator 7).

The pieces and their order of weight come from an existing public vocabulary:
its scores rank the pieces, and a piece of rank r starts with a weight in
proportion to 1 / (r + 50).  Single bytes complete the vocabulary, so every
text has a segmentation.  One round of expectation-maximisation over the
training words (forward and backward sums over all segmentations of each
distinct word, weighted by its count) re-estimates the piece probabilities,
smoothed by the starting weights.  The end of a document is a piece of its own.

A word's probability is the sum over all its segmentations, by forward
recursion in log space.  A document is its words, each opened by a space, then
the end; no piece crosses a word, so its marginal probability is the product.

Scale: words are counted with partial aggregation; the lattice runs once per
distinct word, vectorised over words of equal length.  Words that hold at least
one token in ``HOT`` are at most ``HOT`` many and go to every task; all other
words meet their counts in a shuffle join.  What is collected is bounded by the
vocabulary and by ``HOT``.

Defined cases: null or empty text is one end token; repeated rows each count
and each get a row; a null doc_id is never held out; without training rows all
words are unknown and the lattice keeps the starting weights.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx
from starload.llm._work import Workspace
from starload.llm.lang_id import held_out

HOT = 200_000
FLUSH = 400_000                # distinct words a task holds before it emits them
PRIOR = 10_000.0               # pseudo-tokens given to the starting weights
LONG = 64                      # bytes from which a word is summed on its own
_BLOCK = 4096
LN10 = math.log(10.0)


class Pieces:
    """Byte strings with their ids; id 0-255 are single bytes, then the pieces,
    last the end."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names, ranks = [], []
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            text = model.id_to_piece(i).replace("▁", " ")
            if text == " " or " " not in text[1:]:
                names.append(text.encode())
                ranks.append(max(-model.get_score(i), 0.0))
        self.ids = {name: 256 + i for i, name in enumerate(names)}
        self.size = 256 + len(names) + 1
        weight = np.full(self.size, 1e-7)
        weight[256:-1] = 1.0 / (np.array(ranks) + 50.0)
        weight[-1] = 1e-3
        self.start = weight / weight.sum()
        self.longest = max(map(len, names))
        self._by_length = {}
        for width in range(1, self.longest + 1):
            own = [x for x in names if len(x) == width]
            if own:
                flat = np.frombuffer(b"".join(own), dtype=np.uint8)
                hashes = tx.PrefixHash(flat).slices(np.arange(len(own)) * width, (np.arange(len(own)) + 1) * width)
                order = np.argsort(hashes)
                self._by_length[width] = (hashes[order], np.array([self.ids[x] for x in own])[order])

    def matches(self, flat: np.ndarray, n: int, length: int):
        """For ``n`` words of one length: per width the piece id at every start,
        -1 where there is none."""
        prefix = tx.PrefixHash(flat)
        base = (np.arange(n) * length)[:, None]
        for width, (hashes, ids) in self._by_length.items():
            if width > length:
                continue
            start = base + np.arange(length - width + 1)
            found = prefix.slices(start, start + width)
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            yield width, np.where(hashes[at] == found, ids[at], -1)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


class Lattice:
    def __init__(self, vocab: Pieces, probability: np.ndarray):
        self.vocab = vocab
        self.log = np.append(np.log(probability), -np.inf)      # index -1: no piece
        self.byte = self.log[:256]

    def _arcs(self, words: list[bytes]):
        """Per width (>= 1) the ids of pieces and the log weights of arcs by start;
        a single byte is always an arc, beside a piece of that byte."""
        n, length = len(words), len(words[0])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = dict(self.vocab.matches(flat, n, length))
        singles = self.byte[flat].reshape(n, length)
        arcs = {w: self.log[i] for w, i in ids.items()}
        arcs[1] = np.logaddexp(singles, arcs[1]) if 1 in arcs else singles
        return flat, ids, arcs

    @staticmethod
    def _forward(n: int, length: int, arcs) -> np.ndarray:
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0.0
        for j in range(1, length + 1):
            terms = [alpha[j - w] + a[:, j - w] for w, a in arcs.items() if w <= j]
            top = np.maximum.reduce(terms)
            alpha[j] = top + np.log(sum(np.exp(t - top) for t in terms))
        return alpha

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Log marginal probability of words of one length (below LONG)."""
        _, _, arcs = self._arcs(words)
        return self._forward(len(words), len(words[0]), arcs)[-1]

    def expect(self, words: list[bytes], weight: np.ndarray, out: np.ndarray) -> None:
        """Add the expected piece counts of the words to ``out``."""
        flat, ids, arcs = self._arcs(words)
        n, length = len(words), len(words[0])
        alpha = self._forward(n, length, arcs)
        beta = np.full((length + 1, n), -np.inf)
        beta[length] = 0.0
        for i in range(length - 1, -1, -1):
            terms = [beta[i + w] + a[:, i] for w, a in arcs.items() if i + w <= length]
            top = np.maximum.reduce(terms)
            beta[i] = top + np.log(sum(np.exp(t - top) for t in terms))
        whole = alpha[length]
        for w, found in ids.items():
            span = length - w + 1
            post = np.exp(alpha[:span].T + self.log[found] + beta[w:].T - whole[:, None]) * weight[:, None]
            hit = found >= 0
            np.add(out, np.bincount(found[hit], post[hit], minlength=len(out)), out=out)
        post = np.exp(alpha[:length].T + self.byte[flat].reshape(n, length) + beta[1:].T - whole[:, None])
        np.add(out, np.bincount(flat, (post * weight[:, None]).ravel(), minlength=len(out)), out=out)

    def score_long(self, word: bytes) -> float:
        """The same sum for one word of any length."""
        log, ids, longest = self.log, self.vocab.ids, self.vocab.longest
        alpha = [0.0]
        for j in range(1, len(word) + 1):
            terms = [alpha[j - 1] + self.byte[word[j - 1]]]
            for i in range(max(0, j - longest), j):
                piece = ids.get(word[i:j])
                if piece is not None:
                    terms.append(alpha[i] + log[piece])
            top = max(terms)
            alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
        return alpha[-1]

    def score_all(self, words: list[bytes]) -> np.ndarray:
        """Log marginal probability of any words, each opened by a space."""
        out = np.empty(len(words))
        spaced = [b" " + w for w in words]
        size = np.fromiter(map(len, spaced), dtype=np.int64, count=len(spaced))
        order = np.argsort(size, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            if len(group) == 0:
                continue
            if size[group[0]] >= LONG:
                out[group] = [self.score_long(spaced[i]) for i in group]
                continue
            for at in range(0, len(group), _BLOCK):
                part = group[at:at + _BLOCK]
                out[part] = self.scores([spaced[i] for i in part])
        return out

    def expect_all(self, words: list[bytes], weight: np.ndarray, out: np.ndarray) -> None:
        """Expected counts of any words; long ones are cut into stretches."""
        cut, owner = [], []
        for i, w in enumerate(words):
            w = b" " + w
            for at in range(0, len(w), LONG):
                cut.append(w[at:at + LONG])
                owner.append(i)
        size = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        weight = weight[np.array(owner, dtype=np.int64)]
        order = np.argsort(size, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            for at in range(0, len(group), _BLOCK):
                part = group[at:at + _BLOCK]
                self.expect([cut[i] for i in part], weight[part], out)


def lowered_words(text) -> list[bytes]:
    """Words of one Arrow string, A-Z lowered."""
    raw = np.frombuffer(text.as_buffer(), dtype=np.uint8) if text.is_valid and len(text.as_buffer()) else None
    return [] if raw is None else tx.LOWER[raw].tobytes().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n_train, n_all) over all rows of (text, held_out)."""
    def run(batches):
        seen: dict[bool, Counter] = {False: Counter(), True: Counter()}

        def flush():
            for held, words in seen.items():
                if words:
                    n = pa.array(words.values(), pa.int64())
                    zero = pa.array(np.zeros(len(words), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words.keys(), pa.binary()), zero if held else n, n],
                        names=["word", "n_train", "n_all"])
                    words.clear()

        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                seen[held].update(lowered_words(text))
                if len(seen[held]) > FLUSH:
                    yield from flush()
        yield from flush()

    return (docs.select("text", "held_out").mapInArrow(run, "word binary, n_train long, n_all long")
            .groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all")))


def learn(words: DataFrame, n_docs: int, path: str) -> np.ndarray:
    """Piece probabilities after one round over the counted training words."""
    def run(batches):
        vocab = pieces(path)
        lattice, out = Lattice(vocab, vocab.start), np.zeros(vocab.size)
        for batch in batches:
            lattice.expect_all(batch.column(0).to_pylist(),
                               batch.column(1).to_numpy().astype(np.float64), out)
        used = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(out[used])],
                                         names=["piece", "expected"])

    rows = (words.filter("n_train > 0").select("word", "n_train")
            .mapInArrow(run, "piece int, expected double")
            .groupBy("piece").agg(F.sum("expected").alias("expected")).toPandas())
    vocab = pieces(path)
    total = PRIOR * vocab.start
    total[rows["piece"]] += rows["expected"]
    total[-1] += n_docs
    return total / total.sum()


def score(docs: DataFrame, path: str, mod: int = 7) -> DataFrame:
    """Per row of ``docs`` its token counts, base score and lattice score."""
    with Workspace(docs.sparkSession, "lattice") as ws:
        docs = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                           held_out(mod).alias("held_out"))
        words = ws.stage(count_words(docs), "words")
        n_docs = docs.filter("NOT held_out").count()
        total = words.agg(F.sum("n_train").alias("n"), F.count_if(F.col("n_train") > 0).alias("v"),
                          F.sum("n_all").alias("all")).first()
        n_tokens = (total["n"] or 0) + n_docs
        distinct = total["v"] + (n_docs > 0)
        probability = learn(words, n_docs, path)

        def lattice_scores(batches):
            lattice = Lattice(pieces(path), probability)
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2),
                     pa.array(lattice.score_all(batch.column(0).to_pylist()) / LN10)],
                    names=["word", "c", "n_all", "lattice"])

        words = ws.stage(words.mapInArrow(lattice_scores, "word binary, c long, n_all long, lattice double"),
                         "scored-words")
        bar = -(-(total["all"] or 0) // HOT)
        hot = {bytes(r["word"]): (math.log10(r["c"] + 1), r["lattice"], int(r["c"] > 0))
               for r in words.filter(F.col("n_all") >= bar).collect()}
        shared = docs.sparkSession.sparkContext.broadcast(hot)
        rare = words.filter(F.col("n_all") < bar).select("word", "c", "lattice")

        def split(batches):
            """Per document its sums over hot words (word null), and one row per
            other distinct word."""
            table = shared.value
            for batch in batches:
                names = ["rid", "doc_id", "held_out", "word", "times", "n", "known", "base", "lattice"]
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    row, word, times, sums = [], [], [], []
                    for i, text in enumerate(part.column(3)):
                        n = known = 0
                        base = lattice = 0.0
                        for w, k in Counter(lowered_words(text)).items():
                            n += k
                            got = table.get(w)
                            if got is None:
                                row.append(i)
                                word.append(w)
                                times.append(k)
                            else:
                                base += k * got[0]
                                lattice += k * got[1]
                                known += k * got[2]
                        sums.append((n, known, base, lattice))
                    m, own = len(row), np.array(sums, dtype=np.float64).reshape(-1, 4)
                    take = pa.array(np.concatenate((np.array(row, dtype=np.int64), np.arange(part.num_rows))))
                    pad = np.zeros(m)
                    cols = [part.column(c).take(take) for c in range(3)]
                    cols += [pa.array([*word, *[None] * part.num_rows], pa.binary()),
                             pa.array(np.concatenate((np.array(times, dtype=np.int64),
                                                      np.zeros(part.num_rows, dtype=np.int64))))]
                    cols += [pa.array(np.concatenate((pad, own[:, c])).astype(np.int64)) for c in (0, 1)]
                    cols += [pa.array(np.concatenate((pad, own[:, c]))) for c in (2, 3)]
                    yield pa.RecordBatch.from_arrays(cols, names=names)

        id_type = docs.schema["doc_id"].dataType.simpleString()
        rows = docs.select(F.xxhash64("doc_id", "text").alias("rid"), "doc_id", "held_out", "text").mapInArrow(
            split, f"rid long, doc_id {id_type}, held_out boolean, word binary, times long, "
                   "n long, known long, base double, lattice double")
        return ws.finish(_combine(ws.stage(rows, "doc-words"), rare, n_docs, n_tokens, distinct,
                                  float(probability[-1])))


def _combine(rows: DataFrame, rare: DataFrame, n_docs: int, n_tokens: int, distinct: int, end: float) -> DataFrame:
    """Join rare words to their counts and fold everything by row identity.

    Rows equal in doc_id and text share an identity; they are folded as
    ``copies`` and unfolded again at the end.
    """
    own = rows.filter("word IS NULL")
    met = (rows.filter("word IS NOT NULL").select("rid", "word", "times").join(rare, "word")
           .groupBy("rid").agg(F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"),
                               F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("base"),
                               F.sum(F.col("times") * F.col("lattice")).alias("lattice")))
    parts = (own.select("rid", "doc_id", "held_out", "n", "known", "base", "lattice", F.lit(1).alias("copies"))
             .unionByName(met.select("rid", "known", "base", "lattice", F.lit(0).alias("copies")),
                          allowMissingColumns=True))
    one = lambda c: F.sum(c) / F.sum("copies")
    folded = parts.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("copies").alias("copies"),
        (one("n").cast("long") + 1).alias("n_tokens"), one("known").cast("long").alias("known"),
        one("base").alias("base"), one("lattice").alias("lattice"))
    scale = math.log10(n_tokens + distinct + 1)
    ends = math.log10(n_docs + 1)
    return (folded.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("known") + (1 if n_docs else 0)).alias("n_known"),
                    F.lit(n_tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + ends - F.col("n_tokens") * scale).alias("base_score"),
                    (F.col("lattice") + math.log10(end)).alias("score")))

