"""Language identification by a byte convolutional network (operator 6).

One-hot bytes (A-Z lowered) of a fixed-length window pass filters of widths 2,
3 and 4, a rectifier, max pooling over positions and a softmax layer.  The
network is trained in numpy on a bounded sample of labelled documents; at
prediction every document is cut into windows over its whole length, and the
document's distribution is the normalised geometric mean of its windows',
weighted by their bytes.

The training sample is at most about ``SAMPLE_DOCS`` documents, the same number
per language, chosen by a hash of doc_id, with up to ``WINDOWS_PER_DOC`` evenly
spaced windows each.  The languages are the ``MAX_LANGUAGES`` most frequent labels
of the whole table, equal counts in the order of the labels; rarer ones are not
learned, and their documents are predicted as any others.

For prediction the filters are expanded to tables over byte pairs, so a
position costs two table rows instead of nine.

Defined cases: null text or text without a letter gives ``und`` with score 0,
as does everything if nothing is labelled, or a table without rows; null lang or
doc_id is not learned from; equal probabilities give the first language in the
order of the labels; very long texts are cut into windows over their whole length;
each input row gives one result row, repeated rows the same one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx
from starload.llm._work import extended

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_DOCS = 6000
WINDOWS_PER_DOC = 3
MAX_LANGUAGES = 512
UND = "und"
_LETTER = regex.compile(r"\p{L}")
_BLOCK = 64                    # windows per numpy step, so that its arrays stay in cache


def windows_of(chunk: tx.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, row, bytes used): every row cut into zero-padded windows."""
    length = chunk.lengths()
    per = -(-length // WINDOW)
    first = np.cumsum(per) - per
    flat = np.zeros(int(per.sum()) * WINDOW, dtype=np.uint8)
    shift = np.repeat(first * WINDOW - chunk.off[:-1], length)
    flat[shift + np.arange(len(chunk.data))] = tx.LOWER[chunk.data]
    row = np.repeat(np.arange(chunk.n), per)
    inner = np.arange(len(row)) - np.repeat(first, per)
    return flat.reshape(-1, WINDOW), row, np.minimum(length[row] - inner * WINDOW, WINDOW)


class ByteCnn:
    """Parameters: per width and offset a (256, FILTERS) table, a bias, a softmax layer."""

    def __init__(self, classes: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.p = {f"t{w}": rng.normal(0, 0.3 / np.sqrt(w), (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.p["b"] = np.zeros(FILTERS * len(WIDTHS), dtype=np.float32)
        self.p["v"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(classes))).astype(np.float32)
        self.p["c"] = np.zeros(len(classes), dtype=np.float32)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.01,
              seed: int = 11) -> None:
        """Adam on the cross entropy; gradients reach only the pooled positions."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                step += 1
                grads = self._gradients(x[order[at:at + batch]], y[order[at:at + batch]])
                for k, g in grads.items():
                    first[k] += 0.1 * (g - first[k])
                    second[k] += 0.001 * (g * g - second[k])
                    scale = rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                    self.p[k] -= scale * first[k] / (np.sqrt(second[k]) + 1e-7)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n, positions = len(x), WINDOW - max(WIDTHS) + 1
        pooled, where = [], []
        for w in WIDTHS:
            t = self.p[f"t{w}"]
            out = t[0][x[:, :positions]]
            for j in range(1, w):
                out = out + t[j][x[:, j:j + positions]]
            where.append(out.argmax(axis=1))
            pooled.append(out.max(axis=1))
        z = np.concatenate(pooled, axis=1) + self.p["b"]
        hidden = np.maximum(z, 0)
        prob = softmax(hidden @ self.p["v"] + self.p["c"])
        prob[np.arange(n), y] -= 1
        prob /= n
        back = (prob @ self.p["v"].T) * (z > 0)
        grads = {"v": hidden.T @ prob, "c": prob.sum(axis=0), "b": back.sum(axis=0)}
        filters = np.broadcast_to(np.arange(FILTERS), (n, FILTERS))
        for i, w in enumerate(WIDTHS):
            g = np.zeros_like(self.p[f"t{w}"])
            own = back[:, i * FILTERS:(i + 1) * FILTERS]
            for j in range(w):
                seen = np.take_along_axis(x, where[i] + j, axis=1)
                np.add.at(g[j], (seen, filters), own)
            grads[f"t{w}"] = g
        return grads

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Filter sums by byte pair: the first two offsets of all widths, and the
        remaining offsets of widths 3 and 4."""
        t2, t3, t4 = (self.p[f"t{w}"] for w in WIDTHS)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        none = np.zeros_like(t3[2])
        head = np.concatenate([pair(t2[0], t2[1]), pair(t3[0], t3[1]), pair(t4[0], t4[1])], axis=1)
        tail = np.concatenate([pair(t3[2], none), pair(t4[2], t4[3])], axis=1)
        return np.ascontiguousarray(head + self.p["b"]), np.ascontiguousarray(tail)

    def log_probabilities(self, x: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        head, tail = tables
        positions = WINDOW - max(WIDTHS) + 1
        out = np.empty((len(x), len(self.classes)), dtype=np.float32)
        for at in range(0, len(x), _BLOCK):
            part = x[at:at + _BLOCK].astype(np.int32)
            pairs = (part[:, :-1] << 8) | part[:, 1:]
            got = head.take(pairs[:, :positions], axis=0)
            got[:, :, FILTERS:] += tail.take(pairs[:, 2:2 + positions], axis=0)
            hidden = np.maximum(got.max(axis=1), 0)
            logits = hidden @ self.p["v"] + self.p["c"]
            logits -= logits.max(axis=1, keepdims=True)
            out[at:at + _BLOCK] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def held_out(mod: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == 2, F.lit(False))


def fit(docs: DataFrame, mod: int = 4, sample: int = SAMPLE_DOCS, languages: int = MAX_LANGUAGES) -> ByteCnn | None:
    """Train on a bounded sample of the labelled documents that are not held out, in
    the most frequent ``languages`` labels."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()
                           & F.col("doc_id").isNotNull() & ~held_out(mod))
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return None
    quota = max(sample // len(counts), 1)
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, quota / n)))])
    chosen = labelled.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003))
                             < share[F.col("lang")] * 1_000_003).select("lang", "text")

    def cut(batches):
        for part, chunk in tx.chunks(batches):
            x, row, _ = windows_of(chunk)
            total = np.bincount(row, minlength=chunk.n)
            inner = np.arange(len(row)) - (np.cumsum(total) - total)[row]
            stride = -(-total // WINDOWS_PER_DOC)
            take = np.flatnonzero(inner % np.maximum(stride, 1)[row] == 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row[take])), pa.array([w.tobytes() for w in x[take]], pa.binary())],
                names=["lang", "window"])

    rows = chosen.mapInArrow(cut, "lang string, window binary").toPandas()
    rows = rows.sort_values(["lang", "window"], kind="stable")
    model = ByteCnn(sorted(counts))
    if len(rows) and len(model.classes) > 1:
        index = {k: i for i, k in enumerate(model.classes)}
        x = np.frombuffer(b"".join(rows["window"]), dtype=np.uint8).reshape(-1, WINDOW)
        model.train(x, rows["lang"].map(index).to_numpy())
    return model


def predict(docs: DataFrame, model: ByteCnn | None, *keep: str,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` with the language and its probability, one row per row."""
    narrow = docs.select(*keep, F.col("text").alias("__text"))
    schema = extended(narrow.schema.fields[:-1], f"`{names[0]}` string, `{names[1]}` double")

    def run(batches):
        tables = model.tables() if model else None
        for part, chunk in tx.chunks(batches, "__text"):
            texts = part.column(part.num_columns - 1).to_pylist()
            worded = np.array([x is not None and _LETTER.search(x) is not None for x in texts], dtype=bool)
            best, score = np.zeros(chunk.n, dtype=np.int64), np.zeros(chunk.n)
            if model:
                x, row, size = windows_of(chunk)
                total = np.zeros((chunk.n, len(model.classes)))
                np.add.at(total, row, model.log_probabilities(x, tables) * size[:, None])
                prob = softmax(total / np.maximum(chunk.lengths(), 1)[:, None])
                best, score = prob.argmax(axis=1), prob.max(axis=1)
            else:
                worded[:] = False
            langs = [model.classes[b] if ok else UND for b, ok in zip(best, worded, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(part.num_columns - 1)]
                + [pa.array(langs, pa.string()), pa.array(np.where(worded, score, 0.0))],
                names=[*keep, *names])

    return narrow.mapInArrow(run, schema)
