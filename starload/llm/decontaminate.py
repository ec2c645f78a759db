"""Benchmark decontamination: latent cosine, anchors, subsequences (operator 10).

1. Every whole document is cut into passages of ``PASSAGE`` terms (runs of
   letters, digits and accents, each character of a script without spaces by
   itself; lowered, hashed to ``TERMS`` columns).  One pass counts passage frequencies for the idf weights.
2. A second pass multiplies a random matrix by the Gram matrix of the TF-IDF
   passages, a partial sum per task and one row per term.  The driver gets
   TERMS x RANK numbers whatever the input, and finishes the randomised SVD
   (Nystroem form).
3. Benchmark items are the query set, taken in blocks of about ``ITEMS``.  Windows
   of about an item's length, a quarter of it apart, over the whole of every
   document are compared with the item in the whitened latent space; those with
   a cosine of ``COSINE`` and ``SHARED`` of its terms are candidates.  The bar
   is set from measured recall: a paraphrase that keeps ``PARAPHRASE`` of the
   terms, at any offset, passes it nine times of ten.
4. A second path is exact for rare terms.  A leak
   holds ``PARAPHRASE`` of an item's terms, so it misses at most the rest and
   holds some of the item's rarest terms (the anchors, by idf).  Every stretch
   of a whole document with as many anchors as a leak must hold is a candidate,
   at any offset; no stretch of up to ``reach`` words that step
   5 confirms is lost.
5. Candidates of both paths are confirmed on the words around them: a copy if the longest
   common subsequence holds ``COPY`` of the item's terms, and a paraphrase if
   it holds ``PARAPHRASE`` of them and ``ANSWER`` of the answer, the item's
   last quarter.  The cosine of the words looked at is reported with it.

Defined cases: null or empty text has no passages and no leaks; items below
``LEAST`` terms count when all their terms follow each other in a row, one-term
items too; items without a term, null ones included, are in no row; items above
``LONGEST`` terms are searched in pieces, of which any counts; very long texts are searched
whole, in stretches of ``STRETCH`` terms; repeated items report once per item_id; an empty
benchmark finds nothing; each input row, repeated ones too, gives one result row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx

TERMS, RANK, PASSAGE = 1 << 14, 32, 32
LEAST, LONGEST = 8, 120
ITEMS = 2048
COPY, PARAPHRASE, ANSWER = 0.75, 0.6, 0.75
WINDOWS = (8, 12, 16, 24, 32, 48, 64, 96, 128)   # terms, 4 or 6 blocks; an item takes the nearest by ratio
COSINE, SHARED = 0.5, 0.4     # of a window with an item in the latent space, and of its terms
STRETCH = 1 << 13              # terms whose windows are compared at once

IS_TERM = np.zeros(256, dtype=bool)
IS_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


# Scripts written without spaces, whose characters are terms of their own, and
# what no term holds beyond ASCII.
UNSPACED = (r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{1950}-\x{19FF}\x{1A20}-\x{1AAF}"
            r"\x{3005}-\x{3007}\x{3040}-\x{312F}\x{31A0}-\x{31FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}"
            r"\x{A980}-\x{A9FF}\x{AA60}-\x{AADF}\x{F900}-\x{FAFF}\x{FF66}-\x{FF9F}\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}")
_MARKS = r"[^\x00-\x7F\pL\pN\pM]+"


def spaced(texts: pa.Array) -> pa.Array:
    """Texts with every character of an unspaced script and every mark that is no
    letter, digit or accent set apart; only texts that can hold one are rewritten."""
    chunk = tx.Chunk(texts)
    data = chunk.data
    # By lead byte: U+0080-U+00BF, the signs of multiplication and division, accents
    # without a letter, all beyond U+033F; letters only lie between.
    odd = (data == 0xC2) | (data == 0xCB) | (data >= 0xCD)
    odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    odd = np.append(0, np.cumsum(odd))
    rows = np.diff(odd[chunk.off]) > 0
    if not rows.any():
        return texts
    some = texts.filter(pa.array(rows))
    some = pc.replace_substring_regex(some, f"([{UNSPACED}])", r" \1 ")
    some = pc.replace_substring_regex(some, _MARKS, " ")
    return pc.replace_with_mask(texts, pa.array(rows), some)


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, column, row offsets) of all terms."""
    w = tx.Chunk(spaced(pc.utf8_lower(texts))).words(inside=IS_TERM)
    hashes = w.hashes()
    return hashes, (hashes >> np.uint64(50)).astype(np.uint16), w.row_off


def passages_of(off: np.ndarray, size: int = PASSAGE) -> np.ndarray:
    """Start offsets of consecutive passages of every row."""
    length = np.diff(off)
    per = -(-length // size)
    first = np.repeat(off[:-1], per)
    return first + (np.arange(len(first)) - np.repeat(np.cumsum(per) - per, per)) * size


def block_sums(rows: np.ndarray, column: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Sum of the terms' rows over blocks of up to ``size`` terms; ``rows`` ends in
    a row of zeros, which stands for the terms a short block lacks."""
    none = len(rows) - 1
    padded = np.append(column.astype(np.int64), np.full(size, none))
    length = np.diff(np.append(starts, len(column)))
    out = rows.take(padded[starts], axis=0)
    for i in range(1, size):
        out += rows.take(np.where(i < length, padded[starts + i], none), axis=0)
    return out


def zero_ended(rows: np.ndarray) -> np.ndarray:
    return np.concatenate((rows, np.zeros((1, rows.shape[1]), rows.dtype))).astype(np.float32)


def passage_counts(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Passages that hold each term column, and all passages."""
    def run(batches):
        total, n = np.zeros(TERMS, dtype=np.int64), 0
        for part, _ in tx.chunks(batches):
            _, column, off = terms_of(part.column(0))
            starts = passages_of(off)
            if len(starts):
                owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(column))))
                pair = np.sort((owner << 14) | column)
                first = np.append(True, pair[1:] != pair[:-1])
                total += np.bincount(pair[first] & (TERMS - 1), minlength=TERMS)
                n += len(starts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(TERMS), -1).astype(np.int32)), pa.array(np.append(total, n))],
            names=["term", "n"])

    rows = (docs.select("text").mapInArrow(run, "term int, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    got = np.zeros(TERMS + 1, dtype=np.int64)
    got[rows["term"]] = rows["n"]
    return got[:TERMS], int(got[TERMS])


def _gram_times(docs: DataFrame, idf: np.ndarray, omega: np.ndarray) -> np.ndarray:
    """(A'A) omega over all unit-length TF-IDF passages A, from partial sums."""
    weighted = zero_ended(omega * idf[:, None])
    square = (idf * idf).astype(np.float32)

    def run(batches):
        total = np.zeros((RANK, TERMS))
        for part, _ in tx.chunks(batches):
            _, column, off = terms_of(part.column(0))
            starts = passages_of(off)
            if not len(starts):
                continue
            y = block_sums(weighted, column, starts, PASSAGE)
            y /= np.maximum(np.add.reduceat(square[column], starts), 1e-12)[:, None]
            owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(column))))
            for i, values in enumerate(np.ascontiguousarray(y.T)):
                total[i] += np.bincount(column, values[owner], minlength=TERMS)
        total = total.T
        used = np.flatnonzero(np.any(total, axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32))] + [pa.array(total[used, i].astype(np.float32)) for i in range(RANK)],
            names=["term", *(f"z{i}" for i in range(RANK))])

    schema = "term int, " + ", ".join(f"z{i} float" for i in range(RANK))
    rows = (docs.select("text").mapInArrow(run, schema).groupBy("term")
            .agg(*[F.sum(f"z{i}").alias(f"z{i}") for i in range(RANK)]).toPandas())
    out = np.zeros((TERMS, RANK))
    out[rows["term"]] = rows[[f"z{i}" for i in range(RANK)]].to_numpy()
    return out * idf[:, None]


def latent_space(docs: DataFrame, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(TERMS + 1, rank) projection of raw term counts, and the idf weights: idf times the
    right singular vectors of the TF-IDF passages, each divided by its singular
    value; the last row is zero."""
    counts, n = passage_counts(docs)
    idf = np.log((n + 1) / (counts + 1)) + 1e-3
    omega = np.random.default_rng(seed).normal(size=(TERMS, RANK))
    image = _gram_times(docs, idf, omega)
    core = omega.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-9 * max(values.max(), 1e-300)
    factor = image @ (vectors[:, keep] / np.sqrt(values[keep]))
    if not factor.shape[1]:
        return zero_ended(np.zeros((TERMS, 1))), idf
    right, singular, _ = np.linalg.svd(factor, full_matrices=False)
    keep = singular > 1e-6 * max(singular[0], 1e-300)
    return zero_ended(idf[:, None] * right[:, keep] / singular[keep]), idf


def anchors(item: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, int]:
    """Places of an item, rarest terms first, and how many of them any leak holds:
    a leak misses at most ``n - least`` places, so it holds ``need`` of any
    ``n - least + need``; a short item has its rarest place only."""
    n = len(item)
    if n < LEAST:
        return np.argsort(-rarity, kind="stable")[:1], 1
    least = next(k for k in range(n + 1) if k / n >= PARAPHRASE)
    need = max(2, n // 6)
    return np.argsort(-rarity, kind="stable")[:n - least + need], need


def window_of(n: int) -> int:
    """Size of the windows an item of ``n`` terms is compared with; 0 for short ones."""
    return 0 if n < LEAST else min(WINDOWS, key=lambda size: abs(np.log(n / size)))


class Items:
    """A block of the query set, as pieces, with the index from anchor terms to
    pieces."""

    def __init__(self, rows: list[tuple], space: np.ndarray, idf: np.ndarray):
        self.ids, self.hashes, self.need = [], [], []
        column = pa.array([t or "" for _, t in rows], pa.string())
        hashes, columns, off = terms_of(column)
        keys, pieces_of, places, latent, parts = [], [], [], [], []
        for i, (item, _) in enumerate(rows):
            a, n = int(off[i]), int(off[i + 1] - off[i])
            pieces = max(1, -(-n // LONGEST))
            parts += [(item, a + n * p // pieces, a + n * (p + 1) // pieces) for p in range(pieces)]
        for item, lo, hi in sorted(parts, key=lambda x: window_of(x[2] - x[1])):
            if hi > lo:
                own = hashes[lo:hi]
                at, need = anchors(own, idf[columns[lo:hi]])
                own_keys, first = np.unique(own[at], return_index=True)
                keys.append(own_keys)
                places.append(at[first])
                pieces_of.append(np.full(len(own_keys), len(self.ids)))
                latent.append(space[columns[lo:hi]].sum(axis=0))
                self.ids.append(item)
                self.hashes.append(own)
                self.need.append(need)
        latent = np.array(latent, dtype=np.float32).reshape(-1, space.shape[1])
        self.latent = latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
        self.length = np.array([len(h) for h in self.hashes], dtype=np.int64)
        self.need = np.array(self.need, dtype=np.int64)
        flat = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        order = np.argsort(flat, kind="stable")
        self.keys, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.piece = np.concatenate(pieces_of)[order] if keys else np.zeros(0, dtype=np.int64)
        self.place = np.concatenate(places)[order] if keys else np.zeros(0, dtype=np.int64)
        # Pieces ascend by their window, so a window's pieces are a slice; which of them
        # hold a term is counted in bytes, as no window is beyond 255 terms.
        self.member = np.zeros((TERMS + 1, len(self.ids)), dtype=np.uint8)
        for i, own in enumerate(self.hashes):
            self.member[(own >> np.uint64(50)).astype(np.int64), i] = 1
        kind = np.array([window_of(n) for n in self.length.tolist()], dtype=np.int64)
        self.by_window = []
        for size in WINDOWS:
            own = slice(*np.searchsorted(kind, (size, size + 1)).tolist())
            if own.stop > own.start:
                need = np.ceil(SHARED * self.length[own]).astype(np.uint8)
                self.by_window.append((size, own, need))
        self.open = np.zeros(TERMS, dtype=bool)
        self.open[(self.keys >> np.uint64(50)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, piece, place) of every word that is an anchor term of a piece."""
        word = np.flatnonzero(self.open[columns])
        at = np.minimum(np.searchsorted(self.keys, hashes[word]), len(self.keys) - 1)
        same = self.keys[at] == hashes[word]
        word, at = word[same], at[same]
        per = self.count[at]
        entry = np.repeat(self.first[at] - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
        return np.repeat(word, per), self.piece[entry], self.place[entry]


def _common_share(masks: dict[int, int], full: int, words: list[int]) -> int:
    row = full
    for w in words:
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return row


def confirm(item: np.ndarray, masks: dict[int, int], words: list[int]) -> tuple[float, float]:
    """Shares of the item and of its answer (last quarter) in the longest common
    subsequence with the words, bit-parallel over the item."""
    n = len(item)
    row = _common_share(masks, (1 << n) - 1, words)
    answer = max(n // 4, 1)
    missing = row.bit_count()
    tail = {w: m >> (n - answer) for w, m in masks.items()}
    kept = answer - _common_share(tail, (1 << answer) - 1, words).bit_count()
    return (n - missing) / n, kept / answer


def _candidates(items: Items, word: np.ndarray, piece: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, middle word) of stretches that hold as many anchors as a leak must."""
    order = np.lexsort((word, piece))
    word, piece = word[order], piece[order]
    here = np.arange(len(word))
    end = here + items.need[piece] - 1
    inside = end < len(word)
    here, end = here[inside], end[inside]
    ok = ((piece[here] == piece[end]) & (row[word[here]] == row[word[end]])
          & (word[end] - word[here] < 2 * reach(items.length[piece[here]])))
    here, end = here[ok], end[ok]
    return piece[here], (word[here] + word[end]) // 2


def _paired(rows: np.ndarray) -> np.ndarray:
    return rows[0::2] + rows[1::2]


def _windows(blocks: np.ndarray, size: int, n: int) -> np.ndarray:
    """Sums over ``size`` neighbouring blocks, for the first ``n`` starts."""
    out = blocks[:n] + blocks[1:n + 1]
    for i in range(2, size):
        out += blocks[i:n + i]
    return out


def latent_candidates(items: Items, space: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece, middle word) of the windows near an item in the latent space.  Windows
    lie on one grid over all rows; the row of its middle is the one looked at.
    Blocks of neighbouring terms are summed once and paired for the larger windows."""
    pieces, middles = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    beyond = -(-(STRETCH + 2 * WINDOWS[-1]) // 64) * 64
    for lo in range(0, len(columns) if items.by_window else 0, STRETCH):
        part = columns[lo:lo + beyond].astype(np.int64)
        n = min(len(part), STRETCH)
        whole = -(-(n + 2 * WINDOWS[-1]) // 64) * 64         # zero rows stand beyond the end
        part = np.append(part, np.full(max(whole - len(part), 0), TERMS))[:whole]
        seen, held, hop = _paired(space.take(part, axis=0)), _paired(items.member.take(part, axis=0)), 2
        for size, own, need in items.by_window:
            while 4 * hop < size and 6 * hop < size:
                seen, held, hop = _paired(seen), _paired(held), 2 * hop
            starts = -(-n // hop)
            sums = _windows(seen, size // hop, starts)
            bar = COSINE * np.sqrt(np.maximum(np.einsum("ij,ij->i", sums, sums), 1e-12))
            near = sums @ items.latent[own].T >= bar[:, None]
            near &= _windows(held[:, own], size // hop, starts) >= need
            at, which = np.divmod(np.flatnonzero(near), len(need))
            pieces.append(own.start + which)
            middles.append(lo + np.minimum(at * hop + size // 2, n - 1))
    return np.concatenate(pieces), np.concatenate(middles)


def _short(items: Items, hashes: np.ndarray, off: np.ndarray, row: np.ndarray, word: np.ndarray,
           piece: np.ndarray, place: np.ndarray) -> list[tuple[int, int]]:
    """(piece, first word) of the exact copies of short pieces, one per row."""
    start, n = word - place, items.length[piece]
    ok = (start >= off[row[word]]) & (start + n <= off[row[word] + 1])
    start, piece, n = start[ok], piece[ok], n[ok]
    own = np.zeros((len(items.hashes), LEAST), dtype=np.uint64)
    for p in np.unique(piece).tolist():
        own[p, :len(items.hashes[p])] = items.hashes[p]
    same = np.ones(len(start), dtype=bool)
    for j in range(LEAST):
        same &= (j >= n) | (hashes[np.minimum(start + j, len(hashes) - 1)] == own[piece, j])
    start, piece = start[same], piece[same]
    order = np.lexsort((start, piece, row[start]))
    start, piece = start[order], piece[order]
    first = np.append(True, (piece[1:] != piece[:-1]) | (row[start[1:]] != row[start[:-1]]))[:len(start)]
    return list(zip(piece[first].tolist(), start[first].tolist(), strict=True))


def reach(n):
    """Words a leak of an item of ``n`` terms may stretch over, a quarter inserted."""
    return n + n // 4


def _search(items: Items, space: np.ndarray, hashes: np.ndarray, columns: np.ndarray,
            off: np.ndarray) -> dict[tuple[int, object], tuple]:
    """Confirmed leaks of one chunk: (row, item id) to its best (share, answer,
    first word, last word + 1, cosine)."""
    found: dict[tuple[int, object], tuple] = {}
    if not len(hashes) or not len(items.ids):
        return found
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    word, piece, at = items.hits(hashes, columns)
    short = items.length[piece] < LEAST
    for p, start in _short(items, hashes, off, row, word[short], piece[short], at[short]):
        r, n = int(row[start]), int(items.length[p])
        seen = space[columns[start:start + n]].sum(axis=0)
        cosine = float(seen @ items.latent[p] / max(float(np.linalg.norm(seen)), 1e-12))
        found[r, items.ids[p]] = (1.0, 1.0, start - int(off[r]), start - int(off[r]) + n, cosine)
    word, piece = word[~short], piece[~short]
    checked: set[tuple[int, int, int]] = set()
    masks: dict[int, dict[int, int]] = {}
    near, far = _candidates(items, word, piece, row), latent_candidates(items, space, columns)
    union = np.unique(np.stack([np.concatenate(x) for x in zip(near, far, strict=True)]), axis=1)
    for p, middle in zip(*union.tolist(), strict=True):
        item, r = items.hashes[p], int(row[middle])
        place = (r, p, middle // max(len(item) // 2, 1))
        if place in checked:
            continue
        a, b = max(middle - reach(len(item)), int(off[r])), min(middle + reach(len(item)) + 1, int(off[r + 1]))
        if p not in masks:
            own: dict[int, int] = {}
            for j, h in enumerate(item.tolist()):
                own[h] = own.get(h, 0) | 1 << j
            masks[p] = own
        words = [h for h in hashes[a:b].tolist() if h in masks[p]]
        # a subsequence is no longer than the item's words that occur at all
        if sum(masks[p][h].bit_count() for h in set(words)) < PARAPHRASE * len(item):
            continue
        share, answer = confirm(item, masks[p], words)
        if share >= COPY or share >= PARAPHRASE and answer >= ANSWER:
            checked.add(place)
            seen = space[columns[a:b]].sum(axis=0)
            cosine = float(seen @ items.latent[p] / max(float(np.linalg.norm(seen)), 1e-12))
            key, new = (r, items.ids[p]), (share, answer, a - int(off[r]), b - int(off[r]), cosine)
            if key not in found or found[key] < new:
                found[key] = new
    return found


LEAK = "struct<item_id: {0}, share: double, answer: double, lo: int, hi: int, cosine: double>"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``__leaks``, the benchmark items found in the row:
    share of the item in common, share of its answer, the word range looked at,
    and its cosine with the item."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    kind = LEAK.format(items.schema["item_id"].dataType.simpleString())
    n = items.count()
    blocks = max(1, -(-n // ITEMS))
    if n:
        space, idf = latent_space(docs.select(F.col("text").cast("string").alias("text")))
    out = docs.withColumn("__leaks", F.array().cast(f"array<{kind}>"))
    for block in range(blocks if n else 0):
        rows = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
                .orderBy("item_id", "text").collect()]
        out = _leaks_of_block(out, Items(rows, space, idf), space)
    return out


def _leaks_of_block(docs: DataFrame, items: Items, space: np.ndarray) -> DataFrame:
    names = docs.columns
    at_text, at_leaks = names.index("text"), names.index("__leaks")

    def run(batches):
        for part, _ in tx.chunks(batches):
            hashes, columns, off = terms_of(part.column(at_text))
            found = _search(items, space, hashes, columns, off)
            cols = [part.column(i) for i in range(part.num_columns)]
            if found:
                lists = cols[at_leaks].to_pylist()
                for (r, item), (share, answer, lo, hi, cosine) in sorted(found.items(), key=lambda x: (x[0][0], str(x[0][1]))):
                    lists[r] = [*lists[r], {"item_id": item, "share": share, "answer": answer, "lo": lo,
                                            "hi": hi, "cosine": cosine}]
                cols[at_leaks] = pa.array(lists, cols[at_leaks].type)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.mapInArrow(run, docs.schema)


def leaked_pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, share, answer, kind, lo, hi, cosine), one row per leak."""
    found = leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", F.explode("__leaks").alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.share", "leak.answer",
                        F.when(F.col("leak.share") >= COPY, "copy").otherwise("paraphrase").alias("kind"),
                        "leak.lo", "leak.hi", "leak.cosine")
