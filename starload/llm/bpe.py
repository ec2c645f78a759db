"""BPE encoding and decoding by speculation and verification (operator 8).

Per distinct word: a greedy longest match over the vocabulary proposes tokens;
every adjacent pair of proposed tokens is then looked up, vectorised over the
batch, in a table of pairs that merging leaves apart.  A sequence whose pairs
all stand is the exact encoding, since the first merge across a token border
would also happen in the pair alone.  Only words with a failing pair are merged
exactly.

Text handling follows the tokenizer file: special tokens are found in the raw
text, the rest is NFC-normalised and lowered, split by the file's pattern, and
words end in ``</w>``.  Texts inside the Latin blocks after lowering take a direct path with
the same classes written out; other texts are normalised and split by the
tokenizer's own normaliser and splitter.  Decoding joins the tokens by a space, as the
file names no decoder.

Defined cases: null text is empty and gives no tokens; each input row gives one
result row.  The word memory of a task is cleared at ``MEMORY`` words and at the
task's end.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.llm import _text as tx
from starload.llm._work import extended

MEMORY = 300_000
_END = "\ue000"                       # stands for </w> as one symbol
_NEVER = 1 << 60                      # rank of a pair that never merges
_UNKNOWN = 0xFFFFFF                   # a letter without a token; never merges, gives no id
_SINGLE = (1,)

# The file's classes of white space, letters and numbers inside
# U+0000-U+024F, and its pattern over them (after lowering).
_SPACE = "\t-\r \x85\xa0"
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_SPACE}{_LETTERS}{_NUMBERS}]+")
_BEYOND = re.compile("[\u0250-\U0010ffff]")


def _byte_symbols() -> dict[int, str]:
    """Byte to printable symbol, the mapping of byte-level vocabularies: printable
    Latin-1 stands for itself, the rest is numbered from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class WordBpe:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        own = lambda t: t[:-len(suffix)] + _END if t.endswith(suffix) and t != suffix else t
        self.ids = {own(t): i for t, i in model["vocab"].items()}
        self.shown = {i: t for t, i in model["vocab"].items()}
        self._text = {i: t for t, i in self.ids.items()}
        self._ranks: dict[int, int] = {}              # left id, right id -> rank
        self._made: list[int] = []                    # rank -> id of the joined token
        for rank, pair in enumerate(model["merges"]):
            a, b = map(own, pair if isinstance(pair, list) else pair.split(" "))
            self._ranks[self.ids[a] << 24 | self.ids[b]] = rank
            self._made.append(self.ids[a + b])
        # Tokens that merging their own letters gives back, and the lengths they
        # have by their first two letters, longest first.
        self._whole = {t: i for t, i in self.ids.items() if self.merge(self.letters(t)) == [i]}
        lengths: dict[str, set[int]] = {}
        for t in self._whole:
            lengths.setdefault(t[:2], set()).add(len(t))
        self._lengths = {k: sorted(v | {1}, reverse=True) for k, v in lengths.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.shown |= {i: t for t, i in self.special.items()}
        self._specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        library = Tokenizer.from_file(path)
        self._normalize = library.normalizer.normalize_str
        self._split = library.pre_tokenizer.pre_tokenize_str
        self._bytes = _byte_symbols()
        self._pairs = np.zeros(0, dtype=np.int64)     # verified pairs, sorted: code * 2 + stands
        # Encodings of words given as text and of words given in byte symbols:
        # count, decimal ids and shown tokens, the latter two joined by a space.
        self._memory: tuple[dict, dict] = ({}, {})

    def merge(self, ids: list[int]) -> list[int]:
        """Exact merging: the pair of lowest rank, leftmost first, until none is left."""
        if len(ids) > 64:
            return self._merge_long(ids)
        get = self._ranks.get
        ranks = [get(a << 24 | b, _NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            token = self._made[best]
            ids[i:i + 2] = [token]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << 24 | token, _NEVER)
            if i < len(ranks):
                ranks[i] = get(token << 24 | ids[i + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same over a heap of (rank, place), for words of any length."""
        n, get = len(ids), self._ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(get(a << 24 | b, _NEVER), i) for i, (a, b) in enumerate(zip(ids, ids[1:]))]
        heap = [entry for entry in heap if entry[0] != _NEVER]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j == n or get(ids[i] << 24 | ids[j]) != rank:
                continue                  # the pair has changed since
            ids[i], ids[j], after[i] = self._made[rank], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n:
                    again = get(ids[left] << 24 | ids[right], _NEVER)
                    if again != _NEVER:
                        heappush(heap, (again, left))
        return [i for i in ids if i >= 0]

    def letters(self, text: str) -> list[int]:
        """Initial tokens; the end mark belongs to the last letter."""
        symbols = [*text[:-2], text[-2:]] if text.endswith(_END) else text
        return [self.ids.get(s, _UNKNOWN) for s in symbols]

    def _propose(self, word: str) -> list[int]:
        out, i, n, whole = [], 0, len(word), self._whole
        while i < n:
            for size in self._lengths.get(word[i:i + 2], _SINGLE):
                to = i + size
                if to <= n and to != n - 1:
                    token = whole.get(word[i:to])
                    if token is not None:
                        break
            else:
                return []
            out.append(token)
            i = to
        return out

    def _standing(self, codes: np.ndarray) -> np.ndarray:
        """Which pair codes stand; unknown pairs are decided once by merging."""
        distinct = np.unique(codes)
        known = self._pairs >> 1
        at = np.searchsorted(known, distinct)
        new = distinct[(at >= len(known)) | (known[np.minimum(at, max(len(known) - 1, 0))] != distinct)
                       if len(known) else np.ones(len(distinct), dtype=bool)]
        if len(new):
            verdicts = []
            for code in new.tolist():
                pair = [code >> 24, code & 0xFFFFFF]
                verdicts.append(self.merge(self.letters(self._text[pair[0]] + self._text[pair[1]])) == pair)
            fresh = new * 2 + np.array(verdicts, dtype=np.int64)
            base = self._pairs if len(self._pairs) < 4_000_000 else np.zeros(0, dtype=np.int64)
            self._pairs = np.sort(np.concatenate((base, fresh)))
            if len(base) < len(known):      # the table was cleared: decide this batch's others again
                return self._standing(codes)
            known = self._pairs >> 1
        return (self._pairs[np.searchsorted(known, codes)] & 1).astype(bool)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of words given in byte symbols with the end mark."""
        proposals = [self._propose(w) for w in words]
        sizes = np.fromiter(map(len, proposals), dtype=np.int64, count=len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        stands = self._standing((flat[inner] << 24) | flat[inner + 1])
        failed = sizes == 0
        failed[owner[inner[~stands]]] = True
        for i in np.flatnonzero(failed).tolist():
            proposals[i] = [t for t in self.merge(self.letters(words[i])) if t != _UNKNOWN]
        return proposals

    def _symbols(self, word: str) -> str:
        if word.isascii() and word.isprintable():     # printable ASCII stands for itself
            return word
        return "".join([self._bytes[b] for b in word.encode()])

    def _learn(self, words: list[str], mapped: bool) -> None:
        """Put the encodings of unknown words into the memory."""
        keys = words if mapped else map(self._symbols, words)
        memory, shown = self._memory[mapped], self.shown
        for word, ids in zip(words, self.encode_words([k + _END for k in keys]), strict=True):
            memory[word] = (len(ids), " ".join(map(str, ids)), " ".join([shown[i] for i in ids]))

    def pieces(self, text: str) -> tuple[list[str], bool]:
        """Words of one stretch without special tokens; whether in byte symbols."""
        lowered = text.lower()        # some capitals below U+0250 have their small letter above
        if _BEYOND.search(lowered) is None:
            return _LATIN.findall(lowered), False
        return [w for w, _ in self._split(self._normalize(text))], True

    def _words(self, texts: list[str]) -> list[list[tuple[int, str, str]]]:
        """Per text the memory's entries of its words, special tokens included."""
        if sum(map(len, self._memory)) > MEMORY:
            self.forget()
        plans, seen = [], (set(), set())
        for text in texts:
            plan = []
            for i, part in enumerate(self._specials.split(text)):
                if i % 2:
                    plan.append((part, None))
                elif part:
                    words, mapped = self.pieces(part)
                    seen[mapped].update(words)
                    plan.append((words, mapped))
            plans.append(plan)
        for mapped in (False, True):
            unknown = seen[mapped].difference(self._memory[mapped])
            if unknown:
                self._learn(list(unknown), mapped)
        out = []
        for plan in plans:
            row = []
            for part, mapped in plan:
                if mapped is None:
                    row.append((1, str(self.special[part]), part))
                else:
                    row += map(self._memory[mapped].__getitem__, part)
            out.append(row)
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[int, list[int], str]]]:
        """Per text its words' (count, ids, shown tokens), special tokens included."""
        return [[(n, [int(i) for i in ids.split()], shown) for n, ids, shown in row] for row in self._words(texts)]

    def encode_joined(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text the number of tokens, the decimal ids joined by one space and
        the text decoded from them."""
        out = []
        for row in self._words(texts):
            counts, ids, shown = zip(*[w for w in row if w[0]]) if row else ((), (), ())
            out.append((sum(counts), " ".join(ids), " ".join(shown)))
        return out

    def forget(self) -> None:
        """Give the word memory back; workers live on between tasks and keep only
        the bounded tables of tokens and pairs."""
        for memory in self._memory:
            memory.clear()

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.shown[i] for i in ids)


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def encode_documents(docs: DataFrame, path: str, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, ids and the text decoded from them, one row per row."""
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = extended(narrow.schema.fields[:-1], "ids array<int>, decoded string")

    def run(batches):
        bpe = word_bpe(path)
        for part, _ in tx.chunks(batches, "__text"):
            texts = [x or "" for x in part.column(part.num_columns - 1).to_pylist()]
            sizes, ids, decoded = zip(*bpe.encode_joined(texts))
            flat = np.fromiter(map(int, " ".join(ids).split()), dtype=np.int32, count=sum(sizes))
            ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(part.num_columns - 1)]
                + [ids, pa.array(decoded, pa.string())], names=[*keep, "ids", "decoded"])
        bpe.forget()

    return narrow.mapInArrow(run, schema)


def digest_documents(docs: DataFrame, path: str, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep``, n_tokens and the digests of ids and decoded text; ids and
    text stay inside the task."""
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = extended(narrow.schema.fields[:-1], "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches):
        bpe = word_bpe(path)
        for part, _ in tx.chunks(batches, "__text"):
            texts = [x or "" for x in part.column(part.num_columns - 1).to_pylist()]
            n, ids, decoded = zip(*bpe.encode_joined(texts))
            ids_digest = [hashlib.sha256(x.encode()).hexdigest() for x in ids]
            text_digest = [hashlib.sha256(x.encode()).hexdigest() for x in decoded]
            yield pa.RecordBatch.from_arrays(
                [part.column(i) for i in range(part.num_columns - 1)]
                + [pa.array(n, pa.int64()), pa.array(ids_digest), pa.array(text_digest)],
                names=[*keep, "n_tokens", "ids_sha256", "decoded_sha256"])
        bpe.forget()

    return narrow.mapInArrow(run, schema)
