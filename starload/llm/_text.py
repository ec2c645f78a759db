"""Vectorised text primitives used inside Spark tasks.

A chunk of documents is one flat ``uint8`` array plus row offsets.  Words,
lines and byte windows are index arrays into it, and every window hash comes
from one prefix sum, so no Python loop runs per word or byte.

Hash of ``data[s:e]``: ``sum(T[b_i] * B**(i - s))`` modulo 2**64, read from a
prefix sum over ``T[b_i] * B**i`` and the inverse power of ``s``; the result
is passed through an avalanche mix together with the length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20          # text bytes handled at once in a Python worker
U64 = np.uint64

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
_TABLES = _rng.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * U64(2) + U64(1)
_BASES = (0x9E3779B97F4A7C15 & ~7 | 5, 0xC2B2AE3D27D4EB4F & ~7 | 5)
_MULTS = _rng.integers(1, 2**63, size=64, dtype=np.uint64) * U64(2) + U64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit avalanche (the splitmix64 finaliser)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to exponent n."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 1 << 16)
        base = _BASES[which]
        out = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[which] = have = (out[0], out[1])
    return have


class PrefixHash:
    """Hashes of arbitrary slices of one byte array."""

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        power, self._inv = _powers(which, n)
        self._sum = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_TABLES[which][data] * power[:n], out=self._sum[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sum[end] - self._sum[start]) * self._inv[start]
        return mix(h + (end - start).astype(np.uint64) * U64(0x9E3779B97F4A7C15))

    def windows(self, width: int) -> np.ndarray:
        """Hash of every slice of the given width, by start."""
        n = len(self._sum) - 1
        if n < width:
            return np.zeros(0, dtype=np.uint64)
        return mix((self._sum[width:] - self._sum[:n - width + 1]) * self._inv[:n - width + 1])


class Chunk:
    """Rows of one text column as flat bytes."""

    def __init__(self, column: pa.Array):
        if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
            kind = np.int64
        elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            kind = np.int32
        else:
            raise TypeError(f"text column expected, got {column.type}")
        n = len(column)
        self.n = n
        self.valid = (np.ones(n, dtype=bool) if column.null_count == 0
                      else np.asarray(column.is_valid()))
        _, offsets, data = column.buffers()
        if n == 0 or offsets is None:
            self.off = np.zeros(n + 1, dtype=np.int64)
            self.data = np.zeros(0, dtype=np.uint8)
            return
        off = np.frombuffer(offsets, dtype=kind, count=n + 1 + column.offset)[column.offset:].astype(np.int64)
        raw = (np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
               if data is not None else np.zeros(0, dtype=np.uint8))
        self.off, self.data = off - off[0], raw

    def lengths(self) -> np.ndarray:
        return np.diff(self.off)

    def words(self, lower: bool = False, inside: np.ndarray = IS_WORD) -> "Words":
        return Words(self, LOWER[self.data] if lower else self.data, inside)


class Words:
    """Runs of the bytes in ``table`` (by default ``[^\\x20\\x09-\\x0D]``); they never
    cross rows."""

    def __init__(self, chunk: Chunk, data: np.ndarray, table: np.ndarray):
        self.data, off = data, chunk.off
        inside = table[data]
        first, last = inside.copy(), inside.copy()
        if len(data):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            full = np.flatnonzero(np.diff(off))
            first[off[full]] = inside[off[full]]
            last[off[full + 1] - 1] = inside[off[full + 1] - 1]
        self.inside = inside
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.row_off = np.searchsorted(self.start, off)      # word offsets by row
        self.count = np.diff(self.row_off)
        self.row = np.repeat(np.arange(chunk.n), self.count)

    def hashes(self, which: int = 0) -> np.ndarray:
        return PrefixHash(self.data, which).slices(self.start, self.end)

    def shingles(self, hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each word on; the last k - 1 of a row are cut
        by ``shingle_rows``."""
        n = len(hashes)
        if n < k:
            return np.zeros(0, dtype=np.uint64)
        out = hashes[:n - k + 1] * _MULTS[0]
        for j in range(1, k):
            out += hashes[j:n - k + 1 + j] * _MULTS[j]
        return mix(out)

    def shingle_ok(self, k: int) -> np.ndarray:
        """Whether the k words from each word on lie in one row (all words but the
        last k - 1 of the chunk)."""
        n = len(self.start)
        if n < k:
            return np.zeros(0, dtype=bool)
        return self.row[:n - k + 1] == self.row[k - 1:]


def sequence_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash of a whole short word sequence, apart from any shingle's."""
    n = len(hashes)
    h = (hashes * _MULTS[32 + np.arange(n) % 32]).sum(dtype=np.uint64, keepdims=True)
    return mix(h + np.array([n], dtype=np.uint64) * U64(0xD6E8FEB86659FD93))


def signed(h: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark longs."""
    return h.view(np.int64)


def chunks(batches, text: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    """Slices of Arrow batches of about ``size`` text bytes; a longer text is
    one slice of its own."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        whole = Chunk(column)
        at = 0
        while at < whole.n:
            to = int(np.searchsorted(whole.off, whole.off[at] + size, side="right")) - 1
            to = min(max(to, at + 1), whole.n)
            part = batch.slice(at, to - at)
            yield part, Chunk(part.column(part.schema.get_field_index(text)))
            at = to


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by start (doubling)."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out
