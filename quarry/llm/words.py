"""Vectorised tokenising and Rabin-Karp hashing of Arrow text batches.

Texts are handled as UTF-8 bytes: every word class used here is ASCII-defined, and the bytes of multi-byte
characters are never ASCII, so byte tables split exactly as the character classes do. Hashes are polynomial modulo
2**64 with an odd multiplier, so the hash of any span is a difference of prefix sums times an inverse power, and no
loop runs over bytes or words. Each finished hash goes through a 64-bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 4 << 20  # bytes of text worked on at once; a longer text is a slice of its own
STRETCH = 1 << 18  # values hashed at once
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Family:
    """One hash family: a byte table and an odd multiplier, both derived from the seed by rule."""

    def __init__(self, seed: int) -> None:
        base = np.arange(1, 260, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed * 0x632BE59BD9B4E019 & _MASK)
        values = mix(mix(base))
        self.table = values[:256] | U64(1)
        self.mult = int(values[257]) | 1
        self._pow = self._inv = np.ones(1, U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers 0..n-1 of the multiplier and of its inverse modulo 2**64."""
        if len(self._pow) < n:
            size = max(n, 1 << 16)
            for name, m in (("_pow", self.mult), ("_inv", pow(self.mult, -1, 1 << 64))):
                p = np.full(size, m, U64)
                p[0] = 1
                setattr(self, name, np.cumprod(p))
        return self._pow[:n], self._inv[:n]

    def spans(self, values: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
        """Hash of values[start:end] for each pair; equal spans have equal hashes wherever they stand. Starts ascend.
        With a table, values are looked up in it. Works on a stretch of values at a time, to bound memory."""
        out = np.empty(len(start), U64)
        at = 0
        while at < len(start):
            lo = int(start[at])
            to = int(np.searchsorted(start, lo + STRETCH))
            part = values[lo : int(end[at:to].max())]
            part = part if table is None else table[part]
            power, inverse = self.powers(len(part) + 1)
            sums = np.zeros(len(part) + 1, U64)
            np.cumsum(part * power[:-1], out=sums[1:])
            s, e = start[at:to] - lo, end[at:to] - lo
            out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(U64))
            at = to
        return out


FIRST, SECOND = Family(1), Family(2)


def byte_class(pattern: bytes, *, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(is a word byte, byte after folding): the bytes of the pattern split words; lower folds A-Z."""
    word = np.ones(256, bool)
    word[list(pattern)] = False
    fold = np.arange(256, dtype=np.uint8)
    if lower:
        fold[65:91] += 32
    return word, fold


SPACE = b" \t\n\x0b\x0c\r"
CASED = byte_class(SPACE, lower=False)
FOLDED = byte_class(SPACE, lower=True)
# only digits, letters and everything beyond ASCII make words
ALNUM = byte_class(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


@dataclass
class Words:
    """Words of consecutive texts: byte spans in data, and per text the range first[i]:first[i + 1] of its words."""

    data: np.ndarray  # folded bytes of all texts
    text: np.ndarray  # byte offsets of the texts, one more than texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self, family: Family = FIRST) -> np.ndarray:
        return family.spans(self.data, self.start, self.end, family.table)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def windows(self, k: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Word ranges (start, end) of every k-word window inside one text; with short, a text of fewer words but
        not none is one window."""
        n = self.counts()
        per = np.maximum(n - k + 1, 0)
        if short:
            per = np.where((n > 0) & (per == 0), 1, per)
        begin = np.repeat(self.first[:-1] - np.concatenate(([0], np.cumsum(per)[:-1])), per) + np.arange(per.sum())
        return begin, np.minimum(begin + k, np.repeat(self.first[1:], per))

    def window_owner(self, k: int, short: bool = False) -> np.ndarray:
        n = self.counts()
        per = np.maximum(n - k + 1, 0)
        if short:
            per = np.where((n > 0) & (per == 0), 1, per)
        return np.repeat(np.arange(len(n)), per)


def _buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.chunk(0) if texts.num_chunks else pa.array([], pa.string())
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1] if off else np.zeros(1, np.int64)
    return offsets, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)


def split(data: np.ndarray, offsets: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> Words:
    """Words of the texts data[offsets[i]:offsets[i + 1]]; offsets start at 0."""
    word, fold = table
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = word[data]
    cut = offsets[:-1][np.diff(offsets) > 0]
    start = inside[:-1].copy()
    start[1:] &= ~inside[:-2]
    start[cut] = inside[cut]
    end = inside[:-1] & ~inside[1:]
    last = cut[cut > 0] - 1
    end[last] = inside[last]
    begins = np.flatnonzero(start)
    return Words(fold[data], offsets, begins, np.flatnonzero(end) + 1, np.searchsorted(begins, offsets))


def slices(texts: pa.Array | pa.ChunkedArray, table: tuple[np.ndarray, np.ndarray], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, one past the last row, words) of runs of whole texts of about limit bytes."""
    offsets, data = _buffers(texts)
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, split(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], table)
        lo = hi


def words_of(texts: pa.Array | pa.ChunkedArray, table: tuple[np.ndarray, np.ndarray]) -> Words:
    """All texts as one slice (for chunks whose size is bounded already)."""
    offsets, data = _buffers(texts)
    return split(data[offsets[0] : offsets[-1]], offsets - offsets[0], table)


def kept_texts(words: Words, keep: np.ndarray) -> pa.Array:
    """Per text, the kept words joined by one space, as a string array."""
    data, n = words.data.copy(), len(words.data)
    s, e, owner = words.start[keep], words.end[keep], words.owner()[keep]
    joined = np.zeros(len(e), bool)
    joined[:-1] = owner[1:] == owner[:-1]  # another kept word of the text follows, and so a separator byte exists
    data[e[joined]] = 0x20
    edge = np.zeros(n + 2, np.int8)
    edge[s] += 1
    edge[e + joined] -= 1
    inside = np.cumsum(edge[:n], dtype=np.int8) > 0
    at = np.concatenate(([0], np.cumsum(np.bincount(owner, weights=e - s + joined, minlength=len(words.first) - 1))))
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data[inside])])
