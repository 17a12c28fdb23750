"""Periodic run detection by internal pattern matching (operator 13).

A run is a maximal stretch of words with smallest period q and a length of at least max(``LEAST``, ``TIMES`` * q).
Dyadic blocks, of length L = 2**k at multiples of L, query their nearest occurrences in the neighbouring windows, up to
L words to either side. The occurrences in such a window form one arithmetic progression with the block, and its
difference is the period of the block: a candidate. For every q there is an L with q < L <= 2q, and a run of 4q words
(at least 6) holds a whole aligned block of that length with room for q words on one side. The nearest occurrence there
is exactly q away: a nearer one would give the block, and with it the run's root, a shorter period that divides q. So
the candidates d of a level, L/2 <= d < L, hold every run; each is extended to both sides by direct comparison, and
stays if it is long enough.

An occurrence query is a range successor (or predecessor) query: the suffixes that begin with the block are a range of
the suffix array, and a wavelet matrix over the suffix array answers "the smallest position of this range not below x"
in one step per bit, for all blocks at once. Suffix arrays come from prefix doubling, which also gives the ranges of
each level; words of different documents never compare equal, so documents of a slice share one array.

Words are compared by 64-bit hashes, checked by those of a second family: equal hashes of different words inside a
slice are told apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import words
from quarry.llm.words import U64

LEAST, TIMES = 6, 4
SLICE_BYTES = 1 << 20


def word_ids(w: words.Words) -> np.ndarray:
    """Dense ids of the (document, word) pairs, in an arbitrary order of the words."""
    salt = words.mix((w.owner().astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
    first, second = words.mix(w.hashes() ^ salt), w.hashes(words.SECOND) ^ salt
    by = np.argsort(first, kind="stable")
    new = np.ones(len(by), bool)
    new[1:] = first[by][1:] != first[by][:-1]
    if len(by) and (second[by][1:] != second[by][:-1])[~new[1:]].any():  # different words with one hash
        by = np.lexsort((second, first))
        new[1:] = (first[by][1:] != first[by][:-1]) | (second[by][1:] != second[by][:-1])
    ids = np.empty(len(by), np.int64)
    ids[by] = np.cumsum(new) - 1
    return ids


def suffix_array(ids: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """(suffix array, blocks by level) by prefix doubling; suffixes stop at ``end``, the end of their document.

    A level (L, s, lo, hi) lists the aligned blocks ids[s:s + L] that lie in one document and occur more than once, with
    the range of the suffix array where they stand. Only suffixes that are not told apart yet are sorted again.
    """
    n = len(ids)
    rank = np.zeros(n, np.int64)  # suffixes that are smaller: where the group of equal prefixes begins
    order = np.argsort(ids, kind="stable")
    levels, size, active = [], 1, order
    keys = ids[order]
    while True:
        # active: the places of the unsettled groups in ``order``, group by group; keys: what their prefixes differ in
        new = np.ones(len(active), bool)
        new[1:] = keys[1:] != keys[:-1]
        begin = np.flatnonzero(new)
        count = np.diff(np.append(begin, len(active)))
        if size == 1:
            place = np.arange(n)
        order[place] = active
        rank[active] = np.repeat(place[begin], count)
        again = np.repeat(count > 1, count)
        active, place, count = active[again], place[again], np.repeat(count, count)[again]
        if not len(active):
            break
        if size > 1:
            block = (active % size == 0) & (active + size <= end[active])
            s = active[block]
            levels.append((size, s, rank[s], rank[s] + count[block]))
        # the next 'size' words decide, a document's end before any word; groups stay in place
        after = active + size
        inside = after < end[active]
        follow = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        group = rank[active]
        by = np.lexsort((follow, group))
        active = active[by]
        keys = (group * (n + 1) + follow)[by]
        size *= 2
    return order, levels


class WaveletMatrix:
    """Counting and selecting by value in ranges of an array of the numbers below n, for many queries at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate((values[bit == 0], values[bit == 1]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at lo..hi-1 are smaller than x."""
        out = np.where(x >> self.bits > 0, hi - lo, 0)
        for b, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            lo1, hi1 = ones[lo], ones[hi]
            up = ((x >> b) & 1).astype(bool) & (x >> self.bits == 0)
            out = out + np.where(up, (hi - hi1) - (lo - lo1), 0)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return out

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values at lo..hi-1; k is below hi - lo."""
        out = np.zeros(len(lo), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            lo1, hi1 = ones[lo], ones[hi]
            few = (hi - hi1) - (lo - lo1)
            up = k >= few
            out = 2 * out + up
            k = np.where(up, k - few, k)
            lo, hi = np.where(up, zeros + lo1, lo - lo1), np.where(up, zeros + hi1, hi - hi1)
        return out

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of each range that is not below x, or -1."""
        k = self.below(lo, hi, x)
        found = k < hi - lo
        return np.where(found, self.smallest(lo, hi, np.where(found, k, 0)), -1)

    def predecessor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The largest value of each range that is below x, or -1."""
        k = self.below(lo, hi, x) - 1
        return np.where(k >= 0, self.smallest(lo, hi, np.maximum(k, 0)), -1)


def candidates(ids: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the stretches ids[s:s + d + L] that have the period d, from all levels, by period and start."""
    order, levels = suffix_array(ids, end)
    if not levels:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    tree = WaveletMatrix(order)
    size = np.concatenate([np.full(len(s), length) for length, s, _, _ in levels])
    s, lo, hi = (np.concatenate([level[i] for level in levels]) for i in (1, 2, 3))
    right, left = tree.successor(lo, hi, s + 1), tree.predecessor(lo, hi, s)
    at = np.concatenate((s, left))
    apart = np.concatenate((np.where(right < 0, 0, right - s), np.where(left < 0, 0, s - left)))
    size = np.concatenate((size, size))
    good = (2 * apart >= size) & (apart < size)
    at, apart = at[good], apart[good]
    by = np.lexsort((at, apart))
    return at[by], apart[by]


def _agree(ids: np.ndarray, at: int, apart: int, stop: int) -> int:
    """How far from ``at`` on words equal those ``apart`` further, below ``stop``."""
    step = 16
    while at < stop:
        to = min(at + step, stop)
        other = np.flatnonzero(ids[at:to] != ids[at + apart : to + apart])
        if len(other):
            return at + int(other[0])
        at, step = to, 4 * step
    return stop


def _agree_back(ids: np.ndarray, at: int, apart: int, stop: int) -> int:
    """How far back from ``at`` words equal those ``apart`` further, not before ``stop``."""
    step = 16
    while at > stop:
        to = max(at - step, stop)
        other = np.flatnonzero(ids[to:at] != ids[to + apart : at + apart])
        if len(other):
            return to + int(other[-1]) + 1
        at, step = to, 4 * step
    return stop


def find_runs(w: words.Words) -> np.ndarray:
    """The runs of all texts: rows (start, length, period) with word numbers of the slice, by start and period."""
    ids, n = word_ids(w), w.counts()
    begin, end = np.repeat(w.first[:-1], n), np.repeat(w.first[1:], n)
    runs, last, reach = [], 0, -1
    for s, d in zip(*(x.tolist() for x in candidates(ids, end))):
        if d == last and s < reach:  # inside the stretch before, which has the same period
            continue
        stop = _agree(ids, s, d, int(end[s]) - d)
        start = _agree_back(ids, s, d, int(begin[s]))
        last, reach = d, stop
        if stop + d - start >= max(LEAST, TIMES * d):
            runs.append((start, stop + d - start, d))
    return np.array(sorted(runs), np.int64).reshape(-1, 3)


RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
NEW = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed_text", T.StringType())]


def _detect(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in words.slices(batch.column(len(keep)), words.CASED, SLICE_BYTES):
                runs = find_runs(w)
                edge = np.zeros(len(w.start) + 1, np.int32)
                np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(edge[:-1]) == 0
                at = np.searchsorted(runs[:, 0], w.first)
                base = np.repeat(w.first[:-1], np.diff(at))
                found = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(c, pa.int64()) for c in (runs[:, 0] - base, runs[:, 1], runs[:, 2])], names=["start", "length", "period"]))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(w.counts(), pa.int64()), found,
                                                  words.kept_texts(w, kept).cast(pa.string())],
                                                 names=[*keep, *(f.name for f in NEW)])

    return run


def detect_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with n_words, runs (start, length, period; word numbers from 0, ordered by
    start and period) and collapsed_text: the words joined by one space, without those that any run holds after its
    first period.

    Words are runs of non-white-space, unchanged. A null or empty text has no words, no runs and an empty collapsed
    text. Each repeated row is a document. Input columns named like the new ones are replaced; an empty table gives an
    empty table. A text beyond ``SLICE_BYTES`` is a slice of its own and needs memory for its own suffix array.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in NEW}]
    rows = docs.select(*keep, F.col(text).alias("text" + "_" * max(map(len, keep), default=0)))
    return rows.mapInArrow(_detect(keep), T.StructType([docs.schema[c] for c in keep] + NEW))
