"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 3).

The patterns are all ``size``-word windows of the test items (an item of fewer words, but not none, is one pattern).
For patterns of one length L the search slides an L-word frame over the text. The last two words in the frame form a
block; the shift table says how far the frame can move because no pattern holds that block nearer to its end. Where
the shift is zero, the block selects the bucket of patterns that end with it, the frame's hash picks the pattern in
the bucket, and the words themselves are compared before an occurrence counts. Many frames move at once: each text is
cut into lanes of frame positions, and one numpy step advances all lanes.

The test set is searched in blocks of bounded bytes, one pass over the documents for each block, and only the
compiled tables of one block are sent to the executors. A pass adds to the spans and items found before it, and
passes are separated by a written table, so memory never holds two blocks. Documents are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import chunks, words
from quarry.llm.words import U64

BLOCK_BYTES = 4 << 20  # test text per search block
SLICE_BYTES = 1 << 20  # bytes of documents searched at once
SLOT_BITS = 18
LANE = 512
_C = U64(0xD6E8FEB86659FD93)


def _slot(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (words.mix(left * _C + right) >> U64(64 - SLOT_BITS)).astype(np.int64)


@dataclass
class Searcher:
    """Shift table and suffix buckets of the patterns of one length."""

    length: int
    shift: np.ndarray
    keys: np.ndarray  # suffix slot and frame hash of each pattern in one number, sorted
    texts: list[bytes]
    items: list[list[str]]

    @classmethod
    def compile(cls, length: int, patterns: dict[bytes, tuple[np.ndarray, set[str]]]) -> Searcher:
        rows = np.array([h for h, _ in patterns.values()], dtype=U64).reshape(len(patterns), length)
        block = min(2, length)
        shift = np.full(1 << SLOT_BITS, length - block + 1, np.int64)
        for q in range(length - block, -1, -1):
            np.minimum.at(shift, _slot(rows[:, q], rows[:, q + block - 1]), length - block - q)
        key = cls._key(rows)
        order = np.argsort(key, kind="stable")
        texts, items = list(patterns), [sorted(ids) for _, ids in patterns.values()]
        return cls(length, shift, key[order], [texts[i] for i in order], [items[i] for i in order])

    @staticmethod
    def _key(frames: np.ndarray) -> np.ndarray:
        """Suffix slot above a hash of the whole frame: sorted keys are the buckets, each sorted by frame hash."""
        total = np.zeros(len(frames), U64)
        for q in range(frames.shape[1]):
            total = total * U64(words.FIRST.mult) + frames[:, q]
        block = min(2, frames.shape[1])
        slot = _slot(frames[:, -block], frames[:, -1]).astype(U64)
        return (slot << U64(64 - SLOT_BITS)) | (words.mix(total) >> U64(SLOT_BITS))

    def find(self, w: words.Words, h: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence."""
        length, block = self.length, min(2, self.length)
        frames = np.maximum(w.counts() - length + 1, 0)
        lanes = -(-frames // LANE)
        text = np.repeat(np.arange(len(lanes)), lanes)
        at = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        pos = w.first[:-1][text] + at * LANE
        end = np.minimum(pos + LANE, (w.first[:-1] + frames)[text])
        found = []
        while len(pos):
            tail = pos + length - 1
            step = self.shift[_slot(h[tail - block + 1], h[tail])]
            found.append(pos[step == 0])
            pos = pos + np.maximum(step, 1)
            live = pos < end
            pos, end = pos[live], end[live]
        pos = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        if not len(pos):
            return
        key = self._key(h[pos[:, None] + np.arange(length)])
        lo, hi = np.searchsorted(self.keys, key, side="left"), np.searchsorted(self.keys, key, side="right")
        hit = hi > lo
        data = w.data.tobytes()
        for p, a, b in zip(pos[hit].tolist(), lo[hit].tolist(), hi[hit].tolist()):
            for i in range(a, b):
                if self._same(w, data, p, self.texts[i]):
                    yield p, i

    def _same(self, w: words.Words, data: bytes, p: int, pattern: bytes) -> bool:
        last = p + self.length
        if data[w.start[p] : w.end[last - 1]] == pattern:
            return True
        return b" ".join(data[s:e] for s, e in zip(w.start[p:last].tolist(), w.end[p:last].tolist())) == pattern


@dataclass
class Block:
    """The compiled patterns of one block of test items, by pattern length."""

    searchers: list[Searcher] = field(default_factory=list)

    @classmethod
    def compile(cls, items: list[tuple[str, str | None]], size: int) -> Block:
        w = words.words_of(pa.array([t for _, t in items], pa.large_string()), words.ALNUM)
        h, data = w.hashes(), w.data.tobytes()
        groups: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = {}
        begin, end = w.windows(size, short=True)
        for b, e, owner in zip(begin.tolist(), end.tolist(), w.window_owner(size, short=True).tolist()):
            text = b" ".join(data[s:t] for s, t in zip(w.start[b:e].tolist(), w.end[b:e].tolist()))
            groups.setdefault(e - b, {}).setdefault(text, (h[b:e], set()))[1].add(items[owner][0])
        return cls([Searcher.compile(n, g) for n, g in sorted(groups.items())])

    def search(self, w: words.Words) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """Per text, the word spans of all occurrences and the items they belong to."""
        h, n = w.hashes(), len(w.first) - 1
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        items: list[set[str]] = [set() for _ in range(n)]
        for s in self.searchers:
            for p, i in s.find(w, h):
                d = int(np.searchsorted(w.first, p, side="right")) - 1
                spans[d].append((p - int(w.first[d]), p - int(w.first[d]) + s.length))
                items[d].update(s.items[i])
        return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as maximal ones."""
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


HITS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", HITS),
         T.StructField("items", T.ArrayType(T.StringType()))]
_HITS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pass(sent, text: str, keep: list[str]):
    """The mapInArrow function of one pass; columns hits and items, if there, hold what earlier passes found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = sent.value
        for batch in batches:
            for lo, hi, w in words.slices(batch.column(text), words.ALNUM, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                spans, items = block.search(w)
                if "hits" in part.schema.names:
                    for s, i, old, ids in zip(spans, items, part.column("hits").to_pylist(), part.column("items").to_pylist()):
                        s.extend((x["start"], x["end"]) for x in old)
                        i.update(ids)
                spans = [merged(s) for s in spans]
                new = [pa.array(w.counts(), pa.int64()), pa.array([sum(e - b for b, e in s) for s in spans], pa.int64()),
                       pa.array([[{"start": b, "end": e} for b, e in s] for s in spans], _HITS),
                       pa.array([sorted(i) for i in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], names=[*keep, *(f.name for f in FOUND)])

    return run


def find_benchmark(docs: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", item: str = "item_id",
                   item_text: str = "text", keep: list[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Occurrences of benchmark windows in every document.

    Returns the columns ``keep`` (default: all) of the documents and n_words, n_hit (words inside any occurrence),
    hits (maximal word spans) and items (ids, as sorted strings, of the items with an occurrence); input columns of
    these four names are replaced. Words are runs of digits, letters and non-ASCII characters, A-Z lower-cased.
    A null or empty text has no words and no hits; an item without words is no pattern; a null item id reads "null";
    repeated items count once for each id; each repeated document is a row. Empty tables give no hits or no rows.
    """
    names = {f.name for f in FOUND}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    source = docs.select(*dict.fromkeys([*keep, text]))
    pool = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("id"), F.col(item_text).alias("text"))
    blocks = max(1, -(-chunks.text_volume(pool) // block_bytes))
    for b in range(blocks):
        rows = pool.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct().collect()  # about block_bytes
        sent = docs.sparkSession.sparkContext.broadcast(Block.compile([(r.id, r.text) for r in rows], size))
        last = b == blocks - 1
        out = keep if last else [f.name for f in source.schema if f.name not in names]
        schema = T.StructType([source.schema[c] for c in out] + FOUND)
        source = source.mapInArrow(_pass(sent, text, out), schema)
        if not last:
            source = chunks.store(source, "decontaminate")
    return source
