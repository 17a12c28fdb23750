"""Substring deduplication by counted window hashes (operator 2).

Every window of ``size`` consecutive words has a Rabin-Karp hash, a difference of prefix sums. Documents are cut into
chunks of ascending ids; each chunk sends its distinct window hashes to hash buckets (see ``chunks``), and a bucket
answers with one bit per hash: does a chunk of smaller ids hold it too. Inside a chunk the smallest document of a hash
is known. So a window repeats a smaller document exactly if its bit is set or its document is not the chunk's first
with that hash; overlapping repeated windows merge into maximal removal intervals.

Hashes are 64 bits wide, and wider by whole bytes of a second hash family as the corpus grows, so that the expected
number of equal hashes of different windows in the whole corpus stays below ``MAX_COLLISIONS``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import chunks, words
from quarry.llm.words import U64

SIZE = 13
MAX_COLLISIONS = 1e-3
ANSWER = "chunk int, bucket int, n long, body binary"


def extra_bytes(volume: int) -> int:
    """Bytes beyond 64 bits for a corpus of this many bytes (at most one window for every two)."""
    expected = (volume / 2) ** 2 / 2**65
    return min(8, math.ceil(math.log2(max(1.0, expected / MAX_COLLISIONS)) / 8))


class _Windows:
    """The windows of one chunk in hash order."""

    def __init__(self, docs: pa.Table, size: int, extra: int) -> None:
        ids = docs.column("id").to_numpy(zero_copy_only=False)
        self.order = np.argsort(ids, kind="stable")  # nulls are sent as the smallest id
        ids = ids[self.order]
        self.rows = docs.take(pa.array(self.order))
        self.words = words.words_of(self.rows.column("text"), words.CASED)
        self.begin, self.end = self.words.windows(size)
        rank = np.cumsum(np.concatenate(([0], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
        self.rank = rank[self.words.window_owner(size)]
        h = words.FIRST.spans(self.words.hashes(), self.begin, self.end)
        more = np.zeros(len(h), U64)
        if extra:
            more = words.SECOND.spans(self.words.hashes(words.SECOND), self.begin, self.end) >> U64(64 - 8 * extra)
            self.by = np.lexsort((more, h))
        else:
            self.by = np.argsort(h, kind="stable")
        h, more = h[self.by], more[self.by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (more[1:] != more[:-1])
        self.key = np.cumsum(new) - 1  # index of the distinct hash, in sorted order
        self.hashes, self.more = h[new], more[new]
        self.smallest = self.rank[self.by][new]  # stable sorts keep ascending documents


def _ask(size: int, extra: int, buckets: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        w, chunk = _Windows(docs, size, extra), key[0].as_py()
        bounds = np.searchsorted(chunks.bucket_of(w.hashes, buckets), np.arange(buckets + 1))
        rows = []
        for b in range(buckets):
            lo, hi = bounds[b], bounds[b + 1]
            if hi > lo:
                rows.append((b, chunk, hi - lo, chunks.pack_sorted(w.hashes[lo:hi]),
                             chunks.pack(w.more[lo:hi]) if extra else b""))
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.table({"bucket": pa.array(cols[0], pa.int32()), "chunk": pa.array(cols[1], pa.int32()),
                         "n": pa.array(cols[2], pa.int64()), "body": pa.array(cols[3], pa.binary()),
                         "more": pa.array(cols[4], pa.binary())})

    return run


def _answer(extra: int):
    """Per bucket: for each chunk, the bits of its hashes that a smaller chunk holds too."""

    def run(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("chunk")
        n = asked.column("n").to_numpy()
        bodies, mores = asked.column("body").to_pylist(), asked.column("more").to_pylist()
        h = np.concatenate([chunks.unpack_sorted(b, k) for b, k in zip(bodies, n.tolist())])
        if extra:
            m = np.concatenate([chunks.unpack(b, k, U64) for b, k in zip(mores, n.tolist())])
            by = np.lexsort((m, h))
            again = (h[by][1:] == h[by][:-1]) & (m[by][1:] == m[by][:-1])
        else:
            by = np.argsort(h, kind="stable")
            again = h[by][1:] == h[by][:-1]
        seen = np.zeros(len(h), bool)
        seen[by[1:]] = again  # a stable order: of equal hashes, all but that of the smallest chunk
        cuts = np.concatenate(([0], np.cumsum(n)))
        bits = [np.packbits(seen[cuts[i] : cuts[i + 1]]).tobytes() for i in range(len(n))]
        return pa.table({"chunk": asked.column("chunk"), "bucket": asked.column("bucket"), "n": asked.column("n"),
                         "body": pa.array(bits, pa.binary())})

    return run


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _remove(size: int, extra: int, keep: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        w = _Windows(docs, size, extra)
        answers = answers.sort_by("bucket")
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=k)
                for b, k in zip(answers.column("body").to_pylist(), answers.column("n").to_pylist())]
        seen = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        assert len(seen) == len(w.hashes)
        repeat = np.zeros(len(w.begin), bool)
        repeat[w.by] = seen[w.key] | (w.rank[w.by] > w.smallest[w.key])
        edge = np.zeros(len(w.words.start) + 1, np.int32)
        np.add.at(edge, w.begin[repeat], 1)
        np.add.at(edge, w.end[repeat], -1)
        gone = np.cumsum(edge[:-1]) > 0
        first = w.words.first
        below = np.concatenate(([0], np.cumsum(gone)))
        owner = w.words.owner()
        turn = np.ones(len(gone), bool)
        if len(gone):
            turn[1:] = (gone[1:] != gone[:-1]) | (owner[1:] != owner[:-1])
        starts = np.flatnonzero(turn)
        ends = np.append(starts[1:], len(gone))
        cut = gone[starts]
        starts, ends = starts[cut], ends[cut]
        at = np.searchsorted(starts, first)
        base = np.repeat(first[:-1], np.diff(at))
        spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(starts - base), pa.array(ends - base)], names=["start", "end"])).cast(_SPANS)
        out = {c: w.rows.column(c) for c in keep}
        out |= {"n_words": pa.array(w.words.counts()), "n_removed": pa.array(below[first[1:]] - below[first[:-1]]),
                "removed": spans, "kept_text": words.kept_texts(w.words, ~gone).cast(pa.string())}
        return pa.table(out)

    return run


def chunk_bounds(docs: DataFrame, key: str, n: int) -> list[int]:
    """Ids that cut the documents into n ranges of about equal counts."""
    probs = [i / n for i in range(1, n)]
    cuts = docs.agg(F.percentile_approx(key, probs, 20 * n)).first()[0] if probs else None
    return sorted(set(cuts or []))


def with_chunk(rows: DataFrame, bounds: list[int]) -> DataFrame:
    """The chunk of ascending ids of each row (equal ids share a chunk; ids are compared as doubles, which keeps
    their order)."""
    if not bounds:
        return rows.withColumn("chunk", F.lit(0))
    splits = [-math.inf, *sorted({float(b) for b in bounds}), math.inf]
    cut = Bucketizer(splits=splits, inputCol="order", outputCol="at").transform(rows.withColumn("order", F.col("id").cast("double")))
    return cut.withColumn("chunk", F.col("at").cast("int")).drop("order", "at")


def dedup_substrings(docs: DataFrame, size: int = SIZE, text: str = "text", key: str = "doc_id",
                     chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """Remove from every document each word covered by a ``size``-word window that also starts in a document with a
    smaller id; windows are judged on the input.

    Returns the id (column name ``key``), n_words, n_removed, removed (maximal word spans) and kept_text (kept words
    joined by one space). Words are runs of non-white-space, unchanged. A null or empty text has no words; a null id
    is smaller than any id; rows that share an id are one document for the purpose of "smaller", so a window repeated
    between them stays in both; texts below ``size`` words lose nothing. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    volume = chunks.text_volume(docs, text)
    parts, extra = chunks.parts_for(spark, volume, chunk_bytes), extra_bytes(volume)
    least = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col(key).cast("long"), least).alias("id"), F.col(key).alias("key"), F.col(text).alias("text"))
    bounds = chunk_bounds(rows, "id", parts)
    cut = with_chunk(rows, bounds)
    asked = cut.groupBy("chunk").applyInArrow(_ask(size, extra, parts), chunks.ASK + ", more binary")
    answers = asked.groupBy("bucket").applyInArrow(_answer(extra), ANSWER)
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", SPANS),
                           T.StructField("kept_text", T.StringType())])
    done = cut.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_remove(size, extra, ["key"]), schema)
    return done.withColumnRenamed("key", key)
