"""Ranked lexical search by presence-mask grouping (operator 11).

All documents are searched for a stated set of items, in blocks of items. One pass counts documents, terms and the
document frequencies of the items' terms (partial counts in every task). The second pass works a slice of documents at
a time: every item term has a bitmap of the documents that hold it; for each item the bitmaps of its terms, transposed,
give every document's mask of matched terms; equal masks form a group. A group's maximum score is the sum over its
mask of the largest impact that the term has in the slice. Groups are evaluated by descending maximum score until the
next one cannot reach the k-th best score that the task has found so far. Evaluation is exact integer arithmetic, so a
skipped group can hold no result. Each task keeps k documents for each item; Spark merges them in two steps.

Terms are compared by 64-bit hashes; those of the items are checked to differ. With 10**5 item terms and 10**10 different
terms in the corpus, fewer than 0.0001 wrong matches are expected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import chunks, words
from quarry.llm.words import U64

TOP = 20
BLOCK_BYTES = 1 << 19  # text of the items searched in one pass
SLICE_BYTES = 2 << 20
SLICE_DOCS = 1024
CELLS = 1 << 22  # item terms times documents of a slice
FIRST_GROUPS = 32  # documents of the groups evaluated at first
SALTS = 256
NONE = np.iinfo(np.int64).max


@dataclass
class Items:
    """A block of items: the hashes of its terms (ascending), and per item its terms and how often it names each."""

    hashes: np.ndarray
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @staticmethod
    def compile(texts: list[str | None]) -> Items:
        w = words.words_of(pa.array(texts, pa.large_string()), words.ALNUM)
        h, second = w.hashes(), w.hashes(words.SECOND)
        both = np.unique(np.stack([h, second], axis=1), axis=0)
        if len(np.unique(h)) < len(both):
            raise ValueError("two item terms share a hash")
        hashes, term = np.unique(h, return_inverse=True)
        found = [np.unique(term[a:b], return_counts=True) for a, b in zip(w.first[:-1], w.first[1:])]
        return Items(hashes, [t for t, _ in found], [n.astype(np.int64) for _, n in found])

    def postings(self, w: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(term, document, occurrences) of the slice, by term and document."""
        h = w.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), max(len(self.hashes) - 1, 0))
        hit = self.hashes[at] == h if len(self.hashes) else np.zeros(len(h), bool)
        docs = max(len(w.first) - 1, 1)
        pair, tf = np.unique(at[hit] * docs + w.owner()[hit], return_counts=True)
        return pair // docs, pair % docs, tf.astype(np.int64)


def _slices(texts: pa.Array, terms: int) -> Iterator[tuple[int, int, words.Words]]:
    """Slices of bounded bytes and documents, fewer documents if there are many item terms."""
    docs = max(64, min(SLICE_DOCS, CELLS // max(terms, 1)))
    for at in range(0, len(texts), docs):
        for lo, hi, w in words.slices(texts.slice(at, docs), words.ALNUM, SLICE_BYTES):
            yield at + lo, at + hi, w


def _statistics(sent: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = sent.value
        held, n, total = np.zeros(len(items.hashes), np.int64), 0, 0
        for batch in batches:
            for _, _, w in _slices(batch.column(0), len(held)):
                term, _, _ = items.postings(w)
                held += np.bincount(term, minlength=len(held))
                n += int((w.counts() > 0).sum())
                total += len(w.start)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, (-1, -2)), pa.int64()), pa.array(np.append(held[at], (n, total)), pa.int64())],
                                         names=["term", "n"])

    return run


@dataclass
class Model:
    """Items with their term weights, and the corpus size."""

    items: Items
    weights: np.ndarray
    n: int
    total: int


def learn(docs: DataFrame, items: Items, text: str) -> Model:
    """Count over all documents; one number for each item term, and two more."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    counted = docs.select(F.col(text)).mapInArrow(_statistics(sent), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in counted.collect()}
    n = found.get(-1, 0)
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * found.get(t, 0) + 1))) for t in range(len(items.hashes))]
    return Model(items, np.array(weights, np.int64), n, found.get(-2, 0))


def masks(held: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents grouped by their mask. ``held``: one bitmap of documents for each term. Returns (documents with a
    non-empty mask, group of each, first such document of each group); groups are numbered."""
    bits = np.unpackbits(held, axis=1, count=docs)
    rows = np.ascontiguousarray(np.packbits(bits, axis=0).T)  # a mask of terms for each document
    at = np.flatnonzero(rows.any(axis=1))
    wide = np.zeros((len(at), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows[at]
    group = np.zeros(len(at), np.int64)
    for k, part in enumerate(wide.view(U64).T):
        _, index = np.unique(part, return_inverse=True)
        group = index if k == 0 else np.unique(group * (len(at) + 1) + index, return_inverse=True)[1]
    _, first = np.unique(group, return_index=True)
    return at, group, first


class Best:
    """The k best (score, document) of one item so far: higher scores first, then smaller ids, null before any."""

    def __init__(self, k: int) -> None:
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bar(self) -> int:
        """A score that a document needs at least."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        use = score >= self.bar()
        score, ids = np.concatenate((self.score, score[use])), np.concatenate((self.id, ids[use]))
        by = np.lexsort((ids, -score))[: self.k]
        self.score, self.id = score[by], ids[by]


class Slice:
    """The impacts and bitmaps of the item terms in one slice of documents."""

    def __init__(self, model: Model, w: words.Words) -> None:
        self.docs = len(w.first) - 1
        term, doc, tf = model.items.postings(w)
        n = w.counts().astype(np.int64)
        m = 75 + 25 * n * model.n // max(model.total, 1)
        impact = model.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
        self.terms, row = np.unique(term, return_inverse=True)
        self.impact = np.zeros((len(self.terms), self.docs), np.int64)
        self.impact[row, doc] = impact
        held = np.zeros((len(self.terms), self.docs), bool)
        held[row, doc] = True
        self.held = np.packbits(held, axis=1)
        self.most = self.impact.max(axis=1, initial=0)

    def search(self, terms: np.ndarray, times: np.ndarray, ids: np.ndarray, best: Best) -> int:
        """Add the slice's documents for one item; returns how many were evaluated."""
        row = np.searchsorted(self.terms, terms)
        there = row < len(self.terms)
        there[there] = self.terms[row[there]] == terms[there]
        row, times = row[there], times[there]
        if not len(row) or int((times * self.most[row]).sum()) < best.bar():
            return 0
        docs, group, first = masks(self.held[row], self.docs)
        present = np.unpackbits(self.held[row], axis=1, count=self.docs)[:, docs[first]]
        most = (times * self.most[row]) @ present.astype(np.int64)  # of each group
        order = np.argsort(-most, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by = np.argsort(place[group], kind="stable")  # documents by descending maximum of their group
        bound = most[order][place[group][by]]
        at, step = 0, FIRST_GROUPS
        while at < len(by):
            reach = int(np.searchsorted(-bound, -best.bar(), side="right"))  # groups below the bar are finished
            to = min(at + step, reach)
            if to < reach:
                to = int(np.searchsorted(-bound, -bound[to - 1], side="right"))  # whole groups
            if to <= at:
                break
            chosen = docs[by[at:to]]
            best.add(times @ self.impact[row[:, None], chosen], ids[chosen])
            at, step = to, 2 * step
        return at


FOUND = "item int, part int, doc_id long, score long"


def _search(sent: Broadcast, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        best = [Best(top) for _ in model.items.terms]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, w in _slices(batch.column(1), len(model.weights)):
                part = Slice(model, w)
                for terms, times, b in zip(model.items.terms, model.items.times, best):
                    part.search(terms, times, ids[lo:hi], b)
        item = np.repeat(np.arange(len(best)), [len(b.id) for b in best])
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), pa.array(np.full(len(item), TaskContext.get().partitionId() % SALTS), pa.int32()),
                 pa.array(np.concatenate([b.id for b in best]), pa.int64()), pa.array(np.concatenate([b.score for b in best]), pa.int64())],
                names=["item", "part", "doc_id", "score"])

    return run


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, text: str = "text", key: str = "doc_id", item: str = "item_id",
           item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents of every item: item_id (column name ``item``), rank, doc_id (column name ``key``), score.

    Terms are runs of digits, letters and non-ASCII characters, A-Z lower-cased. A null or empty document has no term
    and is not counted; an item without terms, or whose terms no document holds, has no rows. Equal rows of the queries
    are one item; rows that share an id but not a text are ranked each on its own; a null item id is an item. Equal
    scores are ordered by id, a null id first; each repeated document is ranked. Empty tables give an empty table.
    """
    spark = docs.sparkSession
    least = F.lit(-(1 << 63)).cast("long")
    rows = docs.select(F.coalesce(F.col(key).cast("long"), least).alias("id"), F.col(text).alias("text"))
    pool = queries.select(F.col(item).alias("id"), F.col(item_text).alias("text"))
    blocks = max(1, -(-chunks.text_volume(pool) // block_bytes))
    out = None
    for b in range(blocks):
        chosen = pool.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct().collect()  # about block_bytes
        items = Items.compile([r.text for r in chosen])
        model = learn(rows, items, "text")
        found = rows.mapInArrow(_search(spark.sparkContext.broadcast(model), top), FOUND)
        for by in (["item", "part"], ["item"]):
            ranked = Window.partitionBy(*by).orderBy(F.desc("score"), "doc_id")
            found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(i, r.id) for i, r in enumerate(chosen)],
                                      T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", pool.schema["id"].dataType)]))
        named = found.join(names, "item").select(F.col("item_id").alias(item), "rank", F.nullif("doc_id", least).cast(docs.schema[key].dataType).alias(key), "score")
        out = named if out is None else out.unionByName(named)
    return out
