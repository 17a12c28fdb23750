"""Toxicity by the nearest labelled examples under exact TF-IDF cosine in a block-max index (operator 8).

Terms are words and word beginnings of 4 and 6 bytes, so that inflected or compounded forms of one stem meet. The space has
every term of the examples; a vector's weights are tf * idf**IDF_POWER, with document frequencies counted over all
documents. Examples are labelled documents, a sample drawn by id hash whose bounds are parameters (``max_examples`` texts of
``max_bytes`` together); every document is scored.

The index is an inverted one over blocks of ``BLOCK`` similar examples of one label. A term's list names the blocks that
hold it, the largest weight in each, and its postings there. For a document, the maxima give every block a bound that no
example in it exceeds. The blocks of the largest bounds are opened first, then those whose bound reaches the k-th best
cosine found, for each label on its own; the others cannot change the k nearest and their postings are not read. The
``DENSE`` most frequent terms, whose lists would name every block, are a matrix: their exact products are part of the bound.

The k nearest examples of each label vote with their cosines, i.e. by distance. The votes of the nearest 1, 2, 3, 5, ... of
each label, as logarithms of their mean cosine, go through a logistic curve fitted on the examples without themselves; that
gives a calibrated score. A document without any term of the examples gets the toxic rate of the examples without any. The
evidence is the neighbours' ids with their cosines.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import chunks, words
from quarry.llm.words import U64

MAX_EXAMPLES, MAX_BYTES = 2_000, 64 << 20
NEIGHBOURS = 50
NEAREST = (1, 2, 3, 5, 10, 25, 50)  # whose mean cosine is a vote
IDF_POWER = 1.5
BLOCK, DENSE = 32, 512
BATCH = 64  # texts whose products over the frequent terms are computed together
ROUNDING = 1e-9  # sums are in double precision; the weights in the lists have single precision
PREFIXES = (4, 6)
SLICE_BYTES = 1 << 20


def word_terms(w: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """(index of each word's form, hashes of the terms of each form: the word and its beginnings; 0 where it has none)."""
    distinct, where, inverse = np.unique(w.hashes(), return_index=True, return_inverse=True)
    by = np.argsort(where)  # spans are hashed in the order of the text
    start, end = w.start[where[by]], w.end[where[by]]
    out = np.zeros((len(distinct), 1 + len(PREFIXES)), U64)
    out[:, 0] = distinct
    for j, k in enumerate(PREFIXES):
        long = end - start > k
        out[by[long], j + 1] = words.mix(words.FIRST.spans(w.data, start[long], start[long] + k, words.FIRST.table) + U64(k))
    return inverse, out


def _keys(w: words.Words, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text * len(names) + term, occurrences) of every word form of every text, for each of its terms that ``names``
    (sorted) holds; a text may have a key several times."""
    form, terms = word_terms(w)
    forms, size = max(len(terms), 1), max(len(names), 1)
    if not len(names) or not len(terms):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(names, terms), len(names) - 1)
    index = np.where((names[at] == terms) & (terms != 0), at, -1)
    token = w.owner() * forms + form
    token = np.sort(token[(index >= 0).any(axis=1)[form]])
    first = np.flatnonzero(np.diff(token, prepend=-1))
    count, token = np.diff(np.append(first, len(token))), token[first]
    of = index[token % forms]
    some = of >= 0
    return ((token // forms * size)[:, None] + of)[some], np.broadcast_to(count[:, None], of.shape)[some]


def cells(w: words.Words, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, frequency in the text), by text and term; terms as indices into the sorted ``names``."""
    key, count = _keys(w, names)
    by = np.argsort(key)
    key, count = key[by], count[by]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[first]
    return key // max(len(names), 1), key % max(len(names), 1), np.add.reduceat(count, first) if len(first) else count


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The term hashes of each slice of texts."""
    for batch in batches:
        for _, _, w in words.slices(batch.column(0), words.ALNUM, SLICE_BYTES):
            found = np.unique(word_terms(w)[1])
            yield pa.RecordBatch.from_arrays([pa.array(found[found != 0].view(np.int64))], names=["term"])


def _frequencies(sent: Broadcast):
    """Per task: documents that hold each known term, and all documents (term -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, n = sent.value, 0
        df = np.zeros(len(names), np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, _, w in words.slices(batch.column(0), words.ALNUM, SLICE_BYTES):
                key = np.sort(_keys(w, names)[0])
                df += np.bincount(key[np.diff(key, prepend=-1) > 0] % max(len(names), 1), minlength=len(names))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(df[at], n), pa.int64())], names=["term", "df"])

    return run


def _vectors(sent: Broadcast):
    """The terms of the examples and their frequencies, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, w in words.slices(batch.column("text"), words.ALNUM, SLICE_BYTES):
                text, term, tf = cells(w, sent.value)
                at = np.searchsorted(text, np.arange(hi - lo + 1))
                rows = [(chunks.pack(np.diff(term[i:j], prepend=0).astype(np.int32)), chunks.pack(tf[i:j].astype(np.uint32))) for i, j in zip(at[:-1], at[1:])]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("toxic"), pa.array(np.diff(at), pa.int32()),
                                                  pa.array([a for a, _ in rows], pa.binary()), pa.array([b for _, b in rows], pa.binary())],
                                                 names=["id", "toxic", "n", "terms", "tf"])

    return run


def unit(idf: np.ndarray, at: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
    """Weights of unit length for the vectors term[at[i]:at[i + 1]]."""
    weight = tf * idf[term]
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    length = np.sqrt(np.bincount(owner, weights=weight**2, minlength=len(at) - 1))
    return weight / np.maximum(length, 1e-300)[owner]


def similar_order(dense: np.ndarray, rows: np.ndarray, size: int) -> list[np.ndarray]:
    """``rows`` in blocks of at most ``size``, cut again and again along their leading direction."""
    if len(rows) <= size:
        return [rows] if len(rows) else []
    x = dense[rows] - dense[rows].mean(axis=0)
    place = np.where(np.arange(len(rows)) % 2, 1.0, -1.0)
    for _ in range(8):
        axis = x.T @ place
        place = x @ (axis / (np.linalg.norm(axis) + 1e-12))
    rows = rows[np.argsort(place, kind="stable")]
    half = min(len(rows) - 1, max(size, -(-len(rows) // (2 * size)) * size))
    return similar_order(dense, rows[:half], size) + similar_order(dense, rows[half:], size)


class Index:
    """The block-max index. ``vectors``: (terms ascending, weights) of each example."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK, dense: int = DENSE) -> None:
        n = len(ids)
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *(x for _, x in vectors)])
        owner = np.repeat(np.arange(n), [len(t) for t, _ in vectors])
        held = np.bincount(term, minlength=terms)
        top = np.argsort(-held, kind="stable")[: min(dense, terms)]
        self.column = np.full(terms, -1, np.int32)
        self.column[top] = np.arange(len(top))
        matrix = np.zeros((n, len(top)))
        col = self.column[term]
        matrix[owner[col >= 0], col[col >= 0]] = weight[col >= 0]
        blocks = [b for label in (1, 0) for b in similar_order(matrix, np.flatnonzero(toxic == label), block)]
        order = np.concatenate([np.zeros(0, np.int64), *blocks]).astype(np.int64)
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.toxic, self.matrix = ids[order], toxic[order], matrix[order]
        self.begin = np.cumsum([0, *map(len, blocks)])
        toxic_blocks = sum(1 for b in blocks if toxic[b[0]] == 1)
        self.cut_block, self.cut_example = toxic_blocks, int(self.begin[toxic_blocks])  # where the other label begins
        self.of = of = np.repeat(np.arange(len(blocks)), np.diff(self.begin))  # block of each example
        rare = col < 0
        term, example, weight = term[rare], place[owner[rare]], weight[rare]
        by = np.lexsort((example, term))
        term, self.example, self.weight = term[by], example[by].astype(np.int32), weight[by].astype(np.float32).astype(float)
        self.weight32 = None
        entry = np.ones(len(term), bool)
        entry[1:] = (term[1:] != term[:-1]) | (of[example[by]][1:] != of[example[by]][:-1])
        self.first = np.append(np.flatnonzero(entry), len(term)).astype(np.int32)  # postings of each entry
        self.block = of[example[by][entry]].astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, self.first[:-1]) if len(term) else np.zeros(0, np.float32)
        self.cut = np.searchsorted(term[entry], np.arange(terms + 1)).astype(np.int32)
        self.opened = self.seen = 0  # blocks, over all searches

    def common(self, at: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Products of the texts at[i]:at[i + 1] with all examples over the frequent terms."""
        col, owner = self.column[term], np.repeat(np.arange(len(at) - 1), np.diff(at))
        q = np.zeros((len(at) - 1, self.matrix.shape[1]))
        q[owner[col >= 0], col[col >= 0]] = weight[col >= 0]
        return q @ self.matrix.T

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, common: np.ndarray | None = None, but: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each label (1, 0): the places and products of its k examples with the largest positive product, of equal
        ones those with the smallest ids; without the example at place ``but``. ``common``: the text's row of ``common``."""
        score = self.common(np.array([0, len(term)]), term, weight)[0] if common is None else common.copy()
        n, blocks = len(self.ids), len(self.begin) - 1
        rare = self.column[term] < 0
        term, weight = term[rare], weight[rare]
        lo = self.cut[term]
        size = self.cut[term + 1] - lo
        entry = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        x, block = np.repeat(weight, size), self.block[entry]
        # a block's bound: the best product over the frequent terms, and the maxima of the others
        bound = np.maximum.reduceat(score, self.begin[:-1]) + np.bincount(block, weights=self.most[entry] * x, minlength=blocks)
        done, bars = np.zeros(blocks, bool), None
        few = -(-k // BLOCK) + 1
        sides = (slice(0, self.cut_block), slice(self.cut_block, blocks))
        for last in (False, True):
            now = np.zeros(blocks, bool)
            for i, side in enumerate(sides):
                if last:
                    now[side] = ~done[side] & (bound[side] >= bars[i] - ROUNDING)
                else:
                    now[side.start + np.argsort(-bound[side], kind="stable")[:few]] = True
            now &= bound > 0
            if last and not now.any():
                break
            use = np.flatnonzero(now[block])
            at, count = self.first[entry[use]], self.first[entry[use] + 1] - self.first[entry[use]]
            posting = np.repeat(at - np.cumsum(count) + count, count) + np.arange(count.sum())
            score += np.bincount(self.example[posting], weights=self.weight[posting] * np.repeat(x[use], count), minlength=n)
            done |= now
            if but is not None:
                score[but] = 0.0
            opened = np.where(done[self.of], score, 0.0)
            bars = [self._bar(part, k) for part in (opened[: self.cut_example], opened[self.cut_example :])]
        self.opened, self.seen = self.opened + int(done.sum()), self.seen + blocks
        out = []
        for first, part, bar in ((0, opened[: self.cut_example], bars[0]), (self.cut_example, opened[self.cut_example :], bars[1])):
            at = first + np.flatnonzero((part > 0) & (part >= bar - ROUNDING))
            product = np.round(opened[at], 12)
            by = np.lexsort((self.ids[at], -product))[:k]
            out.append((at[by], product[by]))
        return out

    @staticmethod
    def _bar(score: np.ndarray, k: int) -> float:
        """The k-th best product, or 0."""
        return max(0.0, float(np.partition(score, len(score) - k)[len(score) - k])) if len(score) >= k else 0.0


@dataclass
class Model:
    names: np.ndarray  # sorted term hashes
    idf: np.ndarray
    index: Index
    base: float  # toxic rate of all examples
    blank: float  # toxic rate of the examples without any term
    neighbours: int
    curve: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # centre, spread, weights of the votes
    sent: Broadcast | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"sent": None}


def votes(found: list[tuple[np.ndarray, np.ndarray]], k: int) -> np.ndarray:
    """Logarithms of the mean cosines of the nearest 1, 2, 3, ... examples of each label (absent ones count as 0)."""
    sums = [np.concatenate(([0.0], np.cumsum(p))) for _, p in found]
    return np.array([np.log(s[min(m, len(s) - 1)] / m + 1e-3) for m in NEAREST if m <= k for s in sums])


def _learn(sent: Broadcast):
    """The votes on each example by the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        k = model.neighbours
        place = {int(i): p for p, i in enumerate(model.index.ids.tolist())}
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                term = np.cumsum(chunks.unpack(r["terms"], r["n"], np.int32), dtype=np.int64)
                weight = unit(model.idf, np.array([0, r["n"]]), term, chunks.unpack(r["tf"], r["n"], np.uint32).astype(float))
                out.append(votes(model.index.nearest(term, weight, k, but=place[r["nth"]]), k).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(out, pa.list_(pa.float64()))], names=["toxic", "votes"])

    return run


def fit(x: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic curve over standardised votes, with a small ridge on the weights."""
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.column_stack([(x - centre) / spread, np.ones(len(x))])
    ridge, out = np.diag([1e-2] * (x.shape[1] - 1) + [1e-6]), np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (toxic - p) - ridge @ out)
        out = out + step / max(1.0, float(np.abs(step).max()))
    return centre, spread, out


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", max_examples: int = MAX_EXAMPLES,
          max_bytes: int = MAX_BYTES, neighbours: int = NEIGHBOURS) -> Model:
    """Fit on the documents with a label (any label row of an id that says 1 makes it toxic; null ids, labels and texts
    are left out; rows that share an id are examples each). About ``max_examples`` texts, of about ``max_bytes`` together,
    are drawn by id hash; what is sent to tasks and to the driver grows with them alone."""
    spark = docs.sparkSession
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).alias("toxic"))
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("text is not null")
    n, size = texts.select("id", F.octet_length("text").alias("size")).join(marked, "id").agg(F.count("*"), F.sum("size")).first()
    share = min(1.0, max_examples / max(n, 1), max_bytes / max(size or 0, 1))
    drawn = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))  # about max_examples rows
    pairs = chunks.store(texts.join(F.broadcast(drawn), "id").select("id", "text", F.col("toxic").cast("int").alias("toxic")), "toxic-examples")
    found = pairs.select("text").mapInArrow(_terms, "term long").distinct().toArrow()  # the terms of the examples
    names = np.sort(found.column("term").to_numpy().view(U64))
    known = spark.sparkContext.broadcast(names)
    counted = texts.select("text").mapInArrow(_frequencies(known), "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    term, df = counted.column("term").to_numpy(), counted.column("df").to_numpy()
    total, held = int(df[term < 0].sum()), np.zeros(len(names))
    held[term[term >= 0]] = df[term >= 0]
    idf = (np.log((total + 1) / (held + 1)) + 1e-9) ** IDF_POWER
    rows = pairs.mapInArrow(_vectors(known), "id long, toxic int, n int, terms binary, tf binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["id"], r["terms"], r["tf"]))
    toxic = np.array([r["toxic"] for r in rows], np.int64)
    some = np.array([r["n"] > 0 for r in rows], bool)
    base, none = float(toxic.mean()) if len(rows) else 0.0, toxic[~some]
    rows = [r for r in rows if r["n"]]
    vectors = []
    for r in rows:
        t = np.cumsum(chunks.unpack(r["terms"], r["n"], np.int32), dtype=np.int64)
        vectors.append((t, unit(idf, np.array([0, len(t)]), t, chunks.unpack(r["tf"], r["n"], np.uint32).astype(float))))
    # places are named by the order of the rows while the curve is fitted: ids may repeat
    index = Index(np.arange(len(rows)), toxic[some], vectors, len(names))
    model = Model(names, idf, index, base, float((none.sum() + base) / (len(none) + 1)), neighbours)
    if 0 < base < 1 and rows:
        sent = spark.sparkContext.broadcast(model)
        parts = 2 * spark.sparkContext.defaultParallelism
        asked = spark.createDataFrame([(i, r["toxic"], r["n"], r["terms"], r["tf"]) for i, r in enumerate(rows)], "nth int, toxic int, n int, terms binary, tf binary")
        learnt = asked.repartition(parts, "nth").mapInArrow(_learn(sent), "toxic int, votes array<double>").toArrow()
        model.curve = fit(np.array(learnt.column("votes").to_pylist()), learnt.column("toxic").to_numpy())
    index.ids = np.array([r["id"] for r in rows], np.int64)[index.ids] if rows else np.zeros(0, np.int64)
    model.sent = spark.sparkContext.broadcast(model)
    return model


EVIDENCE = T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("cosine", T.DoubleType())]))
_EVIDENCE = pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64())]))


def _search(sent: Broadcast, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = sent.value
        k = model.neighbours
        for batch in batches:
            for lo, hi, w in words.slices(batch.column(len(keep)), words.ALNUM, SLICE_BYTES):
                text, term, tf = cells(w, model.names)
                at = np.searchsorted(text, np.arange(hi - lo + 1))
                weight = unit(model.idf, at, term, tf)
                evidence, score, common = [], np.full(hi - lo, model.blank), None
                for d, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                    if d % BATCH == 0 and len(model.index.ids):
                        group = at[d : d + BATCH + 1]
                        common = model.index.common(group - group[0], term[group[0] : group[-1]], weight[group[0] : group[-1]])
                    found = model.index.nearest(term[i:j], weight[i:j], k, common[d % BATCH]) if j > i and len(model.index.ids) else []
                    evidence.append([{"id": a, "cosine": c} for p, x in found for a, c in zip(model.index.ids[p].tolist(), np.minimum(x, 1.0).tolist())])
                    if evidence[-1]:
                        score[d] = model.base
                        if model.curve is not None:
                            centre, spread, weights = model.curve
                            x = float(np.append((votes(found, k) - centre) / spread, 1.0) @ weights)
                            score[d] = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32()),
                                                  pa.array(evidence, _EVIDENCE)], names=[*keep, "score", "predicted", "evidence"])

    return run


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with score (0 to 1), predicted (1 from 0.5) and evidence (nearest examples of
    each label, with their cosines).

    A null or empty text has no terms. Input columns named like the new ones are replaced; each repeated row is
    scored. Without examples every score is 0.
    """
    new = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", EVIDENCE)]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in new}]
    rows = docs.select(*keep, F.col(text).alias("text" + "_" * max(map(len, keep), default=0)))
    return rows.mapInArrow(_search(model.sent, keep), T.StructType([docs.schema[c] for c in keep] + new))
