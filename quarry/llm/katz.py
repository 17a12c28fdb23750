"""Katz backoff language model, trained and evaluated over a whole corpus (operator 1).

An n-gram of order m is a context (the m - 1 tokens before, padded with a start mark) and a token. For each order,
every chunk of documents sends its distinct n-grams with their training counts to buckets of contexts (see
``chunks``); a bucket adds the counts up and answers with the total of each n-gram asked about and the statistics of
each context: its total, the number of its n-grams with each small count, and the sum of the lower-order probabilities
of the tokens seen after it. The answers of each order are tables in the shared folder, partitioned by order. From
them a chunk evaluates its tokens recursively:

    P(w | context) = d(c) c / total            if the n-gram has training count c > 0
                   = alpha(context) P(w | shorter context)   otherwise, alpha = 1 for a context never seen

d(c) are Good-Turing discounts for counts up to ``cutoff``, from the counts of counts of that order over the whole
corpus. alpha is the mass that the discounts leave, divided by the lower-order probability of all tokens not seen after
the context; every distribution thus sums to one. A context whose discounts leave nothing counts one event more. The
lowest order gives its left-over mass to one class of unknown tokens.

A context with ``HOT`` training tokens or more is dealt over all buckets by its tokens, and its statistics are added
up by the chunks, so no bucket depends on the frequency of one word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import chunks, words
from quarry.llm.words import U64
from quarry.session import scratch_path

ORDER, CUTOFF, HOT = 2, 5, 1 << 20
START, END = U64(0x0123456789ABCDEF), U64(0xFEDCBA9876543210)
_C = U64(0x9FB21C651E98DF25)
ASKED = "bucket int, chunk int, n long, k long, ctx binary, per binary, word binary, cnt binary, low binary, lows binary"
ANSWER = "order int, chunk int, bucket int, n long, k long, body binary, total binary, mass binary, hist binary, stat array<long>"


@dataclass
class OrderStats:
    """What a whole order of n-grams yields: its discounts, and for the lowest order tokens and types."""

    tokens: int
    types: int
    discount: np.ndarray  # by count up to the cutoff; index 0 unused
    small: np.ndarray  # types with each count up to the cutoff


def discounts(counts_of_counts: list[int], cutoff: int) -> np.ndarray:
    """Katz's Good-Turing discounts for counts 1..cutoff, with the largest cutoff for which all of them lie in (0, 1);
    where none does (tiny corpora), half an event is taken off each count up to the cutoff."""
    n = [0, *counts_of_counts]
    for k in range(cutoff, 0, -1):
        if all(n[r] > 0 for r in range(1, k + 1)) and (k + 1) * n[k + 1] < n[1]:
            rest = (k + 1) * n[k + 1] / n[1]
            d = [((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return np.array([1.0, *d] + [1.0] * (cutoff - k))
    return np.array([1.0, *(1 - 0.5 / r for r in range(1, cutoff + 1))])


@dataclass
class Plan:
    """Numbers every task needs: buckets, training documents, bytes dropped from token hashes inside a context, and the
    statistics of the orders counted so far."""

    buckets: int
    starts: int
    drop: int
    stats: list[OrderStats]


def hash_bytes_dropped(volume: int) -> int:
    """Inside one context a token needs fewer than 64 bits to be told apart; the larger the corpus, the more."""
    return 2 if volume < 1 << 36 else 1 if volume < 1 << 44 else 0


def unigram(s: OrderStats, total: np.ndarray) -> np.ndarray:
    """Probability of tokens with these training counts; count 0 is the class of unknown tokens."""
    cutoff = len(s.small)
    off = float(sum((1 - s.discount[r]) * r * s.small[r - 1] for r in range(1, cutoff + 1)))
    events = max(s.tokens + (off <= 0), 1)
    return np.where(total > 0, _discounted(s, total) / events, (off if off > 0 else 1) / events)


def _discounted(s: OrderStats, total: np.ndarray) -> np.ndarray:
    d = np.ones(len(total))
    small = total < len(s.discount)
    d[small] = s.discount[total[small].astype(np.int64)]
    return d * total


class _Tokens:
    """The token stream of one chunk: the words of each text, then one end."""

    def __init__(self, docs: pa.Table) -> None:
        w = words.words_of(docs.column("text"), words.FOLDED)
        n = len(w.first) - 1
        self.first = w.first + np.arange(n + 1)
        self.token = np.empty(len(w.start) + n, U64)
        ends = self.first[1:] - 1
        mask = np.ones(len(self.token), bool)
        mask[ends] = False
        self.token[mask], self.token[ends] = w.hashes(), END
        self.head = self.first[:-1]  # first token of each text
        self.train = np.repeat(docs.column("train").to_numpy(zero_copy_only=False).astype(bool), np.diff(self.first))

    def before(self, values: np.ndarray, start: int | float | np.generic) -> np.ndarray:
        """The value of the token before each token; start at the head of a text."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.head] = start
        return out

    def grams(self, order: int) -> tuple[np.ndarray, np.generic]:
        """Hash of the ``order`` tokens up to each token, and that of a start-only sequence."""
        g, s = self.token, START
        for _ in range(order - 1):
            g, s = words.mix(self.before(g, s) * _C + self.token), words.mix(np.array([s], U64) * _C + START)[0]
        return g, s


class _Grams:
    """The distinct n-grams of one order in one chunk, by bucket, context and token."""

    def __init__(self, t: _Tokens, order: int, plan: Plan, held: np.ndarray | None) -> None:
        buckets, starts = plan.buckets, plan.starts
        word = t.token if order == 1 else t.token >> U64(8 * plan.drop) << U64(8 * plan.drop)
        if order == 1:
            ctx = np.zeros(len(word), U64)
            bucket = chunks.bucket_of(word, buckets)
            self.hot = np.zeros(0, U64)
        else:
            grams, start = t.grams(order - 1)
            ctx = t.before(grams, start)
            hot = t.before(held, starts) >= HOT
            bucket = np.where(hot, chunks.bucket_of(words.mix(ctx ^ word), buckets), chunks.bucket_of(ctx, buckets))
            self.hot = np.unique(ctx[hot])
        by = np.lexsort((word, ctx, bucket)) if order > 1 else np.argsort(word, kind="stable")
        b, c, w = bucket[by], ctx[by], word[by]
        new = np.ones(len(by), bool)
        new[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1]) | (b[1:] != b[:-1])
        self.inverse = np.empty(len(by), np.int64)
        self.inverse[by] = np.cumsum(new) - 1
        self.where = by[new]  # a token position of each n-gram
        self.bucket, self.ctx, self.word = b[new], c[new], w[new]
        self.count = np.bincount(self.inverse, weights=t.train, minlength=int(new.sum())).astype(U64)
        self.buckets = buckets

    def blocks(self):
        """(bucket, slice of n-grams, contexts asked about, index of each n-gram's context) for every bucket asked. Hot contexts
        are asked about in every bucket, for their statistics."""
        cuts = np.searchsorted(self.bucket, np.arange(self.buckets + 1))
        for b in range(self.buckets):
            part = slice(int(cuts[b]), int(cuts[b + 1]))
            ctx = np.union1d(self.ctx[part], self.hot)
            if len(ctx):
                yield b, part, ctx, np.searchsorted(ctx, self.ctx[part])


def _ask(order: int, plan: Plan):
    def rows(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table | None) -> pa.Table:
        t = _Tokens(docs)
        low = held = None
        if answers is not None:
            low, held, known = _evaluate(t, answers, order - 1, plan)
            low = known if order == 2 else low.view(U64)  # the counts that order 1 derives its probabilities from
        g = _Grams(t, order, plan, held)
        out = []
        for b, part, ctx, index in g.blocks():
            values, which = (np.zeros(0, U64), np.zeros(0, U64)) if low is None else np.unique(low[g.where[part]], return_inverse=True)
            out.append({"bucket": b, "chunk": key[0].as_py(), "n": part.stop - part.start, "k": len(ctx),
                        "ctx": chunks.pack_sorted(ctx), "per": chunks.pack(np.bincount(index, minlength=len(ctx)).astype(np.uint32)),
                        "word": chunks.pack_sorted(g.word[part]) if order == 1 else chunks.pack(g.word[part]),
                        "cnt": chunks.pack(g.count[part]), "low": chunks.pack(which.astype(np.uint32)), "lows": pack_table(values)})
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 6
        names = ["bucket", "chunk", "n", "k", "ctx", "per", "word", "cnt", "low", "lows"]
        return pa.Table.from_pylist(out, schema=pa.schema(list(zip(names, types))))

    def alone(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        return rows(key, docs, None)

    def informed(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        return rows(key, docs, answers)

    return alone if order == 1 else informed


def pack_table(values: np.ndarray) -> bytes:
    return len(values).to_bytes(4, "little") + chunks.pack_sorted(values)


def unpack_table(body: bytes) -> np.ndarray:
    return chunks.unpack_sorted(body[4:], int.from_bytes(body[:4], "little"))


def _answer(order: int, cutoff: int, plan: Plan):
    """Per bucket: totals of the n-grams and statistics of the contexts, aligned with each chunk's question."""

    def run(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
        a = asked.to_pydict()
        ctxs = [chunks.unpack_sorted(x, k) for x, k in zip(a["ctx"], a["k"])]
        word = np.concatenate([(chunks.unpack_sorted(x, n) if order == 1 else chunks.unpack(x, n, U64)) for x, n in zip(a["word"], a["n"])])
        cnt = np.concatenate([chunks.unpack(x, n, U64) for x, n in zip(a["cnt"], a["n"])])
        names, place = np.unique(np.concatenate(ctxs), return_inverse=True)
        kcuts, ncuts = np.cumsum([0, *a["k"]]), np.cumsum([0, *a["n"]])
        ctx = np.concatenate([np.repeat(place[kcuts[i] : kcuts[i + 1]], chunks.unpack(x, k, np.uint32)) for i, (x, k) in enumerate(zip(a["per"], a["k"]))])
        low = np.concatenate([unpack_table(v)[chunks.unpack(x, n, np.uint32)] if order > 1 else np.zeros(n, U64) for x, v, n in zip(a["low"], a["lows"], a["n"])])
        low = unigram(plan.stats[0], low) if order == 2 else low.view(np.float64)
        by = np.lexsort((word, ctx))
        new = np.ones(len(by), bool)
        new[1:] = (word[by][1:] != word[by][:-1]) | (ctx[by][1:] != ctx[by][:-1])
        gram = np.empty(len(by), np.int64)
        gram[by] = np.cumsum(new) - 1
        first = by[new]
        total = np.add.reduceat(cnt[by], np.flatnonzero(new)) if len(by) else cnt
        seen = total > 0
        at, m = ctx[first], len(names)
        ctx_total = np.bincount(at, weights=total, minlength=m).astype(U64)
        mass = np.bincount(at[seen], weights=low[first][seen], minlength=m)
        hist = np.zeros((cutoff, m), np.uint32)
        for r in range(1, cutoff + 1):
            hist[r - 1] = np.bincount(at[total == r], minlength=m)
        stat = [int(total.sum()), int(seen.sum()), *(int((total == r).sum()) for r in range(1, cutoff + 2))]
        rows = []
        for i, chunk in enumerate(a["chunk"]):
            p = place[kcuts[i] : kcuts[i + 1]]
            rows.append({"order": order, "chunk": chunk, "bucket": key[0].as_py(), "n": a["n"][i], "k": a["k"][i],
                         "body": chunks.pack(total[gram[ncuts[i] : ncuts[i + 1]]])}
                        | ({"total": chunks.pack(ctx_total[p]), "mass": chunks.pack(mass[p].view(U64)),
                            "hist": chunks.pack(np.ascontiguousarray(hist[:, p]).ravel())} if order > 1 else {}))
        rows.append({"order": order, "chunk": -1, "bucket": key[0].as_py(), "stat": stat})
        schema = pa.schema([("order", pa.int32()), ("chunk", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64()), ("k", pa.int64()),
                            *((c, pa.binary()) for c in ("body", "total", "mass", "hist")), ("stat", pa.list_(pa.int64()))])
        return pa.Table.from_pylist(rows, schema=schema)

    return run


def _evaluate(t: _Tokens, answers: pa.Table, order: int, plan: Plan):
    """(probability, total of the n-gram of that order, total of the single token) of every token."""
    prob = held = known = np.zeros(0)
    for m in range(1, order + 1):
        s, g = plan.stats[m - 1], _Grams(t, m, plan, held)
        cutoff = len(s.discount) - 1
        mine = {x["bucket"]: x for x in answers.filter(pc.equal(answers.column("order"), m)).to_pylist()}
        total, names = np.zeros(len(g.word), U64), np.unique(g.ctx)
        sums = np.zeros((cutoff + 2, len(names)))  # total, lower-order mass, counts of counts
        for b, part, ctx, _ in g.blocks():
            x = mine[b]
            total[part] = chunks.unpack(x["body"], x["n"], U64)
            if m > 1:
                at = np.searchsorted(names, ctx)
                sums[0, at] += chunks.unpack(x["total"], x["k"], U64)
                sums[1, at] += chunks.unpack(x["mass"], x["k"], U64).view(np.float64)
                sums[2:, at] += chunks.unpack(x["hist"], cutoff * x["k"], np.uint32).reshape(cutoff, -1)
        if m == 1:
            held = known = total[g.inverse]
            prob = unigram(s, total)[g.inverse]
            continue
        c = sums[0]
        off = sum((1 - s.discount[r]) * r * sums[1 + r] for r in range(1, cutoff + 1))
        events = np.maximum(c + (off <= 0), 1)
        alpha = np.where(c > 0, np.where(off > 0, off, 1) / events / np.maximum(1 - sums[1], 1e-300), 1.0)
        at = np.searchsorted(names, g.ctx)
        lower = prob[g.where]
        p = np.where(total > 0, _discounted(s, total) / events[at], alpha[at] * lower)
        prob, held = p[g.inverse], total[g.inverse]
    return prob, held, known


def _score(order: int, plan: Plan):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        t = _Tokens(docs)
        prob, _, known = _evaluate(t, answers, order, plan)
        n, v = plan.stats[0].tokens, plan.stats[0].types
        base = np.log10((known.astype(np.float64) + 0.5) / (n + 0.5 * (v + 1)))
        add = lambda x: np.add.reduceat(x, t.head) if len(t.head) else x  # noqa: E731  no text is without tokens
        return pa.table({"key": docs.column("key"), "train": docs.column("train"), "n_tokens": pa.array(np.diff(t.first)),
                         "n_known": pa.array(add((known > 0).astype(np.int64))), "base_score": pa.array(add(base)),
                         "score": pa.array(add(np.log10(prob)))})

    return run


def score_corpus(docs: DataFrame, train: Column, order: int = ORDER, cutoff: int = CUTOFF, text: str = "text",
                 key: str = "doc_id", chunk_bytes: int = chunks.CHUNK_BYTES) -> DataFrame:
    """Train on the rows where ``train`` holds and score every row.

    Returns the id (column ``key``), train, n_tokens, n_known (tokens that occur in training), train_tokens,
    base_score (additive unigram) and score (log10 probability of the tokens, the end included). Words are runs of
    non-white-space with A-Z lower-cased; a null or empty text is its end alone; a null id is kept; a null ``train``
    is false; each repeated row counts. Without training rows all tokens are one unknown class of probability 1.
    Scoring other texts than the training ones: pass the union with ``train`` false for them.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    volume, starts = rows.agg(F.sum(F.octet_length("text")), F.count(F.when(F.col("train"), 1))).first()
    parts = chunks.parts_for(spark, volume or 0, chunk_bytes)
    cut = rows.withColumn("chunk", F.pmod(F.xxhash64("key", "text"), F.lit(parts)).cast("int"))
    root, stats = scratch_path(spark, "katz"), []
    plan = Plan(parts, starts, hash_bytes_dropped(volume or 0), stats)
    for m in range(1, order + 1):
        fn = _ask(m, plan)
        asked = (cut.groupBy("chunk").applyInArrow(fn, ASKED) if m == 1 else
                 cut.groupBy("chunk").cogroup(_read(spark, root).groupBy("chunk")).applyInArrow(fn, ASKED))
        chunks.write(asked.groupBy("bucket").applyInArrow(_answer(m, cutoff, plan), ANSWER), f"{root}/order={m}")
        found = _read(spark, root, stats=True).where(F.col("order") == m).select(F.posexplode("stat").alias("pos", "x"))
        sums = {r.pos: r.x for r in found.groupBy("pos").agg(F.sum("x").alias("x")).collect()}  # cutoff + 3 rows
        of = [sums.get(2 + r, 0) for r in range(cutoff + 1)]
        stats.append(OrderStats(sums.get(0, 0), sums.get(1, 0), discounts(of, cutoff), np.array(of[:cutoff], float)))
    schema = cut.select("key", "train").schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")
    done = cut.groupBy("chunk").cogroup(_read(spark, root).groupBy("chunk")).applyInArrow(_score(order, plan), schema)
    return done.withColumn("train_tokens", F.lit(stats[0].tokens).cast("long")).withColumnRenamed("key", key)


def _read(spark, root: str, stats: bool = False) -> DataFrame:
    return spark.read.schema(ANSWER).parquet(root).where(F.col("chunk") < 0 if stats else F.col("chunk") >= 0)
