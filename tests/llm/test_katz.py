"""Katz scores against a plain dictionary model, and the edge cases of the contract."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import katz

START, END = "<s>", "</s>"


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [END]


class Plain:
    """The model by its definition: dictionaries of n-gram counts, one recursive function."""

    def __init__(self, texts, order, cutoff=katz.CUTOFF):
        self.order = order
        self.counts = [Counter() for _ in range(order + 1)]
        for t in texts:
            toks = [START] * (order - 1) + tokens_of(t)
            for i in range(order - 1, len(toks)):
                for m in range(1, order + 1):
                    self.counts[m][tuple(toks[i - m + 1 : i + 1])] += 1
        self.d, self.follow = [None], [None]
        for m in range(1, order + 1):
            of = Counter(self.counts[m].values())
            self.d.append(katz.discounts([of[r] for r in range(1, cutoff + 2)], cutoff))
            follow = {}
            for g, c in self.counts[m].items():
                follow.setdefault(g[:-1], {})[g[-1]] = c
            self.follow.append(follow)

    def p(self, m, ctx, w):
        if m == 0:
            return 1.0
        seen = self.follow[m].get(ctx)
        if not seen:
            return self.p(m - 1, ctx[1:], w)
        d = self.d[m]
        total = sum(seen.values())
        off = sum((1 - d[c]) * c for c in seen.values() if c < len(d))
        events = total + (off <= 0)
        if w in seen:
            c = seen[w]
            return (d[c] if c < len(d) else 1.0) * c / events
        left = (off if off > 0 else 1) / events
        if m == 1:
            return left
        return left / (1 - sum(self.p(m - 1, ctx[1:], x) for x in seen)) * self.p(m - 1, ctx[1:], w)

    def score(self, text):
        toks = [START] * (self.order - 1) + tokens_of(text)
        return sum(math.log10(self.p(self.order, tuple(toks[i - self.order + 1 : i]), toks[i])) for i in range(self.order - 1, len(toks)))


ROWS = [(1, "a b a b c", True), (2, "A b d", True), (3, None, True), (4, "", False), (5, "x y a b", False), (6, "a b a b c", False),
        (6, "a b a b c", False), (None, "b c", True), (8, "  a\tb\x0bc  ", True), (9, "c d e f g a a a", None), (10, "é ß É a b", True)]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("hot", [1 << 20, 2])
def test_matches_plain_model(spark, order, hot, monkeypatch):
    monkeypatch.setattr(katz, "HOT", hot)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("length(text) < 900")
    rows = [(r.doc_id, r.text, r.doc_id % 5 != 1) for r in docs.collect()] + ROWS
    df = spark.createDataFrame(rows, "doc_id long, text string, t boolean")
    got = katz.score_corpus(df, F.col("t"), order=order, chunk_bytes=20_000).collect()
    plain = Plain([t for _, t, train in rows if train], order)
    known = Counter(w for _, t, train in rows if train for w in tokens_of(t))
    n, v = sum(known.values()), len(known)
    want = []
    for i, t, train in rows:
        toks = tokens_of(t)
        base = sum(math.log10((known[w] + 0.5) / (n + 0.5 * (v + 1))) for w in toks)
        want.append((i, bool(train), len(toks), sum(known[w] > 0 for w in toks), n, base, plain.score(t)))
    order_of = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted(((r.doc_id, r.train, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=order_of)
    want.sort(key=order_of)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_distributions_sum_to_one(order):
    plain = Plain([t for _, t, train in ROWS if train], order)
    vocabulary = [w for (w,) in plain.counts[1]] + ["an unknown word"]
    for ctx in {g[:-1] for g in plain.counts[order]} | {("q",) * (order - 1)}:
        assert sum(plain.p(order, ctx, w) for w in vocabulary) == pytest.approx(1.0)


def test_empty_and_untrained(spark):
    none = spark.createDataFrame([], "doc_id long, text string, train int")
    assert katz.score_corpus(none, F.lit(True)).count() == 0
    one = katz.score_corpus(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(False)).first()
    assert (one.n_tokens, one.n_known, one.train_tokens, one.score) == (3, 0, 0, 0.0)
