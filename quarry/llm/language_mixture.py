"""Language identification as multilingual mixture inference (operator 6).

Training counts, over all training documents, the hashed byte trigrams of each language (letters and non-ASCII bytes;
everything else is a word boundary). A document is a sequence of units of ``UNIT`` words. Expectation-maximisation
estimates the proportions of the languages that generate its units, from the units' trigram likelihoods. The language
set is chosen by penalised likelihood: languages enter in the order of their proportions as long as each raises the
log likelihood by more than ``PENALTY`` times the logarithm of the number of units; the proportions are then those of
the set. The prediction is the language with the largest proportion, the score that proportion.

The model holds ``FEATURES`` numbers for each language, a size that does not depend on the corpus; documents are
scored where they are read, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import words
from quarry.llm.words import U64

FEATURE_BITS = 15
FEATURES = 1 << FEATURE_BITS
UNIT = 8
ROUNDS = 15
PENALTY = 3.0
SMOOTH = 0.5
SLICE_BYTES = 1 << 19  # bytes of text worked on at once: some ten arrays of 8 bytes for each
LETTERS = words.byte_class(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]), lower=True)


def trigrams(w: words.Words) -> tuple[np.ndarray, np.ndarray]:
    """(positions of word bytes, feature of the trigram around each); neighbours outside the word are a boundary."""
    inside = np.zeros(len(w.data) + 1, np.int8)
    inside[w.start] += 1
    inside[w.end] -= 1
    at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
    left, right = np.full(len(w.data), 32, np.uint8), np.full(len(w.data), 32, np.uint8)
    left[1:], right[:-1] = w.data[:-1], w.data[1:]
    left[w.start], right[w.end - 1] = 32, 32
    code = left[at].astype(U64)
    for other in (w.data, right):
        code <<= U64(8)
        code |= other[at]
    return at, (words.mix(code) >> U64(64 - FEATURE_BITS)).astype(np.int32)


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # log probability by language and feature


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for lo, hi, w in words.slices(batch.column("text"), LETTERS, SLICE_BYTES):
            at, feature = trigrams(w)
            owner = np.searchsorted(w.text, at, side="right") - 1
            names, index = np.unique(langs[lo:hi].astype(str), return_inverse=True)
            counts = np.bincount(index[owner] * FEATURES + feature, minlength=len(names) * FEATURES)
            for i, name in enumerate(names.tolist()):
                part = counts[i * FEATURES : (i + 1) * FEATURES]
                totals[name] = totals[name] + part if name in totals else part
    for name, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())],
                                         names=["lang", "feature", "n"])


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from every row with a language; a null text adds nothing, a language without any letter is not learned."""
    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts = rows.mapInArrow(_count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    counts = counts.toPandas()  # FEATURES rows for each language at most
    langs = sorted(counts["lang"].unique().tolist())
    table = np.full((len(langs), FEATURES), SMOOTH)
    np.add.at(table, (np.searchsorted(langs, counts["lang"].to_numpy(dtype=str)) if langs else [], counts["feature"].to_numpy()), counts["n"].to_numpy())
    return LanguageModel(langs, np.log(table / table.sum(axis=1, keepdims=True)))


def _mixture(like: np.ndarray, first: np.ndarray, owner: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over the units of many documents at once: (proportions, log likelihood) of each. ``like`` holds likelihoods
    scaled to a maximum of 1 in each unit; document d has the units first[d]:first[d + 1], at least one."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    n = np.diff(first)[:, None]
    for step in range(ROUNDS + 1):
        part = like * share[owner]
        total = part.sum(axis=1, keepdims=True)
        if step == ROUNDS:
            break
        share = np.add.reduceat(part / total, first[:-1], axis=0) / n
    return share, np.add.reduceat(np.log(total[:, 0]), first[:-1])


def infer(like: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Proportions of the selected languages, by document; like holds log likelihoods by unit and language."""
    docs, k = len(first) - 1, like.shape[1]
    like = np.exp(np.maximum(like - like.max(axis=1, keepdims=True), -500))
    owner = np.repeat(np.arange(docs), np.diff(first))
    full, _ = _mixture(like, first, owner, np.ones((docs, k)))
    order = np.argsort(-full, axis=1, kind="stable")
    best, best_score = np.zeros((docs, k)), np.full(docs, -np.inf)
    live = np.arange(docs)
    for size in range(1, k + 1):
        allowed = np.zeros((len(live), k))
        np.put_along_axis(allowed, order[live, :size], 1.0, axis=1)
        rows = np.isin(owner, live) if len(live) < docs else slice(None)
        counts = np.diff(first)[live]
        begin = np.concatenate(([0], np.cumsum(counts)))
        share, fit = _mixture(like[rows], begin, np.repeat(np.arange(len(live)), counts), allowed)
        fit = fit - PENALTY * (size - 1) * np.log(counts + 1.0)
        better = fit > best_score[live]
        best[live[better]], best_score[live[better]] = share[better], fit[better]
        live = live[better]
        if not len(live):
            break
    return best


def _predict(sent, keep: list[str], text: int):
    """``text``: the column that holds the text; behind the kept ones (and it) stands whether it has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: LanguageModel = sent.value
        for batch in batches:
            for lo, hi, w in words.slices(batch.column(text), LETTERS, SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                lettered = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
                at, feature = trigrams(w)
                n = w.counts()
                units = -(-n // UNIT)
                owner = np.repeat(np.arange(len(n)), units)
                begin = w.first[:-1][owner] + (np.arange(len(owner)) - np.repeat(np.cumsum(units) - units, units)) * UNIT
                end = np.minimum(begin + UNIT, w.first[1:][owner])
                pred, score, shares = ["und"] * len(n), np.zeros(len(n)), [[] for _ in n]
                known = lettered & (n > 0)
                if model.langs and known.any():
                    used = known[owner]
                    lo_at, hi_at = np.searchsorted(at, w.start[begin[used]]), np.searchsorted(at, w.end[end[used] - 1])
                    like = np.empty((int(used.sum()), len(model.langs)))
                    sums = np.zeros(len(at) + 1)
                    for k, row in enumerate(model.table):
                        np.cumsum(row[feature], out=sums[1:])
                        like[:, k] = sums[hi_at] - sums[lo_at]
                    share = infer(like, np.concatenate(([0], np.cumsum(units[known]))))
                    top = share.argmax(axis=1)
                    for d, t, s in zip(np.flatnonzero(known).tolist(), top.tolist(), share):
                        pred[d], score[d] = model.langs[t], min(1.0, float(s[t]))
                        shares[d] = [{"lang": model.langs[j], "share": float(s[j])} for j in np.flatnonzero(s).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep)], pa.array(pred), pa.array(score),
                     pa.array(shares, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))],
                    names=[*keep, "lang_pred", "score", "languages"])

    return run


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with lang_pred, score and languages (the selected set with proportions).

    A text that is null, empty or has no letter is ``und`` with score 0 and no languages, and so is every text if the
    model learned nothing. Input columns named like the new ones are replaced. Each repeated row is a document.
    """
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
           T.StructField("languages", T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())])))]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in new}]
    own = "text" + "_" * max(map(len, keep), default=0)  # a name that no column has
    sent_text = [] if text in keep else [F.col(text).alias(own)]
    rows = docs.select(*keep, *sent_text, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias(own + "_"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = keep.index(text) if text in keep else len(keep)
    return rows.mapInArrow(_predict(sent, keep, at), T.StructType([docs.schema[c] for c in keep] + new))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
