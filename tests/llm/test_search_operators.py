"""Ranked search, token counts and run detection against brute force and the tokenizer library, with the edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import mask_search, periodic_runs, queries, token_counts, words
from tests.llm.test_text_operators import SPACED, key, lower

SF = "/root/testdata/sf0.001"
TERM = r"[0-9a-z\x80-\U0010FFFF]+"


def ranked(docs, items, top):
    """(item_id, rank, doc_id, score) by the formula of the contract."""
    docs = [(i, Counter(re.findall(TERM, lower(t or "")))) for i, t in docs]
    n, total = sum(1 for _, c in docs if c), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in set(items):
        found = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * n // max(total, 1)
            score = sum(k * weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in Counter(re.findall(TERM, lower(text or ""))).items() if c[t])
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        out += [(item, rank + 1, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=key)


def search_case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["É", "日本", "Mixed", "x-y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i * 7 % 901 - 30, rng.choice(["", "  ", "-!-"]) if rng.random() < 0.05 else " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 50))))
            for i in range(400)]
    docs += [(3000 + i, docs[7][1]) for i in range(30)] + [docs[0], docs[0], (None, docs[7][1]), (4000, None), (4001, "w3 " * 5000)]
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 2, 6, 40, 150])))) for i in range(25)]
    items += [items[3], (3, "w1 w2"), (None, "w5 w5 w9"), (50, None), (51, ""), (52, "nowhere"), (53, "w1 nowhere")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_ranked_search_matches_brute_force(spark, seed):
    docs, items = search_case(seed)
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("id", "score", "rank", "item", "part")})
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit("clash"))
    got = mask_search.search(d.repartition(5), q, top=20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=key) == ranked(docs, items, 20)
    blocks = mask_search.search(d.repartition(3), q, top=3, block_bytes=2000)  # several passes
    assert sorted((tuple(r) for r in blocks.collect()), key=key) == ranked(docs, items, 3)


def test_search_of_empty_tables(spark):
    docs, items = search_case(3)
    empty = spark.createDataFrame([], "doc_id int, text string")
    q = spark.createDataFrame(items, "item_id string, text string")
    assert mask_search.search(empty, q).collect() == []
    assert mask_search.search(spark.createDataFrame(docs[:9], "doc_id long, text string"), q.limit(0)).collect() == []
    assert mask_search.search(spark.createDataFrame([(1, None), (2, " ")], "doc_id int, text string"), q).collect() == []


def test_groups_are_masks_and_skipped_groups_hold_no_result():
    docs, items = search_case(4)
    held = np.array([[1, 0, 1, 0, 1, 1], [0, 0, 1, 0, 1, 0]] + [[0, 0, 1, 0, 1, 0]] * 70, bool)  # more than one word of bits
    at, group, first = mask_search.masks(np.packbits(held, axis=1), 6)
    assert at.tolist() == [0, 2, 4, 5] and len(first) == 2 and group[0] == group[3] != group[1] == group[2]
    model_items = mask_search.Items.compile([t for _, t in items])
    texts, evaluated = pa.array([t for _, t in docs]), 0
    ids = np.arange(len(docs))
    held, n, total = np.zeros(len(model_items.hashes), int), 0, 0
    for _, _, w in mask_search._slices(texts, 1):
        held += np.bincount(model_items.postings(w)[0], minlength=len(held))
        n, total = n + int((w.counts() > 0).sum()), total + len(w.start)
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(k) + 1))) for k in held])
    model = mask_search.Model(model_items, weights, n, total)
    best = [mask_search.Best(5) for _ in items]
    for lo, hi, w in mask_search._slices(texts, 1):
        part = mask_search.Slice(model, w)
        for terms, times, b in zip(model_items.terms, model_items.times, best):
            evaluated += part.search(terms, times, ids[lo:hi], b)
    want = ranked([(i, t) for i, (_, t) in enumerate(docs)], [(k, t) for k, (_, t) in enumerate(items)], 5)
    got = sorted((k, r + 1, int(i), int(s)) for k, b in enumerate(best) for r, (i, s) in enumerate(zip(b.id, b.score)))
    assert got == want
    assert 0 < evaluated < len(docs) * len(items) / 2


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


PIECES = ["'s", "'S", "'re", "'LL", "'d", "'", "''", "a", "B", "1", "23", "!", "<|endoftext|>", "<|EndOfText|>", "<|", " ", "\n", "\x0b", "\x1c", "\x85",
          "\xa0", "é", "É", "H̱", "İ", "ß", "Σ", "日本", "́", "½", "😀", "ſ", "l", "s", "t", "m", "r", "e", "v", "/"]


def token_texts():
    rng = random.Random(8)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 50))) for _ in range(1500)]
    return texts + [None, "", " \n", "'", "it's they'RE ''s '", "ab" * 40000, "word " * 30000, "é" * 5000, "x'", "s y", texts[0], texts[0]]


def test_token_counts_are_those_of_the_library(spark, tokenizer):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    texts = token_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"text_": F.lit("clash"), "n_tokens": F.lit("clash")})
    out = token_counts.count_tokens(docs.repartition(5), tokenizer)
    assert out.columns == ["doc_id", "text", "text_", "n_bytes", "n_tokens"]
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in out.collect()}
    assert got == {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    assert token_counts.count_tokens(docs.limit(0), tokenizer).collect() == []


def test_frequent_units_come_from_all_tasks_by_a_bounded_merge(spark, monkeypatch):
    docs = spark.createDataFrame([(f"common the THE only{i} it's 7",) for i in range(600)], "text string").repartition(9)
    monkeypatch.setattr(token_counts, "FAN_IN", 2)
    units = token_counts.frequent_units(docs)
    assert units[:2] == [b"the", b"7"] and set(units[2:6]) == {b"common", b"only", b"it", b"'s"}
    assert len(units) == len(set(units))


def test_length_table_finds_its_units_and_no_others():
    rng = random.Random(3)
    units = sorted({"".join(rng.choices("abcdefg", k=rng.randint(1, 9))).encode() for _ in range(3000)})
    sizes = [len(u) for u in units]
    table = token_counts.Lengths(units, sizes)
    w = words.words_of(pa.array([" ".join(u.decode() for u in units), "zz 11 héé"]), words.CASED)
    assert table.find(w.hashes()).tolist() == sizes + [-1] * 3
    assert token_counts.Lengths([], []).find(w.hashes()).tolist() == [-1] * (len(units) + 3)


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        token_counts.check_tokenizer(f.read())


def runs_of(ws):
    """All runs, by trying every period."""
    found = {}
    for q in range(1, len(ws) // 4 + 1):
        x = 0
        while x + q < len(ws):
            if ws[x] != ws[x + q]:
                x += 1
                continue
            s = x
            while x + q < len(ws) and ws[x] == ws[x + q]:
                x += 1
            if x + q - s >= max(6, 4 * q):
                found.setdefault((s, x + q - s), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(ws, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(ws) if i not in gone)


def periodic_texts(seed, n=500):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "one", "a " * 6, "a " * 5, "a b " * 4, "x " * 3000, "B b " * 9, "ü ü ü ü ü ü ü z"]
    for _ in range(n):
        k, size = rng.choice([1, 2, 3, 5, 40]), rng.randint(0, 120)
        ws = [f"w{rng.randrange(k)}" for _ in range(size)]
        if rng.random() < 0.6 and size:
            a, p = rng.randrange(size), rng.randint(1, max(1, size // 4))
            ws = [x if i < a else ws[a + (i - a) % p] for i, x in enumerate(ws)]
        if rng.random() < 0.3:
            ws[size // 2 : size // 2] = [rng.choice("ab") for _ in range(rng.randint(1, 9))] * rng.randint(3, 9)
        texts.append(rng.choice([" ", "\n", " \t"]).join(ws))
    return texts + texts[-3:]


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_match_brute_force(spark, seed, monkeypatch):
    texts = periodic_texts(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"runs": F.lit("clash"), "text_": F.lit("clash")})
    out = periodic_runs.detect_runs(docs.repartition(4))
    assert out.columns == ["doc_id", "text", "text_", "n_words", "runs", "collapsed_text"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ws = re.findall(SPACED, texts[r.doc_id] or "")
        want = runs_of(ws)
        assert [tuple(x) for x in r.runs] == want and r.n_words == len(ws)
        assert r.collapsed_text == collapsed(ws, want)
    assert periodic_runs.detect_runs(docs.limit(0)).collect() == []


def test_wavelet_matrix_answers_like_a_scan():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 300):
        values = rng.permutation(n)
        tree = periodic_runs.WaveletMatrix(values)
        lo = rng.integers(0, n, 200)
        hi = lo + 1 + (rng.random(200) * (n - lo)).astype(int)
        x = rng.integers(0, n + 1, 200)
        after = [min((v for v in values[a:b] if v >= c), default=-1) for a, b, c in zip(lo, hi, x)]
        before = [max((v for v in values[a:b] if v < c), default=-1) for a, b, c in zip(lo, hi, x)]
        assert tree.successor(lo, hi, x).tolist() == after
        assert tree.predecessor(lo, hi, x).tolist() == before


def test_suffix_array_is_sorted_and_lists_the_repeated_blocks():
    rng = random.Random(6)
    for _ in range(30):
        lens = [rng.randint(0, 20) for _ in range(4)]
        first = np.concatenate(([0], np.cumsum(lens)))
        ids = np.array([10 * d + rng.randrange(2) for d, n in enumerate(lens) for _ in range(n)], np.int64)
        end = np.repeat(first[1:], lens)
        order, levels = periodic_runs.suffix_array(ids, end)
        suffixes = [tuple(ids[i : end[i]]) for i in order]
        assert suffixes == sorted(suffixes)
        got = {(size, int(s)): sorted(order[a:b].tolist()) for size, ss, lo, hi in levels for s, a, b in zip(ss, lo, hi)}
        want = {}
        for size in (2, 4, 8, 16):
            for s in range(0, len(ids), size):
                block = tuple(ids[s : s + size])
                at = [i for i in range(len(ids)) if i + size <= end[i] and tuple(ids[i : i + size]) == block]
                if len(at) > 1 and s + size <= end[s]:
                    want[size, s] = at
        assert got == want


def test_run_query_repeats_the_tails_as_prescribed(spark):
    """The whole registered query against a plain model, with a null id and an empty text."""
    rows = [(i, " ".join(f"v{(i * j) % 11}" for j in range(i % 70))) for i in range(200)] + [(None, "q " * 7), (10**12, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in queries.with_repeats(docs).collect()}
    changed = 0
    for i, text in rows:
        ws = re.findall(SPACED, text or "")
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and ws:
            g, n = h // 10, len(ws)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [x if k < a else ws[a + (k - a) % p] for k, x in enumerate(ws)]
            changed += 1
        assert re.findall(SPACED, found[i] or "") == ws
    assert changed > 5


def test_run_query_digests(spark):
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in queries.with_repeats(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        ws = re.findall(SPACED, text or "")
        runs, r = runs_of(ws), got[i]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(ws, runs).encode()).hexdigest()
        top = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.start, r.length, r.period) == top and r.exponent_milli == (1000 * top[1] // top[2] if runs else None)
