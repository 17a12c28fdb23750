"""WARC, language mixture, toxicity, grid order join, packing and components: round trips, brute force, accuracy."""

from collections import Counter
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from quarry.llm import bin_packing, grid_order_join, language_mixture, toxicity_knn, warc, words
from quarry.llm.components import components
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# ---- WARC ------------------------------------------------------------------------------------------------
def pages():
    big, small = "é" * 600 + "\r\n\r\nbody", "tiny"
    rows = [(k, f"http://x.example/{k}?q=a b\r\nX: y", big if k % 3 == 0 else f"<p>{k}</p>" * (k * 20)) for k in range(30)]
    return rows + [(100, None, None), (101, "u", ""), (102, "u", small), (103, "u", small), (27, "again", big), (27, "again", big), (None, "u", big), (5, "v", "x" * 999), (6, "v", "x" * 1000), (7, "v", "x" * 1000)]


def test_warc_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(3)
    root, index = warc.write_archives(df, archive_bytes=500)
    tops = {}
    for i, _, h in rows:
        if h and len(h.encode()) >= 1000 and i is not None:
            tops[h] = max(tops.get(h, i), i)
    want = []
    for i, _, h in rows:
        h = h or ""
        top = tops.get(h)
        revisit = top is not None and (i is None or i < top)
        want.append((i, len(h.encode()), hashlib.sha1(h.encode()).hexdigest(), "revisit" if revisit else "response", top if revisit else None, None if revisit else h))
    order = lambda r: tuple((x is None, x if x is not None else 0) for x in r[:4])
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode()) for r in warc.read_records(index, root).collect()]
    assert sorted(got, key=order) == sorted(want, key=order)
    # a selection reads just its records, and the archives are gzip members that lie end to end
    some = warc.read_records(index.where("page_id = 27"), root).collect()
    assert len(some) == 3 and index.select("archive").distinct().count() > 3
    fs, folder = warc.file_system(root)
    for archive, parts in index.toPandas().groupby("archive"):
        data = fs.open_input_file(f"{folder}/{archive}").read()
        parts = parts.sort_values("offset")
        assert (parts.offset + parts.length).tolist() == [*parts.offset.tolist()[1:], len(data)]
        assert zlib.decompress(data, 31).startswith(b"WARC/1.1\r\n")
    assert isinstance(fs, pafs.FileSystem)


def test_warc_ranges_coalesce():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 50, 10), ("b", 0, 5)]
    assert list(warc.ranges(rows, gap=0)) == [("a", 0, 20, [(0, 10), (10, 10)]), ("a", 50, 10, [(0, 10)]), ("b", 0, 5, [(0, 5)])]
    assert [r[2] for r in warc.ranges(rows, gap=30)] == [60, 5]
    assert [r[2] for r in warc.ranges(rows, gap=30, most=20)] == [20, 10, 5]


def test_warc_empty(spark):
    root, index = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert index.count() == 0 and warc.read_records(index, root).count() == 0


# ---- language mixture ------------------------------------------------------------------------------------
def test_language_held_out_accuracy(spark):
    out = QUERIES["op6_language_mixture"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out.held_out]
    assert len(out) == 1000 and (held.lang == held.lang_pred).mean() > 0.98 and out.score.between(0, 1).all()


def test_language_edges_and_mixtures(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_mixture.train(docs.where("doc_id % 4 <> 2"))
    en, de = (docs.where(f"lang = '{x}' and doc_id % 4 = 2 and n_chars between 3000 and 4000").first().text for x in ("en", "de"))
    rows = [(1, None), (2, ""), (3, "12 34 ..., \n"), (4, "→ ☃"), (5, en + " " + de), (6, en), (6, en), (None, de), (7, en * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("lang", F.lit("zz"))
    got = language_mixture.identify(df, model).collect()
    by = {r.doc_id: r for r in got}
    assert [(by[k].lang_pred, by[k].score, by[k].languages) for k in (1, 2, 3, 4)] == [("und", 0.0, [])] * 4
    assert {x.lang for x in by[5].languages} == {"en", "de"} and 0.3 < by[5].score < 0.7
    assert [(x.lang, x.share) for x in by[6].languages] == [("en", 1.0)] and by[7].lang_pred == "en" and by[None].lang_pred == "de" and len(got) == 9
    nothing = language_mixture.train(docs.where("false"))
    assert {r.lang_pred for r in language_mixture.identify(df, nothing).collect()} == {"und"}
    assert language_mixture.identify(df.where("false"), model).count() == 0


def test_mixture_matches_plain_em():
    rng = np.random.default_rng(0)
    like = rng.normal(0, 2, (40, 3))
    first = np.array([0, 25, 40])
    full, _ = language_mixture._mixture(np.exp(like - like.max(axis=1, keepdims=True)), first, np.repeat([0, 1], [25, 15]), np.ones((2, 3)))
    for d in range(2):
        p, rows = np.ones(3) / 3, np.exp(like[first[d] : first[d + 1]])
        for _ in range(language_mixture.ROUNDS):
            r = rows * p
            p = (r / r.sum(axis=1, keepdims=True)).mean(axis=0)
        assert full[d] == pytest.approx(p)
    assert language_mixture.infer(like, first).sum(axis=1) == pytest.approx([1, 1])


# ---- toxicity --------------------------------------------------------------------------------------------
def test_toxicity_held_out(spark):
    out = QUERIES["op8_toxicity_knn"](spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.predicted == held.toxic).mean() > 0.97 and ((held.score - held.toxic) ** 2).mean() < 0.03 and out.score.between(0, 1).all()


def test_block_max_search_is_exact_and_skips_blocks():
    rng = np.random.default_rng(1)
    terms, n = 400, 900
    toxic = (rng.random(n) < 0.3).astype(int)
    vectors = []
    for i in range(n):  # texts of four topics, some without a term, many copies
        t = np.unique(rng.choice(100, rng.integers(0, 9)) + 100 * (i % 4)) if i % 7 else (vectors[i - 70][0] if i >= 70 else np.zeros(0, int))
        w = rng.random(len(t)) + 0.1 if i % 7 or i < 70 else vectors[i - 70][1]
        vectors.append((t, w / max(np.sqrt((w**2).sum()), 1e-300)))
    ids = rng.permutation(n) + 1000
    index = toxicity_knn.Index(ids, toxic, vectors, terms, block=8, dense=20)
    dense = np.zeros((n, terms))
    for d, (t, w) in enumerate(vectors):
        dense[d, t] = w
    where = {int(i): d for d, i in enumerate(ids)}
    for case in range(80):
        t = np.unique(rng.choice(100, rng.integers(1, 9)) + 100 * (case % 4))
        w = rng.random(len(t)) + 0.1
        w /= np.sqrt((w**2).sum())
        but = int(rng.integers(n)) if case % 2 else None
        every = dense[:, t] @ w
        if but is not None:
            every[where[int(index.ids[but])]] = 0
        for label, (found, product) in zip((1, 0), index.nearest(t, w, 10, but=but)):
            want = np.sort(every[(every > 0) & (toxic == label)])[::-1][:10]
            assert product == pytest.approx(want, abs=1e-6)
            assert every[[where[int(i)] for i in index.ids[found]]] == pytest.approx(want, abs=1e-6)
            assert (toxic[[where[int(i)] for i in index.ids[found]]] == label).all()
    assert index.opened < 0.7 * index.seen


def test_toxicity_edges(spark):
    bad = [(k, "plain words here and a nastyword" + "x" * (k % 4)) for k in range(20)]
    good = [(100 + k, f"plain words here and there {k}") for k in range(60)]
    docs = spark.createDataFrame(bad + good + [(500, None), (501, ""), (502, "NASTYWORDling"), (502, "unknown")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 20)) for k, _ in bad + good] + [(1, None), (None, 1), (500, 1), (3, 0)], "doc_id long, toxic int")
    model = toxicity_knn.train(docs, labels)
    got = toxicity_knn.score(docs.withColumn("evidence", F.lit(1)), model).collect()
    assert len(got) == 84 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {(r.doc_id, r.text): r for r in got}
    assert by[502, "NASTYWORDling"].predicted == 1 and by[502, "NASTYWORDling"].evidence and by[502, "unknown"].predicted == 0
    assert by[500, None].score == by[501, ""].score == by[502, "unknown"].score < 0.3
    empty = toxicity_knn.train(docs, labels.where("false"))
    assert {r.score for r in toxicity_knn.score(docs, empty).collect()} == {0.0}


def test_toxicity_cosine_is_over_all_terms_of_the_examples_and_frequencies_of_all_documents(spark):
    rng = np.random.default_rng(5)
    name = lambda i: "".join(chr(97 + int(c)) for c in np.base_repr(i + 26, 9)) * 3
    texts = [" ".join(name(int(i)) for i in rng.integers(0, 2500, 1200) ** 2 // 2500) for _ in range(30)] + [f"lone{i} {name(0)} {name(i)}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 // 2) for i in range(40)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity_knn.score(docs, toxicity_knn.train(docs, labels, neighbours=7)).collect()}

    def vector(text):
        c = Counter()
        for w in text.split():
            c[w] += 1
            for k in toxicity_knn.PREFIXES:
                if len(w) > k:
                    c[(k, w[:k])] += 1
        return c

    tf = [vector(t) for t in texts]
    df = Counter(k for c in tf for k in c)
    known = {k for c in tf[:40] for k in c}
    unit = []
    for c in tf:
        x = {k: n * (np.log((len(texts) + 1) / (df[k] + 1)) + 1e-9) ** toxicity_knn.IDF_POWER for k, n in c.items() if k in known}
        length = np.sqrt(sum(v * v for v in x.values()))
        unit.append({k: v / length for k, v in x.items()})
    assert len(known) > 2048 and any(k not in known for k in tf[-1])
    for d in (0, 7, 35, 50, 75, 89):
        cosine = [sum(v * unit[e].get(k, 0) for k, v in unit[d].items()) for e in range(40)]
        for label in (0, 1):
            want = sorted((c for e, c in enumerate(cosine) if c > 0 and e % 3 // 2 == label), reverse=True)[:7]
            have = sorted((n.cosine for n in got[d].evidence if n.id % 3 // 2 == label), reverse=True)
            assert have == pytest.approx(want, abs=1e-6)


# ---- grid order join -------------------------------------------------------------------------------------
def vectors(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, 12))
    rows = [(i, (centres[i % 8] + rng.normal(size=12) * 0.15 * (i % 5)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(20)]  # copies
    odd = [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, [1.0, 2.0], [2.0, 4.0], [-0.0] * 12]
    rows += [(2000 + k, v) for k, v in enumerate(odd)]
    return rows + [(None, rows[3][1]), (9, rows[40][1]), (9, rows[9][1]), rows[0]]


@pytest.mark.parametrize("block,leaf", [(8192, 512), (20, 4)])
def test_grid_order_join(spark, block, leaf):
    rows = vectors(3)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("cell", F.lit(2)).repartition(3)
    got = grid_order_join.near_duplicates(df, 0.9, block=block, leaf=leaf).collect()

    def usable(i, v):
        return i is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links, edges = [0] * len(rows), []
    for a, (i, v) in enumerate(rows):
        for b, (j, u) in enumerate(rows):
            if a != b and usable(i, v) and usable(j, u) and len(u) == len(v):
                x, y = np.array(u, float), np.array(v, float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.9:
                    links[a] += 1
                    edges.append((i, j))
    comp = {i: i for i, _ in rows if i is not None}
    changed = True
    while changed:
        changed = False
        for i, j in edges:
            if comp[j] < comp[i]:
                comp[i], changed = comp[j], True
    want = [(i, links[a], comp.get(i), i is not None and comp[i] == i) for a, (i, _) in enumerate(rows)]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_grid_order_join_empty(spark):
    assert grid_order_join.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- components ------------------------------------------------------------------------------------------
def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in want:
        for u, v in edges:
            if u in want and v in want:
                want[u] = want[v] = min(want[u], want[v])
    assert got == want


# ---- packing ---------------------------------------------------------------------------------------------
def plain_best_fit(lengths, capacities, overhead, span):
    """The rule by its definition, over plain lists of bins."""
    bins, left = [], sorted(lengths, reverse=True)

    def per_token(c, n):
        held = n
        for x in left:  # the longest first
            if held + x <= c:
                held += x
        end = min(d for d in capacities if d >= held)
        return (end + overhead + end * end / span) / max(held, 1), c

    for n in sorted(lengths, reverse=True):
        left.remove(n)
        fits = [b for b in bins if b["room"] >= n]
        if fits:
            b = min(fits, key=lambda b: b["room"])
        else:
            c = min((c for c in capacities if c >= n), key=lambda c: per_token(c, n))
            b = {"opened": c, "room": c, "used": 0}
            bins.append(b)
        b["room"], b["used"] = b["room"] - n, b["used"] + n
    return sorted((b["opened"], min(c for c in capacities if c >= b["used"]), b["used"]) for b in bins)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_matches_the_rule(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(3, 1, rng.integers(1, 200)).astype(int), 256)
    bins, opened, sizes = bin_packing.best_fit(lengths, (32, 64, 256), 4, 900)
    used = np.bincount(bins, weights=lengths, minlength=len(sizes)).astype(int)
    assert sorted(zip(opened.tolist(), sizes.tolist(), used.tolist())) == plain_best_fit(lengths.tolist(), (32, 64, 256), 4, 900)


def test_lengths_chosen_jointly_cost_less_than_the_longest_alone():
    rng = np.random.default_rng(4)
    lengths = np.minimum(np.concatenate([rng.lognormal(5.5, 1.2, 6000), rng.integers(1000, 1024, 300), rng.integers(3000, 4096, 80)]).astype(int) + 1, 4096)
    total = {}
    for capacities in (bin_packing.CAPACITIES, (4096,)):  # the one length that cuts no document
        _, opened, sizes = bin_packing.best_fit(lengths, capacities)
        total[capacities] = sum(bin_packing.cost(int(c), bin_packing.OVERHEAD, bin_packing.SPAN) for c in sizes)
    _, opened, _ = bin_packing.best_fit(lengths, bin_packing.CAPACITIES)
    assert set(opened.tolist()) == set(bin_packing.CAPACITIES)  # every length is opened
    assert total[bin_packing.CAPACITIES] < 0.97 * total[4096,]


def test_copies_of_a_row_are_dealt_over_shards(spark):
    rows = [(1, "a b c")] * 5000 + [(k, "x " * (k % 50)) for k in range(3000)]
    out = bin_packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), capacities=(64, 128), shard_docs=1000)
    assert out.count() == 8000 and out.where("doc_id = 1").select("shard").distinct().count() >= 3
    assert out.agg(F.sum("n_tokens")).first()[0] == sum(len(t.split()) + 1 for _, t in rows)


def test_pack_keeps_every_token(spark):
    rows = [(1, "a b c"), (2, None), (3, " \n"), (4, "w " * 1000), (4, "w " * 1000), (None, "x y"), (5, " lead trail\t")] + [(10 + k, "t " * k) for k in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bin", F.lit("clash")).withColumn("shard", F.lit(1.5))
    out = bin_packing.pack(df, capacities=(64, 128, 256), shard_docs=30).toPandas()
    tokens = sum(len((t or "").split()) + 1 for _, t in rows)
    assert out.n_tokens.sum() == tokens and out[out.doc_id == 4].n_tokens.sum() == 2002 and (out.capacity <= 256).all()
    for _, b in out.groupby(["shard", "bin"]):
        b = b.sort_values("offset")
        assert b.offset.tolist() == (b.n_tokens.cumsum() - b.n_tokens).tolist() and b.n_tokens.sum() <= b.capacity.iloc[0]
        assert b.capacity.iloc[0] == min(c for c in (64, 128, 256) if c >= b.n_tokens.sum())
    given = spark.createDataFrame([(1, 5), (2, None), (3, -4), (4, 300)], "doc_id long, n long")
    assert sorted(r.n_tokens for r in bin_packing.pack(given.withColumn("text", F.lit(None).cast("string")), capacities=(256,), n_tokens="n").collect()) == [0, 0, 5, 44, 256]
    assert bin_packing.pack(df.where("false")).count() == 0


def test_letters_are_split_like_words():
    w = words.words_of(pa.array(["Ab1c é", None]), language_mixture.LETTERS)
    assert w.counts().tolist() == [3, 0]
