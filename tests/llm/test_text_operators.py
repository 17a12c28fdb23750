"""Substring dedup, decontamination, Jaccard join and line dedup against brute force, with the edge cases."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.llm import line_runs, prefix_tree_join, substring_dedup, words, wu_manber

SPACED = r"[^\x20\x09-\x0D]+"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def corpus(seed, n=60):
    """Random documents with shared passages, near copies, empty and null texts, odd white space and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["aa", "B", "c", "dé", "ß", "F9", "g", "Ünder", "x|y", "z.", "日本", "k"]
    passages = [" ".join(rng.choices(vocabulary, k=rng.randint(5, 40))) for _ in range(5)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(vocabulary, k=rng.randint(1, 30))))
        rows.append((i * 3 - 20, rng.choice([" ", "\n", "\t\n ", "\x0b"]).join(parts)))
    base = " ".join(f"w{k}" for k in range(80))
    for k in range(8):  # a chain of near copies
        rows.append((1000 + k, " ".join(f"w{j + k * 4}" for j in range(80))))
    rows += [(2000, base + " extra"), (2001, base.upper()), (500, None), (501, ""), (502, " \n "), (503, "one"), (504, "One"), (505, "two three")]
    rows += [rows[0], rows[0], (rows[1][0], "another text of the same id " * 5), (None, base), (None, "only here " * 9)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    """The rows with columns whose names clash with the operators' own."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit("clash") for c in ("hits", "items", "n_words", "chunk", "id", "key", "n_lines", "a", "rep")}).repartition(4)


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def test_words_split_as_the_character_class_does():
    import pyarrow as pa

    texts = [None, "", " a b\tC\x1fd\x0be ", "日本 語", "x" * 70000, "q", "a-b_c9É"]
    for table, pattern, fold in ((words.CASED, SPACED, str), (words.FOLDED, SPACED, lower), (words.ALNUM, r"[0-9a-z\x80-\U0010FFFF]+", lower)):
        got = []
        for lo, hi, w in words.slices(pa.array(texts), table, limit=8):
            data = w.data.tobytes()
            for d in range(hi - lo):
                got.append([data[w.start[i] : w.end[i]].decode() for i in range(w.first[d], w.first[d + 1])])
        assert got == [re.findall(pattern, fold(t or "")) for t in texts]


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup(spark, seed):
    rows = corpus(seed)
    got = substring_dedup.dedup_substrings(frame(spark, rows), size=7, chunk_bytes=300).collect()
    least, docs = {}, [(i, re.findall(SPACED, t or "")) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - 6):
            least[tuple(w[k : k + 7])] = min(least.get(tuple(w[k : k + 7]), (2, 0)), ((i is not None), i or 0))
    want = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - 6):
            if least[tuple(w[k : k + 7])] < ((i is not None), i or 0):
                gone.update(range(k, k + 7))
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_substring_hash_width_follows_the_corpus():
    assert substring_dedup.extra_bytes(10**6) == 0 < substring_dedup.extra_bytes(3 * 10**10) < substring_dedup.extra_bytes(10**14) <= 8


def test_wider_hashes_give_the_same_result(spark, monkeypatch):
    df = frame(spark, corpus(5))
    plain = sorted(substring_dedup.dedup_substrings(df, size=7).collect(), key=key_of_row)
    monkeypatch.setattr(substring_dedup, "extra_bytes", lambda volume: 3)
    assert sorted(substring_dedup.dedup_substrings(df, size=7, chunk_bytes=500).collect(), key=key_of_row) == plain


def key_of_row(r):
    return key((r[0], r[1], r[2])) + (str(r[4]),)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, seed, block_bytes):
    rows = corpus(seed)
    rng = random.Random(seed)
    texts = [t for _, t in rows if t]
    items = [(k, rng.choice(texts)[rng.randint(0, 30) :][:150]) for k in range(12)] + [(100, "one"), (101, "two, THREE"), (102, None), (103, "..."), (None, "aa b"), (2, "c g")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = wu_manber.find_benchmark(frame(spark, rows), bench, size=4, block_bytes=block_bytes).collect()
    word = r"[0-9a-z\x80-\U0010FFFF]+"
    patterns = {}
    for i, t in items:
        w = re.findall(word, lower(t or ""))
        for k in range(max(1, len(w) - 3) if w else 0):
            patterns.setdefault(tuple(w[k : k + 4]), set()).add("null" if i is None else str(i))
    want = []
    for i, t in rows:
        w, hit, ids = re.findall(word, lower(t or "")), set(), set()
        for n in range(1, 5):
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in patterns:
                    hit.update(range(k, k + n))
                    ids |= patterns[tuple(w[k : k + n])]
        want.append((i, len(w), len(hit), sorted(ids)))
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=lambda r: key(r[:3]) + (r[3],)) == sorted(want, key=lambda r: key(r[:3]) + (r[3],))
    assert all(sum(s.end - s.start for s in r.hits) == r.n_hit for r in got) and {"chunk", "rep", "text"} <= set(got[0].asDict())


def components_by_brute_force(rows):
    sets = []
    for i, t in rows:
        w = re.findall(SPACED, lower(t or ""))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, a) in enumerate(sets):
        for y, (j, b) in enumerate(sets[:x]):
            if i is not None and j is not None and (i == j and a and b or 100 * len(a & b) >= 75 * len(a | b) > 0):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, a) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    named = {a: least[find(x)] for x, (i, a) in enumerate(sets) if i is not None}
    return [(i, len(a), (named.get(a) if a else i) if i is None else (least[find(x)] if a else i)) for x, (i, a) in enumerate(sets)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("piece_tokens", [1 << 20, 100])
def test_jaccard_join(spark, seed, piece_tokens):
    rows = corpus(seed)
    rng = random.Random(seed)
    words_ = [f"t{k}" for k in range(60)]
    for k in range(40):  # a large group of near copies
        w = list(words_)
        w[rng.randint(0, 59)] = f"new{k}"
        w[rng.randint(0, 59)] = f"other{k % 7}"
        rows.append((3000 + k, " ".join(w)))
    got = prefix_tree_join.jaccard_components(frame(spark, rows), chunk_bytes=1000, piece_tokens=piece_tokens).collect()
    assert sorted(map(tuple, got), key=key) == sorted(components_by_brute_force(rows), key=key)


@pytest.mark.parametrize("seed", range(3))
def test_trie_finds_the_components_of_random_sets(seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    for _ in range(30):
        base = [rng.choice(40, rng.integers(3, 30), replace=False) for _ in range(4)]
        sets = []
        for _ in range(25):
            s = set(base[rng.integers(4)].tolist())
            for _ in range(rng.integers(0, 5)):
                s ^= {int(rng.integers(60))}
            sets.append(s or {1})
        forest = prefix_tree_join.link([np.array(sorted(s), np.uint64) for s in sets], [len(s) for s in sets], list(range(25)))
        plain = prefix_tree_join.Forest(25)
        for i in range(25):
            for j in range(i):
                if 175 * len(sets[i] & sets[j]) >= 75 * (len(sets[i]) + len(sets[j])):
                    plain.join(i, j)
        assert [forest.find(i) for i in range(25)] == [plain.find(i) for i in range(25)]


@pytest.mark.parametrize("batches,fanout", [(1, 4), (5, 2)])
def test_line_dedup(spark, batches, fanout):
    rows = corpus(1) + [(k, f"Same line\n\n \x0bsame LINE \nown {k}\n") for k in range(-3, 6)] + [(77, "\n\n"), (78, "own 3")]
    got = line_runs.dedup_lines(frame(spark, rows), min_docs=3, batches=batches, fanout=fanout).collect()
    strip = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    held = Counter(k for _, t in rows for k in {strip(x) for x in (t or "").split("\n")})
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not strip(x) or held[strip(x)] < 3]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got), key=key) == sorted(want, key=key)


def test_line_runs_are_compacted(spark):
    runs = line_runs.LineRuns(spark, min_docs=2, fanout=2)
    for k in range(4):
        runs.add(line_runs.count_hashes(spark.createDataFrame([(f"line {k}\ncommon",)], "text string")))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert {tuple(r) for r in runs.frequent().collect()} == {tuple(spark.sql("select 'common' k").select(line_runs.line_hash(F.col("k")).alias("h")).select("h.*").first())}


def test_line_runs_are_joined_without_an_exchange(spark):
    runs = line_runs.LineRuns(spark, min_docs=2, fanout=4, buckets=3)
    for k in range(3):
        runs.add(line_runs.count_hashes(spark.createDataFrame([(f"line {k}\ncommon {k % 2}",)], "text string")))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    tables = [r for level in runs.levels for r in level]
    assert len(tables) == 3 and runs._merged(tables).groupBy("n").count().count() == 2  # 2 of one line, 1 of the others
    joined = plan(runs.unsettled(spark.table(tables[0])))
    assert joined.count("SortMergeJoin") == 3 and "Exchange" not in joined
    assert runs.frequent().count() == 1


def test_registered_line_dedup_builds_levels(spark, monkeypatch):
    made = []
    compacted = line_runs.LineRuns.frequent
    monkeypatch.setattr(line_runs.LineRuns, "frequent", lambda self: made.append((self.compactions, [len(x) for x in self.levels])) or compacted(self))
    docs = spark.createDataFrame([(k, f"line {k}\ncommon") for k in range(40)], "doc_id long, text string")
    assert line_runs.dedup_lines(docs).where("n_dropped = 1").count() == 40
    assert made == [(1, [1, 1])]  # one level above the batches


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_words string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.dedup_substrings(docs).count() == 0
    assert wu_manber.find_benchmark(docs, none).count() == 0
    assert wu_manber.find_benchmark(some, none).first().n_hit == 0
    assert prefix_tree_join.jaccard_components(docs).count() == 0
    assert line_runs.dedup_lines(docs).count() == 0
