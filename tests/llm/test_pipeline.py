"""The pipeline's stages against brute force over a whole small table, and its contract."""

import math
import re
from collections import Counter

import corpus_pipeline
from tests.llm.test_text_operators import components_by_brute_force, lower

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "s", None), (9002, "123 ... 4", "en", "s", 9), (9003, "", None, None, 0)], docs.schema)
    docs = docs.unionByName(extra)
    rows = {r.doc_id: r.asDict() for r in docs.collect()}
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
        outputs.append(docs)
    # language: what has no letter goes
    rows = {i: r for i, r in rows.items() if re.search(r"[^\W\d_]", r["text"] or "")}
    assert {r.doc_id for r in outputs[0].collect()} == set(rows)
    # lines
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    held = Counter(k for r in rows.values() for k in {key(x) for x in r["text"].split("\n")})
    for r in rows.values():
        r["text"] = "\n".join(x for x in r["text"].split("\n") if not key(x) or held[key(x)] < 10)
        r["n_chars"] = len(r["text"])
    assert {r.doc_id: r.asDict() for r in outputs[1].collect()} == rows
    # near duplicates
    comp = components_by_brute_force([(i, r["text"]) for i, r in rows.items()])
    rows = {i: rows[i] for i, _, c in comp if i == c}
    assert {r.doc_id: r.asDict() for r in outputs[2].collect()} == rows
    # benchmark
    word = r"[0-9a-z\x80-\U0010FFFF]+"
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = re.findall(word, lower(r.text))
        grams |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))}
    sizes = {len(g) for g in grams}
    clean = {}
    for i, r in rows.items():
        w = re.findall(word, lower(r["text"]))
        if not any(tuple(w[k : k + n]) in grams for n in sizes for k in range(len(w) - n + 1)):
            clean[i] = r
    assert {r.doc_id: r.asDict() for r in outputs[3].collect()} == clean and len(clean) < len(rows)
    # packing: all tokens of all documents, in bins that hold them
    bins = outputs[4].toPandas()
    want = {i: len(r["text"].split()) + 1 for i, r in clean.items()}
    assert bins.groupby("doc_id").n_tokens.sum().to_dict() == want
    assert (bins.groupby(["shard", "bin"]).n_tokens.sum() <= bins.groupby(["shard", "bin"]).capacity.first()).all()
    assert len(bins) == sum(math.ceil(n / 4096) for n in want.values())


def test_all_but_the_last_stage_return_document_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 30")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]


def test_run_and_empty_documents(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_one_row_of_each_group_stays(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(5, base, "en", "s", 1)] * 4 + [(5, base + " more", "en", "s", 1), (7, base + " x", "en", "s", 1)]  # one component, smallest id 5
    rows += [(None, base, "en", "s", 1)] * 3 + [(None, "alone " * 9, None, None, None)] * 4 + [(None, "other words here", "en", "s", 2)]
    rows += [(9, "nothing shared by this one", "en", "s", 3), (11, "", None, None, 0), (12, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()]
    assert sorted((r[0] for r in out), key=lambda x: (x is None, x)) == [5, 9, 11, 12, None, None]
    assert {r[1] for r in out if r[0] is None} == {"alone " * 9, "other words here"}
    assert all(r in rows for r in out)
    assert corpus_pipeline.one_of_each_group(spark, docs.limit(0), SF).collect() == []


def test_without_any_language_only_texts_without_a_letter_go(spark):
    rows = [(i, f"some words of text {i}", None, "s", 9) for i in range(10)] + [(20, "12 34", None, "s", 5), (21, None, None, "s", 0)]
    out = corpus_pipeline.known_language(spark, spark.createDataFrame(rows, SCHEMA), SF)
    assert sorted(r.doc_id for r in out.collect()) == list(range(10)) and out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
