"""Corpus cleaning pipeline: language identification, line dedup, near-duplicate removal, benchmark decontamination
and packing. Each stage is one operator of ``quarry.llm`` applied to all that the stage before it kept; all but the
last return the columns of ``documents``. Their decisions:

- language: documents without any letter, or without text, go; a missing language is filled with the predicted one
  (it stays missing if no row has a language to learn from);
- lines: lines found in at least 10 documents go, and n_chars follows the text;
- near duplicates: of the documents of one component, the one with the smallest id stays. Rows that share an id are one
  document, and so are rows without an id that share a text; one row of it stays, that with the smallest row hash. A
  document without an id stays only if its component has none with an id;
- benchmark: documents with a benchmark window go;
- packing: one row for each piece of a document, with its bin.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bin_packing, language_mixture, line_runs, prefix_tree_join, wu_manber
from quarry.session import scratch_path

ORACLE_SQL = None  # expectation-maximisation and best-fit have no SQL form; tests compare with brute force


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_mixture.train(docs.where(language_mixture.remainder("doc_id", 4) != 2))
    found = language_mixture.identify(docs, model)
    found = found.where("lang_pred <> 'und'") if model.langs else docs.where(F.col("text").rlike(r"\p{L}")).withColumn("lang_pred", F.lit(None))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_runs.dedup_lines(docs, min_docs=10)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = "id" + "_" * max(map(len, docs.columns))  # a name that no column has
    unnamed = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND((1 << 62) - 1)  # beyond real ids, equal for equal texts
    named = docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), unnamed))
    found = prefix_tree_join.jaccard_components(named, key=own)
    gone = found.where(F.col("component_id") != F.col(own)).select(own).distinct()
    many = named.groupBy(own).count().where("count > 1").select(own).join(gone, own, "left_anti")
    single = named.join(gone.unionByName(many), own, "left_anti").select(docs.columns)
    row = F.struct(*docs.columns)
    one = named.join(many, own, "left_semi").groupBy(own).agg(F.min_by(row, F.xxhash64(*docs.columns)).alias("row"))
    return single.unionByName(one.select("row.*"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return wu_manber.find_benchmark(docs, benchmark).where("n_hit = 0").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bin_packing.pack(docs)


STAGES = [
    ("language_mixture", known_language),
    ("line_dedup", unrepeated_lines),
    ("jaccard_join", one_of_each_group),
    ("decontaminate", uncontaminated),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
