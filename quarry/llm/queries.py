"""The registered queries of this subpackage: each applies one operator to its whole table and derives the columns
of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (
    bin_packing,
    grid_order_join,
    katz,
    language_mixture,
    line_runs,
    mask_search,
    periodic_runs,
    prefix_tree_join,
    substring_dedup,
    token_counts,
    toxicity_knn,
    warc,
    wu_manber,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def digest(text: str) -> F.Column:
    return F.sha2(F.col(text), 256)


# ASCII-white-space words, and A-Z lower-cased only, in DuckDB
SPLIT = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql_discounts(of: str, cutoff: int = 5) -> str:
    """Good-Turing discounts d1..d5 from the counts of counts n1..n6 of a relation, by the rule of ``katz.discounts``."""
    def d(r: int, k: int) -> str:
        return f"((({r} + 1) * n{r + 1} / n{r} / {r} - ({k} + 1) * n{k + 1} / n1) / (1 - ({k} + 1) * n{k + 1} / n1))"

    def valid(k: int) -> str:
        return " AND ".join([f"n{r} > 0" for r in range(1, k + 1)] + [f"({k} + 1) * n{k + 1} < n1"]
                            + [f"{d(r, k)} > 0 AND {d(r, k)} < 1" for r in range(1, k + 1)])

    cols = []
    for r in range(1, cutoff + 1):
        cases = " ".join(f"WHEN {valid(k)} THEN {d(r, k) if r <= k else '1.0'}" for k in range(cutoff, 0, -1))
        cols.append(f"CASE {cases} ELSE 1 - 0.5 / {r} END AS d{r}")
    counts = ", ".join(f"CAST(count(*) FILTER (c = {r}) AS DOUBLE) AS n{r}" for r in range(1, cutoff + 2))
    off = " + ".join(f"(1 - d{r}) * {r} * n{r}" for r in range(1, cutoff + 1))
    return (f"SELECT *, {off} AS gone FROM (SELECT *, {', '.join(cols)} FROM "
            f"(SELECT CAST(coalesce(sum(c), 0) AS DOUBLE) AS n, count(*) AS v, {counts} FROM {of}))")


SQL_DISCOUNT = "CASE c " + " ".join(f"WHEN {r} THEN d{r}" for r in range(1, 6)) + " ELSE 1.0 END"
# crc32 of the id as text, byte by byte over the 256-entry table of the reversed polynomial
SQL_CRC_TABLE = """SELECT list_transform(generate_series(0, 255), lambda i: list_reduce(
         list_prepend(CAST(i AS UBIGINT), list_transform(generate_series(1, 8), lambda k: CAST(0 AS UBIGINT))),
         lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, CAST(3988292384 AS UBIGINT)) ELSE c // 2 END)) AS t"""
SQL_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT),
         list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS UBIGINT))),
         lambda a, b: xor(a // 256, t[CAST(xor(a, b) % 256 AS BIGINT) + 1])), CAST(4294967295 AS UBIGINT))"""


@register("op1_katz_scores", f"""
WITH t AS ({SQL_CRC_TABLE}),
d AS (SELECT doc_id, row_number() OVER () AS r, {SQL_CRC} % 5 <> 1 AS train,
             list_append(regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+'), ' ') AS w FROM documents, t),
k AS (SELECT r, train, w[i] AS w, CASE WHEN i = 1 THEN '  ' ELSE w[i - 1] END AS ctx
      FROM (SELECT r, train, w, unnest(generate_series(1, len(w))) AS i FROM d)),
u AS (SELECT w, count(*) AS c FROM k WHERE train GROUP BY w),
b AS (SELECT ctx, w, count(*) AS c FROM k WHERE train GROUP BY ctx, w),
g1 AS ({_sql_discounts('u')}),
g2 AS ({_sql_discounts('b')}),
e AS (SELECT greatest(n + CASE WHEN gone <= 0 THEN 1 ELSE 0 END, 1) AS events, CASE WHEN gone > 0 THEN gone ELSE 1 END AS unseen FROM g1),
p AS (SELECT w, c, {SQL_DISCOUNT} * c / events AS p FROM u, g1, e),
x AS (SELECT ctx, sum(c) AS total, sum(p) AS mass, sum(off) AS off
      FROM (SELECT b.ctx, b.c, p.p, CASE WHEN b.c <= 5 THEN (1 - {SQL_DISCOUNT.replace('CASE c', 'CASE b.c')}) * b.c ELSE 0 END AS off
            FROM b JOIN p USING (w), g2) GROUP BY ctx),
s AS (SELECT k.r, coalesce(p.c, 0) AS c1,
             CASE WHEN b.c IS NOT NULL THEN {SQL_DISCOUNT.replace('CASE c', 'CASE b.c')} * b.c / (total + CASE WHEN off <= 0 THEN 1 ELSE 0 END)
                  ELSE coalesce((CASE WHEN off > 0 THEN off ELSE 1 END) / (total + CASE WHEN off <= 0 THEN 1 ELSE 0 END) / (1 - mass), 1)
                       * coalesce(p.p, unseen / events) END AS prob
      FROM k LEFT JOIN b ON k.ctx = b.ctx AND k.w = b.w LEFT JOIN x ON k.ctx = x.ctx LEFT JOIN p ON k.w = p.w, g2, e)
SELECT any_value(d.doc_id) AS doc_id, NOT any_value(d.train) AS held_out, count(*) AS n_tokens, count(*) FILTER (c1 > 0) AS n_known,
       CAST(any_value(g1.n) AS BIGINT) AS train_tokens, round(sum(log10((c1 + 0.5) / (g1.n + 0.5 * (g1.v + 1)))), 6) AS base_score,
       round(sum(log10(prob)), 6) AS score
FROM s JOIN d USING (r), g1 GROUP BY r""")
def op1_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = language_mixture.remainder("doc_id", 5) != 1
    out = katz.score_corpus(table(spark, sf_dir, "documents"), train)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      F.round("base_score", 6).alias("base_score"), F.round("score", 6).alias("score"))


@register("op2_substring_dedup", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {SPLIT} AS w FROM documents),
x AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS s
      FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS least FROM x GROUP BY s),
g AS (SELECT r, list(DISTINCT j) AS gone
      FROM (SELECT r, unnest(generate_series(i, i + 12)) AS j FROM x JOIN m USING (s) WHERE doc_id > least) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
              ELSE array_to_string([w[j] for j in generate_series(1, len(w)) if NOT list_contains(gone, j)], ' ') END) AS kept_sha256
FROM d LEFT JOIN g USING (r)""")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"), size=13)
    return out.select("doc_id", "n_words", "n_removed", digest("kept_text").alias("kept_sha256"))


@register("op3_decontaminate", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS id,
             regexp_extract_all({LOWER}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
p AS (SELECT DISTINCT id, l, array_to_string(w[i:i + l - 1], ' ') AS s
      FROM (SELECT id, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i
            FROM (SELECT *, least(len(w), 10) AS l FROM b WHERE len(w) > 0))),
x AS (SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS s
      FROM (SELECT r, w, l, unnest(generate_series(1, len(w) - l + 1)) AS i FROM d, (SELECT DISTINCT l FROM p) WHERE len(w) >= l)),
h AS (SELECT r, i, x.l, id FROM x JOIN p USING (l, s)),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + l - 1)) AS j FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)""")
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wu_manber.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10, keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@register("op4_jaccard_join", f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS u, doc_id AS v FROM w UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v)
SELECT r.u AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.v) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.u GROUP BY r.u""")
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_tree_join.jaccard_components(table(spark, sf_dir, "documents"), gram=5)


@register("op5_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < top THEN top END AS refers_to
FROM t""")
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, index = warc.write_archives(table(spark, sf_dir, "pages"))
    out = warc.read_records(index, root, payloads=False)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op6_language_mixture")
def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_mixture.remainder("doc_id", 4) == 2)
    model = language_mixture.train(docs.where(~F.col("held_out")))
    return language_mixture.identify(docs, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score")


@register("op7_line_dedup", r"""
WITH l AS (
  SELECT doc_id, i, unnest(s) AS line, unnest(generate_series(1, len(s))) AS pos
  FROM (SELECT doc_id, row_number() OVER () AS i, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT i) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY i""")
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_runs.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", digest("text").alias("kept_sha256"))


@register("op8_toxicity_knn")
def op8_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_mixture.remainder("doc_id", 5) == 0)
    labels = table(spark, sf_dir, "labels").where(language_mixture.remainder("doc_id", 5) != 0)
    model = toxicity_knn.train(docs, labels)
    return toxicity_knn.score(docs, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")


@register("op9_grid_order_join", """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
      ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u),
r AS (SELECT vec_id AS u, vec_id AS v FROM embeddings UNION SELECT r.u, l.v FROM r JOIN l ON l.u = r.v)
SELECT r.u AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.v) AS component_id, r.u = min(r.v) AS kept
FROM r LEFT JOIN n ON n.u = r.u GROUP BY r.u""")
def op9_grid_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_order_join.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


@register("op10_best_fit_packing")
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack(table(spark, sf_dir, "documents"))


ALNUM = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"


@register("op11_mask_search", f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM documents),
z AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d),
f AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY r, t),
u AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM f GROUP BY t), z),
b AS (SELECT item_id, row_number() OVER () AS q, regexp_extract_all({LOWER}, {ALNUM}) AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
k AS (SELECT q, t, count(*) AS k FROM (SELECT q, unnest(w) AS t FROM b) GROUP BY q, t),
s AS (SELECT q, r, CAST(sum(k * u.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * CAST(len(d.w) AS BIGINT) * docs) // total)))) AS BIGINT) AS score
      FROM k JOIN u USING (t) JOIN f USING (t) JOIN d USING (r), z GROUP BY q, r),
o AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
      FROM s JOIN b USING (q) JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 20""")
def op11_mask_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), top=20)


@register("op12_token_counts")
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return out.withColumn("over_limit", F.col("n_tokens") > 2048)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the repeats that the query of operator 13 prescribes: in documents whose h = crc32(doc_id) is
    a multiple of 10, the words from a on repeat the p words there. A null id has no h."""
    words = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
    cut = docs.selectExpr("doc_id", "text", "crc32(cast(cast(doc_id as string) as binary)) as h")
    cut = cut.selectExpr("doc_id", "text", "h div 10 as g", f"case when h % 10 = 0 then {words} end as w")
    cut = cut.selectExpr("*", "case when size(w) > 0 then cast(g % size(w) as int) end as a")
    cut = cut.selectExpr("*", "1 + (size(w) - a) div (3 + g % 8) as p")
    repeated = "array_join(transform(sequence(0, size(w) - 1), i -> w[if(i < a, i, cast(a + (i - a) % p as int))]), ' ')"
    return cut.selectExpr("doc_id", f"case when a is not null then {repeated} else text end as text")


@register("op13_periodic_runs", f"""
WITH t AS ({SQL_CRC_TABLE}),
d AS (SELECT doc_id, row_number() OVER () AS r, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a, h // 10 AS g
      FROM (SELECT doc_id, {SPLIT} AS w, {SQL_CRC} AS h FROM documents, t)),
m AS (SELECT *, CAST(a AS BIGINT) AS a0, CAST(1 + (n - a) // (3 + g % 8) AS BIGINT) AS p FROM d),
x AS (SELECT r, i, n, CASE WHEN i >= a0 THEN w[1 + a0 + (i - a0) % p] ELSE w[1 + i] END AS s
      FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM m)),
e AS (SELECT x.r, x.i, y.i - x.i AS q FROM x JOIN x AS y ON x.r = y.r AND x.s = y.s AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
l AS (SELECT r, q, min(i) AS st, count(*) + q AS ln
      FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM e) GROUP BY r, q, k),
u AS (SELECT r, st, ln, min(q) AS q FROM l WHERE ln >= greatest(6, 4 * q) GROUP BY r, st, ln),
v AS (SELECT r, count(*) AS n_runs, arg_max(struct_pack(st := st, ln := ln, q := q), (ln, -st, -q)) AS top,
             string_agg(concat(st, ',', ln, ',', q, chr(10)), '' ORDER BY st, q) AS txt FROM u GROUP BY r),
g AS (SELECT DISTINCT r, unnest(generate_series(st + q, st + ln - 1)) AS i FROM u),
c AS (SELECT x.r, string_agg(s, ' ' ORDER BY x.i) AS kept FROM x LEFT JOIN g ON g.r = x.r AND g.i = x.i WHERE g.i IS NULL GROUP BY x.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(top.st AS BIGINT) AS "start", CAST(top.ln AS BIGINT) AS length, CAST(top.q AS BIGINT) AS period,
       CAST(1000 * top.ln // top.q AS BIGINT) AS exponent_milli, sha256(coalesce(txt, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM m LEFT JOIN v USING (r) LEFT JOIN c USING (r)""")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.detect_runs(with_repeats(table(spark, sf_dir, "documents")), keep=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("before"), (-r.period).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    out = found.withColumn("top", longest).withColumn("lines", lines)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.before")).alias("start"), F.col("top.length").alias("length"),
                      (-F.col("top.q")).alias("period"), F.expr("1000 * top.length div -top.q").alias("exponent_milli"),
                      digest("lines").alias("runs_sha256"), digest("collapsed_text").alias("collapsed_sha256"))
