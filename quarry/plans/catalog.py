"""Queries over the driver tables, each paired with an equivalent DuckDB SQL oracle.

Every query reads whole tables (no id subsets, no row caps beyond operators whose feature *is* a
limit: top-k tags, a sample of n). Column names and types line up with the oracle; floating results
are rounded to 6 decimals on both sides.

Stand-ins (from the survey): ``part`` rows are puzzles (id ``p_partkey``, tags ``p_name``, rating
``p_retailprice``, source order ``p_partkey``); ``documents``/``benchmark``/``labels`` are the distilled
rows, the test set and the done set; ``events`` are model responses / attempts: prompt = ``user_id``,
sample = ``event_id``, stage = ``event_type``, checkpoint step = day of ``ts``, and a response text and
a ground truth synthesised from the ids by the same column rule on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import joins, order, quota, scoring, tags

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Parameters of the catalog queries (the reference's defaults are n=800, k=50 on a 4 M-row table; the
# 2,000-row part table uses smaller ones so that quotas bind).
QUOTA_N, QUOTA_K, SHORT_N = 40, 6, 250
SEED = 42
BATCH = 256
SAMPLE = 10
MAX_TOKENS = 5
MAX_ATTEMPTS = 11
OVERLONG = 200
TRUNCATE = 50


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Whitespace class shared by the Spark code and the oracles (Python ``str.split`` semantics).
SQL_SPACE = T.PY_SPACE
SQL_SPLIT = SQL_SPACE + "+"


def sql_tokens(expr: str) -> str:
    return f"list_filter(regexp_split_to_array({expr}, '{SQL_SPLIT}'), lambda x: x <> '')"


# ---- synthetic responses over events (same rule in Spark and SQL) ---------------------------------------
def _square_move(x: Column) -> Column:
    files, ranks = F.lit("abcdefgh"), F.lit("12345678")

    def pick(s, v, d):
        return F.substring(s, (F.pmod(F.floor(v / F.lit(d)), F.lit(8)) + 1).cast("int"), 1)

    return F.concat(pick(files, x, 1), pick(ranks, x, 8), pick(files, x, 64), pick(ranks, x, 512))


def _sql_move(x: str) -> str:
    def pick(s, d):
        return f"substr('{s}', CAST((({x}) // {d}) % 8 + 1 AS INTEGER), 1)"

    return f"({pick('abcdefgh', 1)} || {pick('12345678', 8)} || {pick('abcdefgh', 64)} || {pick('12345678', 512)})"


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (event_id, user_id, stage, step, cost, text, truth)."""
    ev = table(spark, sf_dir, "events")
    truth = F.when(F.pmod(F.col("user_id"), F.lit(5)) == 0, F.lit("z9z9")).otherwise(_square_move(F.col("user_id")))
    kind = F.pmod(F.col("event_id"), F.lit(6))
    text = (
        F.when(kind == 0, F.concat(F.lit("FINAL_ANSWER: "), truth))
        .when(kind == 1, F.concat(F.lit("thinking about it\nfinal_answer:"), F.upper(truth), F.lit(" done")))
        .when(kind == 2, F.concat(F.lit("FINAL_ANSWER: "), _square_move(F.col("event_id"))))
        .when(kind == 3, F.concat(F.lit("The best move is "), truth))
        .when(kind == 4, F.concat(F.lit("Final_Answer:  "), truth, F.lit("q and more")))
        .otherwise(F.concat(F.lit("FINAL_ANSWER "), truth))
    )
    return ev.select(
        "event_id",
        "user_id",
        F.col("event_type").alias("stage"),
        F.dayofmonth("ts").cast("bigint").alias("step"),
        F.col("value").alias("cost"),
        text.alias("text"),
        truth.alias("truth"),
    )


SQL_RESPONSES = f"""
responses AS (
  SELECT event_id, user_id, event_type AS stage, CAST(day(ts) AS BIGINT) AS step, value AS cost,
         CASE event_id % 6
           WHEN 0 THEN 'FINAL_ANSWER: ' || truth
           WHEN 1 THEN 'thinking about it' || chr(10) || 'final_answer:' || upper(truth) || ' done'
           WHEN 2 THEN 'FINAL_ANSWER: ' || {_sql_move('event_id')}
           WHEN 3 THEN 'The best move is ' || truth
           WHEN 4 THEN 'Final_Answer:  ' || truth || 'q and more'
           ELSE 'FINAL_ANSWER ' || truth END AS text,
         truth
  FROM (SELECT *, CASE WHEN user_id % 5 = 0 THEN 'z9z9' ELSE {_sql_move('user_id')} END AS truth FROM events)
),
scored AS (
  SELECT *, nullif(lower(regexp_extract(text, '(?i)FINAL_ANSWER:\\s*([a-h][1-8][a-h][1-8][qrbn]?)', 1)), '') AS answer
  FROM responses
),
scored2 AS (
  SELECT *, CAST(coalesce(CAST(answer = lower(truth) AS INTEGER), 0) AS DOUBLE) AS score FROM scored
)"""


def scored_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = responses(spark, sf_dir)
    return scoring.score_responses(r.withColumn("answer", T.extract_answer("text")), "text", "truth", answer="answer")


# ---- B1 / D1 / F1 / F3 / D2 ----------------------------------------------------------------------------
SQL_TAGS = f"SELECT unnest({sql_tokens('p_name')}) AS tag FROM part"


@register("tag_frequency", f"SELECT tag, count(*) AS freq FROM ({SQL_TAGS}) GROUP BY tag")
def q_tag_frequency(spark, sf):
    return tags.tag_frequency(table(spark, sf, "part"), "p_name")


@register(
    "rarest_tags",
    f"""SELECT tag, freq, CAST(row_number() OVER (ORDER BY freq, tag) - 1 AS INTEGER) AS tag_rank
        FROM (SELECT tag, count(*) AS freq FROM ({SQL_TAGS}) GROUP BY tag ORDER BY freq, tag LIMIT {QUOTA_K})""",
)
def q_rarest_tags(spark, sf):
    return tags.rarest_tags(table(spark, sf, "part"), "p_name", QUOTA_K)


@register(
    "tag_listing_desc",
    f"SELECT tag, count(*) AS freq FROM ({SQL_TAGS}) GROUP BY tag ORDER BY freq DESC, tag",
)
def q_tag_listing_desc(spark, sf):
    return tags.tag_listing_desc(table(spark, sf, "part"), "p_name")


@register(
    "dataset_profile",
    f"""SELECT (SELECT count(*) FROM part) AS rows, min(p_retailprice) AS min_value, max(p_retailprice) AS max_value,
               round(avg(p_retailprice), 6) AS mean_value,
               (SELECT count(DISTINCT tag) FROM ({SQL_TAGS})) AS distinct_tags
        FROM part""",
)
def q_dataset_profile(spark, sf):
    return tags.profile(table(spark, sf, "part"), "p_name", "p_retailprice")


# ---- E3 / D6 --------------------------------------------------------------------------------------------
def _sql_quota_ctes(n: int, k: int, src: str = "part", pos: str = "p_partkey", x: str = "") -> list[str]:
    """Sequential definition unrolled: theme r takes its first n ids not taken by themes < r.

    ``src`` is a relation with ``p_partkey``, ``p_name`` and the source-order column ``pos``; the CTE
    names carry the suffix ``x`` so that several selections can share one query."""
    ctes = [
        f"freq{x} AS (SELECT tag, count(*) AS freq FROM (SELECT unnest({sql_tokens('p_name')}) AS tag FROM {src}) "
        f"GROUP BY tag)",
        f"themes{x} AS (SELECT tag, CAST(row_number() OVER (ORDER BY freq, tag) - 1 AS INTEGER) AS r "
        f"FROM freq{x} ORDER BY freq, tag LIMIT {k})",
        f"pairs{x} AS (SELECT DISTINCT p.p_partkey AS id, p.pos, t.tag, t.r FROM "
        f"(SELECT p_partkey, {pos} AS pos, unnest({sql_tokens('p_name')}) AS tag FROM {src}) p "
        f"JOIN themes{x} t ON p.tag = t.tag)",
    ]
    for r in range(k):
        prev = (" UNION ALL ".join(f"SELECT id FROM s{x}_{j}" for j in range(r))
                or "SELECT NULL::BIGINT AS id WHERE false")
        ctes.append(
            f"s{x}_{r} AS (SELECT id, min(pos) AS pos, {r} AS r FROM pairs{x} WHERE r = {r} "
            f"AND id NOT IN ({prev}) GROUP BY id ORDER BY pos LIMIT {n})"
        )
    union = " UNION ALL ".join(f"SELECT * FROM s{x}_{r}" for r in range(k))
    return ctes + [f"sel{x} AS ({union})"]


def _sql_quota(n: int, k: int) -> str:
    return "WITH " + ",\n".join(_sql_quota_ctes(n, k)) + "\n"


ORACLES_QUOTA_SELECT = (
    _sql_quota(QUOTA_N, QUOTA_K)
    + "SELECT sel.id AS p_partkey, themes.tag AS theme, themes.r AS theme_rank FROM sel JOIN themes ON sel.r = themes.r"
)


@register("quota_select", ORACLES_QUOTA_SELECT)
def q_quota_select(spark, sf):
    sel = quota.quota_select(table(spark, sf, "part"), "p_partkey", "p_name", "p_partkey", QUOTA_N, QUOTA_K)
    return sel.select("p_partkey", "theme", "theme_rank")


@register(
    "quota_shortfall",
    _sql_quota(SHORT_N, QUOTA_K)
    + """SELECT themes.tag AS theme, themes.r AS theme_rank, CAST(coalesce(c, 0) AS BIGINT) AS found,
               CAST(""" + str(SHORT_N) + """ - coalesce(c, 0) AS BIGINT) AS shortfall
         FROM themes LEFT JOIN (SELECT r, count(*) AS c FROM sel GROUP BY r) s ON s.r = themes.r
         WHERE """ + str(SHORT_N) + " - coalesce(c, 0) > 0",
)
def q_quota_shortfall(spark, sf):
    return quota.quota_shortfall(table(spark, sf, "part"), "p_partkey", "p_name", "p_partkey", SHORT_N, QUOTA_K)


# ---- section 3.1: the selection flow (E1, E2, D1, F1, E3, E1 again) --------------------------------------------
_SQL_HALVES = [
    f"ranked AS (SELECT p_partkey, p_name, row_number() OVER (ORDER BY md5(concat(p_partkey, ':{SEED}')), p_partkey) "
    f"AS pos FROM part)",
    "halfA AS (SELECT * FROM ranked WHERE pos <= (SELECT count(*) FROM part) // 2)",
    "halfB AS (SELECT * FROM ranked WHERE pos > (SELECT count(*) FROM part) // 2)",
]


@register(
    "select_flow",
    "WITH " + ",\n".join(
        _SQL_HALVES + _sql_quota_ctes(QUOTA_N, QUOTA_K, "halfA", "pos", "A")
        + _sql_quota_ctes(QUOTA_N, QUOTA_K, "halfB", "pos", "B")
        + ["picked AS (SELECT 'A' AS half, s.id, t.tag AS theme, t.r AS theme_rank FROM selA s JOIN themesA t "
           "ON s.r = t.r UNION ALL SELECT 'B', s.id, t.tag, t.r FROM selB s JOIN themesB t ON s.r = t.r)"]
    )
    + f"""
SELECT half, id AS p_partkey, theme, theme_rank,
       CAST(row_number() OVER (PARTITION BY half ORDER BY md5(concat(id, ':{SEED}')), id) AS BIGINT) AS shuffle_rank
FROM picked""",
)
def q_select_flow(spark, sf):
    """Stage 0 of the reference: shuffle the puzzles, halve them, pick a rare-theme-balanced subset of each
    half (source order = the shuffle rank), and shuffle each selection."""
    from quarry.plans import flows

    out = flows.select_flow(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", "p_name", SEED,
                            QUOTA_N, QUOTA_K, QUOTA_N, QUOTA_K)
    cols = ["p_partkey", "theme", "theme_rank", "shuffle_rank"]
    return out["sft"].select(F.lit("A").alias("half"), *cols).unionByName(
        out["rl"].select(F.lit("B").alias("half"), *cols))


# ---- E1 / E2 / E6 / E7 --------------------------------------------------------------------------------------
SQL_ORDER_RANK = f"row_number() OVER (ORDER BY md5(concat(o_orderkey, ':{SEED}')), o_orderkey)"


@register("shuffle_rank", f"SELECT o_orderkey, {SQL_ORDER_RANK} AS shuffle_rank FROM orders")
def q_shuffle_rank(spark, sf):
    return order.shuffle_rank(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", SEED)


@register(
    "split_halves",
    f"""SELECT o_orderkey, CASE WHEN rk <= (SELECT count(*) FROM orders) // 2 THEN 'A' ELSE 'B' END AS half
        FROM (SELECT o_orderkey, {SQL_ORDER_RANK} AS rk FROM orders)""",
)
def q_split_halves(spark, sf):
    return order.split_halves(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", SEED).select(
        "o_orderkey", "half"
    )


@register(
    "assign_batches",
    f"""SELECT lid, CAST((rk - 1) // {BATCH} AS BIGINT) AS batch FROM (
          SELECT lid, row_number() OVER (ORDER BY md5(concat(lid, ':{SEED}')), lid) AS rk
          FROM (SELECT concat(l_orderkey, '-', l_linenumber) AS lid FROM lineitem))
        WHERE (rk - 1) // {BATCH} < (SELECT count(*) FROM lineitem) // {BATCH}""",
)
def q_assign_batches(spark, sf):
    li = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("lid"))
    return order.assign_batches(li, "lid", BATCH, SEED, drop_last=True).select("lid", "batch")


@register(
    "sample_n",
    f"""SELECT o_orderkey, {SQL_ORDER_RANK} AS sample_rank FROM orders
        ORDER BY sample_rank LIMIT {SAMPLE}""",
)
def q_sample_n(spark, sf):
    return order.sample_n(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", SAMPLE, SEED)


# ---- J1 / J3 / J4 / D7 ------------------------------------------------------------------------------------------
@register(
    "pending_rows",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def q_pending_rows(spark, sf):
    return joins.pending(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


# Line rule: any shared non-empty line. Passage rule: the document contains a whole benchmark text.
SQL_LINE_IDS = """
  SELECT DISTINCT d.doc_id FROM
    (SELECT doc_id, unnest(string_split(text, chr(10))) AS seg FROM documents) d
  JOIN (SELECT DISTINCT unnest(string_split(text, chr(10))) AS seg FROM benchmark) b ON d.seg = b.seg
  WHERE d.seg <> ''"""
SQL_PASSAGE_IDS = "SELECT DISTINCT d.doc_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE b.text <> ''"


# Key grain: the first four tokens of a line. Every line of a document is a row.
def _sql_line_keys(src: str) -> str:
    return (f"SELECT *, array_to_string(list_slice({sql_tokens('line')}, 1, 4), ' ') AS key "
            f"FROM (SELECT *, unnest(string_split(text, chr(10))) AS line FROM {src})")


@register(
    "exclude_overlap",
    f"""SELECT doc_id, line, key FROM ({_sql_line_keys('documents')})
        WHERE key NOT IN (SELECT key FROM ({_sql_line_keys('benchmark')}) WHERE key <> '')""",
)
def q_exclude_overlap(spark, sf):
    """J2 at key grain: the first four tokens of every document line against those of every benchmark line."""
    def keyed(name, *cols):
        rows = table(spark, sf, name).select(*cols, F.explode(F.split("text", "\n")).alias("line"))
        return rows.withColumn("key", T.prefix_key("line"))

    return joins.exclude_overlap(keyed("documents", "doc_id"), keyed("benchmark").filter("key <> ''"), "key")


@register(
    "pending_prefix",
    """SELECT doc_id, lang FROM (SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 500) d
       WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def q_pending_prefix(spark, sf):
    """J1 with the F2 target prefix: the first 500 documents by id that are not labelled yet."""
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return joins.pending(docs, table(spark, sf, "labels"), "doc_id", ["doc_id"], 500)


@register(
    "pending_landed",
    "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def q_pending_landed(spark, sf):
    """J1 against a bucketed done table: the label ids land in two portions, the second of which repeats the first."""
    import uuid

    from quarry.operators import done
    from quarry.session import scratch_path

    labels, name = table(spark, sf, "labels"), f"quarry_done_{uuid.uuid4().hex[:12]}"
    buckets = done.buckets_for(labels.count())
    done.open_done(spark, name, scratch_path(spark, "done"), "doc_id", "bigint", buckets)
    for portion in (labels.filter("quality = 1"), labels):
        done.land_done(portion, name, "doc_id", buckets)
    return done.pending_landed(table(spark, sf, "documents").select("doc_id", "lang"), name, "doc_id")


@register("exclude_passages", f"SELECT doc_id FROM documents WHERE doc_id NOT IN ({SQL_PASSAGE_IDS})")
def q_exclude_passages(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return joins.exclude_passages(docs, "doc_id", "text", table(spark, sf, "benchmark"), "text").select("doc_id")


@register("flag_overlap", f"SELECT doc_id, doc_id IN ({SQL_LINE_IDS}) AS overlaps FROM documents")
def q_flag_overlap(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return joins.flag_passages(docs, "doc_id", "text", table(spark, sf, "benchmark"), "text").select("doc_id", "overlaps")


@register(
    "status_counts",
    f"""SELECT status, count(*) AS rows FROM (
          SELECT CASE WHEN d.text IS NULL OR NOT regexp_matches(d.text, '[^{SQL_SPACE[1:]}')
                        OR l.doc_id IS NULL THEN 'invalid'
                      WHEN d.doc_id IN ({SQL_LINE_IDS}) OR d.doc_id IN ({SQL_PASSAGE_IDS}) THEN 'excluded'
                      ELSE 'kept' END AS status
          FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)
        GROUP BY status""",
)
def q_status_counts(spark, sf):
    from quarry.plans.flows import classify

    docs = table(spark, sf, "documents")
    return scoring.status_counts(classify(docs, "doc_id", "text", table(spark, sf, "labels"), table(spark, sf, "benchmark")))


# ---- B14 - B16 ------------------------------------------------------------------------------------------------
@register("extract_answer", f"WITH {SQL_RESPONSES} SELECT event_id, answer FROM scored")
def q_extract_answer(spark, sf):
    return responses(spark, sf).select("event_id", T.extract_answer("text").alias("answer"))


@register("answer_score", f"WITH {SQL_RESPONSES} SELECT event_id, answer, score, score AS binary_score FROM scored2")
def q_answer_score(spark, sf):
    return scored_responses(spark, sf).select("event_id", "answer", "score", "binary_score")


# ---- D4 / D5 / D8 / D10 ------------------------------------------------------------------------------------------------
SQL_PASS = f"""
pass AS (
  SELECT user_id, count(*) AS n_samples, round(avg(score), 6) AS pass_at_1, arg_min(text, event_id) AS first_text
  FROM scored2 GROUP BY user_id
)"""


def _sql_len(expr: str) -> str:
    return f"CAST(len({sql_tokens(expr)}) AS INTEGER)"


@register(
    "pass_at_1",
    f"""WITH {SQL_RESPONSES}, {SQL_PASS}
        SELECT *, {_sql_len('first_text')} AS num_tokens, {_sql_len('first_text')} >= {MAX_TOKENS} AS clipped FROM pass""",
)
def q_pass_at_1(spark, sf):
    return scoring.pass_at_1(scored_responses(spark, sf), "user_id", "event_id", "score", "text", MAX_TOKENS)


@register(
    "eval_summary",
    f"""WITH {SQL_RESPONSES},
        p AS (SELECT stage, user_id, round(avg(score), 6) AS pass_at_1,
                     {_sql_len('arg_min(text, event_id)')} AS num_tokens FROM scored2 GROUP BY stage, user_id)
        SELECT stage, count(*) AS prompts, round(avg(pass_at_1), 6) AS accuracy, round(sum(pass_at_1), 6) AS score_sum,
               round(avg(num_tokens), 6) AS mean_length,
               CAST(sum(CAST(num_tokens >= {MAX_TOKENS} AS INTEGER)) AS BIGINT) AS clipped,
               round(sum(CAST(num_tokens >= {MAX_TOKENS} AS INTEGER)) / count(*), 6) AS clipped_share
        FROM p GROUP BY stage""",
)
def q_eval_summary(spark, sf):
    p = scoring.pass_at_1(scored_responses(spark, sf), ["stage", "user_id"], "event_id", "score", "text", MAX_TOKENS)
    return scoring.eval_summary(p, ["stage"])


@register("eval_incremental", ORACLES["eval_summary"])
def q_eval_incremental(spark, sf):
    """D4 + D5 from stored state: the responses land in three portions that share groups and prompts, the second one
    twice; each landing merges into what is stored."""
    from quarry.operators import eval_store
    from quarry.session import scratch_path

    path, scored = scratch_path(spark, "evals"), scored_responses(spark, sf)
    for landing, portion in enumerate((0, 1, 1, 2)):
        part = scored.filter(F.pmod("event_id", F.lit(3)) == portion)
        eval_store.land(part, path, min(landing, portion), ["stage"], "user_id", "event_id", "score", "text", MAX_TOKENS)
    return eval_store.summaries(spark, path, ["stage"])


SQL_CKPT = """
ckpt AS (SELECT stage, step, count(*) AS rows, round(avg(score), 6) AS accuracy FROM scored2 GROUP BY stage, step)"""


@register(
    "best_checkpoint",
    f"""WITH {SQL_RESPONSES}, {SQL_CKPT}
        SELECT stage, arg_max(step, (accuracy, -step)) AS best_step, max(accuracy) AS best_accuracy
        FROM ckpt GROUP BY stage""",
)
def q_best_checkpoint(spark, sf):
    return scoring.best_checkpoint(scoring.checkpoint_accuracy(scored_responses(spark, sf), "stage", "step"))


@register(
    "eval_curve",
    f"""WITH {SQL_RESPONSES}, {SQL_CKPT}
        SELECT *, max(accuracy) OVER (PARTITION BY stage ORDER BY step ROWS UNBOUNDED PRECEDING) AS running_best
        FROM ckpt""",
)
def q_eval_curve(spark, sf):
    return scoring.eval_curve(scoring.checkpoint_accuracy(scored_responses(spark, sf), "stage", "step"))


# ---- E4 / D3 -------------------------------------------------------------------------------------------------------------
SQL_ATTEMPTS = f"""
attempts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt FROM scored2)
  WHERE attempt <= {MAX_ATTEMPTS}
)"""


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    """First ``MAX_ATTEMPTS`` responses of every user, numbered by event id (WindowGroupLimit)."""
    a = order.first_n_per_group(scored_responses(spark, sf), ["user_id"], ["event_id"], MAX_ATTEMPTS, "attempt")
    return a.withColumn("attempt", F.col("attempt").cast("bigint"))


@register(
    "first_accepted",
    f"""WITH {SQL_RESPONSES}, {SQL_ATTEMPTS}
        SELECT user_id, min(attempt) AS attempt, arg_min(event_id, attempt) AS event_id
        FROM attempts WHERE score = 1.0 GROUP BY user_id""",
)
def q_first_accepted(spark, sf):
    a = attempts(spark, sf).select("user_id", "attempt", "event_id", "score")
    return scoring.first_accepted(a, "user_id", "attempt", "score", MAX_ATTEMPTS).select("user_id", "attempt", "event_id")


@register(
    "ledger",
    f"""WITH {SQL_RESPONSES}, {SQL_ATTEMPTS},
        acc AS (SELECT user_id, min(attempt) AS acc FROM attempts WHERE score = 1.0 GROUP BY user_id),
        per_id AS (
          SELECT a.user_id, max(CAST(acc.acc IS NOT NULL AS INTEGER)) AS ok,
                 sum(CASE WHEN a.attempt = acc.acc THEN a.cost END) AS acc_cost, sum(a.cost) AS all_cost, count(*) AS n
          FROM attempts a LEFT JOIN acc ON a.user_id = acc.user_id
          WHERE acc.acc IS NULL OR a.attempt <= acc.acc GROUP BY a.user_id)
        SELECT count(*) AS ids, CAST(sum(ok) AS BIGINT) AS accepted, CAST(count(*) - sum(ok) AS BIGINT) AS rejected,
               round(sum(ok) / count(*), 6) AS accepted_share, round((count(*) - sum(ok)) / count(*), 6) AS rejected_share,
               round(sum(acc_cost), 6) AS accepted_cost, round(sum(all_cost), 6) AS total_cost,
               CAST(sum(n) AS BIGINT) AS attempts_made
        FROM per_id""",
)
def q_ledger(spark, sf):
    return scoring.attempt_ledger(attempts(spark, sf), "user_id", "attempt", "score", "cost", MAX_ATTEMPTS)


# ---- D9 / E5 ---------------------------------------------------------------------------------------------------------------
@register(
    "filter_groups",
    f"""WITH {SQL_RESPONSES}
        SELECT event_id, user_id, score FROM scored2
        WHERE user_id IN (SELECT user_id FROM scored2 GROUP BY user_id HAVING min(score) < max(score))""",
)
def q_filter_groups(spark, sf):
    return scoring.filter_groups(scored_responses(spark, sf).select("event_id", "user_id", "score"), "user_id")


@register(
    "group_advantage",
    f"""WITH {SQL_RESPONSES}
        SELECT event_id, user_id, score,
               round((score - avg(score) OVER w) / (coalesce(stddev_samp(score) OVER w, 0) + 1e-6), 6) AS advantage
        FROM scored2 WINDOW w AS (PARTITION BY user_id)""",
)
def q_group_advantage(spark, sf):
    g = scoring.group_advantage(scored_responses(spark, sf).select("event_id", "user_id", "score"), "user_id")
    return g.withColumn("advantage", F.round("advantage", 6))


# ---- B21 / B2 -------------------------------------------------------------------------------------------------------
@register(
    "render_chat",
    """SELECT conv_id, count(*) AS turns,
              string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn) || '<|assistant|>' || chr(10)
                AS rendered
       FROM conversations GROUP BY conv_id""",
)
def q_render_chat(spark, sf):
    from quarry.operators.chat import render_chat

    return render_chat(table(spark, sf, "conversations"))


# ---- B26 / B27 / B5 / B3 / B4 ------------------------------------------------------------------------------------------
@register(
    "drop_overlong",
    f"""SELECT doc_id, CAST(len({sql_tokens('text')}) AS INTEGER) AS n_tokens FROM documents
        WHERE len({sql_tokens('text')}) <= {OVERLONG}""",
)
def q_drop_overlong(spark, sf):
    from quarry.functions.records import drop_overlong

    d = table(spark, sf, "documents").select("doc_id", "text")
    return drop_overlong(d, "text", OVERLONG, out="n_tokens").select("doc_id", "n_tokens")


@register(
    "truncate_tokens",
    f"SELECT doc_id, array_to_string(list_slice({sql_tokens('text')}, 1, {TRUNCATE}), ' ') AS truncated FROM documents",
)
def q_truncate_tokens(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", T.truncate_tokens("text", TRUNCATE).alias("truncated"))


@register(
    "prefix_key",
    f"SELECT doc_id, array_to_string(list_slice({sql_tokens('text')}, 1, 4), ' ') AS key FROM documents",
)
def q_prefix_key(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", T.prefix_key("text", 4).alias("key"))


@register(
    "last_segment",
    "SELECT o_orderkey, string_split(o_orderpriority, '-')[-1] AS seg FROM orders",
)
def q_last_segment(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", T.last_segment("o_orderpriority", "-").alias("seg"))


@register(
    "merge_metadata",
    """SELECT event_id, coalesce(json_extract_string(props, '$.type'), event_type) AS type,
              coalesce(json_extract_string(props, '$.k'), 'base') AS k,
              coalesce(json_extract_string(props, '$.src'), 'events') AS src
       FROM events""",
)
def q_merge_metadata(spark, sf):
    ev = table(spark, sf, "events")
    base = F.create_map(F.lit("type"), F.col("event_type"), F.lit("k"), F.lit("base"), F.lit("src"), F.lit("events"))
    m = T.merge_metadata(base, "props")
    return ev.select("event_id", m["type"].alias("type"), m["k"].alias("k"), m["src"].alias("src"))


# ---- B17 / B18 / B23 ------------------------------------------------------------------------------------------------------
@register(
    "to_sft",
    """SELECT 'Summarize the following ' || d.lang || ' text from ' || d.source || '.' AS instruction,
              '' AS input, d.text AS output
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality = 1""",
)
def q_to_sft(spark, sf):
    from quarry.functions.records import to_sft

    d = table(spark, sf, "documents").join(table(spark, sf, "labels").filter("quality = 1"), "doc_id")
    instr = F.concat(F.lit("Summarize the following "), "lang", F.lit(" text from "), "source", F.lit("."))
    return to_sft(d, instr, "text")


@register(
    "to_rl",
    """SELECT 'documents' AS data_source, 'user' AS role, d.text AS content, 'curation' AS ability,
              d.source AS ground_truth, 'rule' AS style, d.doc_id, d.lang, l.quality, l.toxic
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def q_to_rl(spark, sf):
    from quarry.functions.records import flatten_info, to_rl

    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    rl = to_rl(d, "text", "source", {"doc_id": "doc_id", "lang": "lang", "quality": "quality", "toxic": "toxic"},
               data_source="documents", ability="curation")
    flat = flatten_info(rl)
    return flat.select(
        "data_source", F.col("prompt")[0]["role"].alias("role"), F.col("prompt")[0]["content"].alias("content"),
        "ability", F.col("reward_model.ground_truth").alias("ground_truth"), F.col("reward_model.style").alias("style"),
        "doc_id", "lang", "quality", "toxic",
    )


# ---- I1 / I2: scorer registry ---------------------------------------------------------------------------------------
SQL_SOURCE = "CASE WHEN stage IN ('view', 'click', 'purchase') THEN 'chess_puzzles' WHEN stage = 'signup' THEN 'exact_text' ELSE 'unknown' END"


@register(
    "score_by_source",
    f"""WITH {SQL_RESPONSES}
        SELECT event_id, {SQL_SOURCE} AS data_source,
               CASE WHEN {SQL_SOURCE} = 'chess_puzzles' THEN score
                    WHEN {SQL_SOURCE} = 'exact_text' THEN coalesce(CAST(trim(text) = trim(truth) AS DOUBLE), 0)
                    ELSE 0.0 END AS score
        FROM scored2""",
)
def q_score_by_source(spark, sf):
    from quarry.functions.registry import dispatch

    r = responses(spark, sf).withColumn("data_source", F.expr(SQL_SOURCE))
    return r.select("event_id", "data_source", dispatch("data_source", "text", "truth")["score"].alias("score"))


@register("score_sql_function", f"WITH {SQL_RESPONSES} SELECT event_id, score FROM scored2")
def q_score_sql_function(spark, sf):
    from quarry.functions.registry import register_sql_functions

    register_sql_functions(spark)
    responses(spark, sf).createOrReplaceTempView("quarry_responses")
    return spark.sql("SELECT event_id, score_chess_puzzles(text, truth).score AS score FROM quarry_responses")


# ---- H1: streaming scored append ------------------------------------------------------------------------------------
@register(
    "scored_stream",
    f"""WITH {SQL_RESPONSES}, {SQL_ATTEMPTS}
        SELECT user_id, min(attempt) AS attempt, arg_min(event_id, attempt) AS event_id
        FROM attempts WHERE score = 1.0 GROUP BY user_id""",
)
def q_scored_stream(spark, sf):
    """Attempts (derived from events) land as files in two portions: the first five attempts of every id, then the
    rest. The stream runs over what has landed, stops, and is started again for the second portion, so ids accepted
    by the first run are skipped and the others get their first accepted attempt."""
    from quarry.session import scratch_path
    from quarry.sources import io
    from quarry.streaming.scored_append import run_available

    land, sink, state = (scratch_path(spark, n) for n in ("landing", "sink", "stream-ckpt"))
    a = attempts(spark, sf).select("user_id", "attempt", "event_id", "text", "truth")
    for portion in (F.col("attempt") <= 5, F.col("attempt") > 5):
        a.filter(portion).write.mode("append").parquet(land)
        out = run_available(spark, land, a.schema, sink, state, "user_id", "attempt", "text", "truth", MAX_ATTEMPTS)
    io.remove(spark, land)
    return out.select("user_id", "attempt", "event_id")


# ---- A1 - A10: sources and sinks, round-tripped through the shared scratch folder ------------------------------------
@register(
    "csv_roundtrip",
    f"SELECT doc_id, text, lang, CAST(len({sql_tokens('source')}) AS INTEGER) AS n_tags FROM documents",
)
def q_csv_roundtrip(spark, sf):
    """A10 + A4 + A1: documents (multi-line texts, an array column) converted to headered CSV and read
    back with an explicit schema."""
    from quarry.session import scratch_path
    from quarry.sources import io

    src = scratch_path(spark, "csv-src")
    table(spark, sf, "documents").select("doc_id", "text", "lang", T.tags("source").alias("tags")).write.parquet(src)
    schema = "doc_id bigint, text string, lang string, tags string"
    back = io.convert(spark, src, scratch_path(spark, "csv"), "parquet", "csv", dst_schema=schema, multi_line=True)
    io.remove(spark, src)
    return back.select("doc_id", "text", "lang", F.size(T.parse_list("tags")).cast("int").alias("n_tags"))


@register("json_roundtrip", "SELECT conv_id, turn, role, text FROM conversations")
def q_json_roundtrip(spark, sf):
    """JSON Lines (UTF-8 kept verbatim, null fields kept) and read back with a schema."""
    from quarry.session import scratch_path
    from quarry.sources import io

    path = scratch_path(spark, "json")
    io.write_records(table(spark, sf, "conversations"), path, "json")
    return io.read_records(spark, path, "conv_id bigint, turn bigint, role string, text string", "json")


def _split_roundtrip(spark, sf, fmt, schema, **options):
    """Documents (texts with quotes, braces and newlines, an array column) converted to ``fmt`` and read back in byte
    ranges of 256 KB, with the scanner's state at each range found first."""
    from quarry.session import scratch_path
    from quarry.sources import io

    src = scratch_path(spark, f"{fmt}-src")
    table(spark, sf, "documents").select("doc_id", "text", "lang", T.tags("source").alias("tags")).write.parquet(src)
    back = io.convert(spark, src, scratch_path(spark, fmt), "parquet", fmt, dst_schema=schema, split_bytes=1 << 18, **options)
    io.remove(spark, src)
    return back


@register(
    "json_array_roundtrip",
    f"SELECT doc_id, text, lang, CAST(len({sql_tokens('source')}) AS INTEGER) AS n_tags FROM documents",
)
def q_json_array_roundtrip(spark, sf):
    """A10 + A7: documents as files of one JSON array each, read back in many tasks a file."""
    back = _split_roundtrip(spark, sf, "json_array", "doc_id bigint, text string, lang string, tags array<string>")
    return back.select("doc_id", "text", "lang", F.size("tags").cast("int").alias("n_tags"))


@register(
    "csv_split_roundtrip",
    f"SELECT doc_id, text, lang, CAST(len({sql_tokens('source')}) AS INTEGER) AS n_tags FROM documents",
)
def q_csv_split_roundtrip(spark, sf):
    """A10 + A1: documents as headered CSV whose texts hold newlines, read back in many tasks a file."""
    back = _split_roundtrip(spark, sf, "csv", "doc_id bigint, text string, lang string, tags string", multi_line=True)
    return back.select("doc_id", "text", "lang", F.size(T.parse_list("tags")).cast("int").alias("n_tags"))


@register(
    "parquet_nested_roundtrip",
    """SELECT d.doc_id, 'user' AS role, d.text AS content, d.source AS ground_truth, l.quality
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def q_parquet_nested_roundtrip(spark, sf):
    """Nested RL records written as Parquet and read back; nested fields pruned on read."""
    from quarry.functions.records import to_rl
    from quarry.session import scratch_path
    from quarry.sources import io

    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    path = scratch_path(spark, "rl")
    io.write_records(to_rl(d, "text", "source", {"doc_id": "doc_id", "quality": "quality"}), path, "parquet")
    back = io.read_records(spark, path, fmt="parquet")
    return back.select(F.col("extra_info.doc_id").alias("doc_id"), F.col("prompt")[0]["role"].alias("role"),
                       F.col("prompt")[0]["content"].alias("content"),
                       F.col("reward_model.ground_truth").alias("ground_truth"),
                       F.col("extra_info.quality").alias("quality"))


@register("order_index", f"SELECT o_orderkey, o_custkey, {SQL_ORDER_RANK} AS shuffle_rank FROM orders")
def q_order_index(spark, sf):
    """E1 over a growing table: the orders arrive in three portions of the order index, the last one tiny."""
    from quarry.operators import order_index
    from quarry.session import scratch_path

    path, orders = scratch_path(spark, "order-index"), table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    tiny, half = F.pmod("o_orderkey", F.lit(997)) == 0, F.pmod("o_orderkey", F.lit(2)) == 0
    for gen, portion in enumerate((half & ~tiny, ~half & ~tiny, tiny)):
        order_index.append(orders.filter(portion), path, "o_orderkey", SEED, gen=gen)
    return order_index.ranked(spark, path)


@register(
    "materialized_halves",
    f"""SELECT o_orderkey, CASE WHEN rk <= (SELECT count(*) FROM orders) // 2 THEN 'A' ELSE 'B' END AS half
        FROM (SELECT o_orderkey, {SQL_ORDER_RANK} AS rk FROM orders)""",
)
def q_materialized_halves(spark, sf):
    """The two halves are computed and written once, as the partitions of one output, then read back; a second
    call with the same seed reuses them."""
    from quarry.session import scratch_path
    from quarry.sources import io

    path = io.cache_path(scratch_path(spark, "halves"), "reserve", SEED)
    orders = table(spark, sf, "orders").select("o_orderkey")

    def build():
        return order.split_halves(orders, "o_orderkey", SEED).select("o_orderkey", "half")

    io.materialize_split(spark, build, path, "half", ["A", "B"])
    got = io.materialize_split(spark, build, path, "half", ["A", "B"])  # reused: complete outputs are read back
    return got["A"].withColumn("half", F.lit("A")).unionByName(got["B"].withColumn("half", F.lit("B")))


@register("materialized_by_content", "SELECT lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def q_materialized_by_content(spark, sf):
    """A9 by content: an output named by its plan and its input files; the second call reuses it, another plan does not."""
    from quarry.session import scratch_path
    from quarry.sources import io

    path, source = scratch_path(spark, "by-content"), f"{sf.rstrip('/')}/documents.parquet"

    def build(column="lang"):
        sums = F.count("*").alias("docs"), F.sum("n_chars").cast("bigint").alias("chars")
        return table(spark, sf, "documents").groupBy(column).agg(*sums)

    io.materialize(spark, build, path, inputs=[source])
    io.materialize(spark, lambda: build("source"), path, inputs=[source])
    return io.materialize(spark, build, path, inputs=[source])


# ---- single-operator entries: B19, B20, B24, G1, G3, F6 ------------------------------------------------------------
@register(
    "parse_list",
    f"""SELECT p_partkey, {sql_tokens('p_name')}[1] AS first_tag, CAST(len({sql_tokens('p_name')}) AS INTEGER) AS n_tags
        FROM part""",
)
def q_parse_list(spark, sf):
    """A Python-style list literal (``['small', 'ring']``) held as text, parsed back to an array."""
    p = table(spark, sf, "part")
    literal = F.concat(F.lit("['"), F.array_join(T.tags("p_name"), "', '"), F.lit("']"))
    parsed = T.parse_list(literal)
    return p.select("p_partkey", F.get(parsed, 0).alias("first_tag"), F.size(parsed).cast("int").alias("n_tags"))


@register(
    "plain_json",
    "SELECT doc_id, CAST(to_json({'doc_id': doc_id, 'quality': quality, 'toxic': toxic}) AS VARCHAR) AS record FROM labels",
)
def q_plain_json(spark, sf):
    """Nested values rendered as plain JSON text."""
    lab = table(spark, sf, "labels")
    return lab.select("doc_id", T.to_plain_json(F.struct("doc_id", "quality", "toxic")).alias("record"))


@register(
    "is_blank",
    f"SELECT doc_id, text IS NULL OR NOT regexp_matches(text, '[^{SQL_SPACE[1:]}') AS blank FROM documents",
)
def q_is_blank(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.is_blank("text").alias("blank"))


@register("distinct_keys", "SELECT DISTINCT user_id FROM events")
def q_distinct_keys(spark, sf):
    return joins.distinct_keys(table(spark, sf, "events"), "user_id")


@register("append_batches", "SELECT event_id, event_type, value FROM events")
def q_append_batches(spark, sf):
    """Two result batches (the events before and after the first of the month's 15th day) appended by
    column name; the second batch lists its columns in another order."""
    ev = table(spark, sf, "events")
    first = ev.filter(F.dayofmonth("ts") < 15).select("event_id", "event_type", "value")
    second = ev.filter(F.dayofmonth("ts") >= 15).select("value", "event_id", "event_type")
    return joins.append(first, second)


@register(
    "tag_preview",
    f"SELECT tag, count(*) AS freq FROM ({SQL_TAGS}) GROUP BY tag ORDER BY freq DESC, tag LIMIT 10",
)
def q_tag_preview(spark, sf):
    """bounded preview (first ten) of the descending tag listing."""
    from quarry.operators.order import preview

    return preview(tags.tag_listing_desc(table(spark, sf, "part"), "p_name"), [F.desc("freq"), "tag"], 10)


# ---- rows for A1, A3, A5, B16, B18, B23, B27, D3 ----------------------------------------------------------------------
@register("csv_by_name", "SELECT doc_id, CAST(n_chars AS INTEGER) AS n_chars, source, lang, 'x' || doc_id AS note FROM documents")
def q_csv_by_name(spark, sf):
    """A1: a headered CSV whose columns stand in another order and which holds columns the schema does not name."""
    from quarry.session import scratch_path
    from quarry.sources import io

    path = scratch_path(spark, "csv-by-name")
    d = table(spark, sf, "documents").select("source", F.concat(F.lit("x"), "doc_id").alias("note"), "n_chars", "lang", "doc_id")
    io.write_records(d, path, "csv")
    back = io.read_records(spark, path, "doc_id bigint, n_chars int, source string")
    return back.select("doc_id", "n_chars", "source", "lang", "note")


@register(
    "benchmark_scan",
    """SELECT 'item_' || item_id AS task, text AS fen, CAST(item_id AS VARCHAR) AS answer,
              coalesce(json_extract_string('{"n": "' || length(text) || '", "q": "a, b"}', '$.n'), '') AS n, 'a, b' AS q
       FROM benchmark""",
)
def q_benchmark_scan(spark, sf):
    """A3: a CSV copy of the benchmark with positional columns, multi-line text and a JSON column, then B4 on it."""
    from quarry.session import scratch_path
    from quarry.sources import io

    path = scratch_path(spark, "benchmark-csv")
    meta = F.concat(F.lit('{"n": "'), F.length("text"), F.lit('", "q": "a, b"}'))
    x = F.lit("-")
    landed = table(spark, sf, "benchmark").select(
        x.alias("c0"), F.concat(F.lit("item_"), "item_id").alias("c1"), x.alias("c2"), F.col("text").alias("c3"), x.alias("c4"),
        x.alias("c5"), F.col("item_id").cast("string").alias("c6"), x.alias("c7"), meta.alias("c8"))
    io.write_records(landed, path, "csv")
    back = io.load_benchmark(spark, path, "csv", multi_line=True)
    merged = T.merge_metadata(F.create_map(F.lit("n"), F.lit("none")), "metadata")
    return back.select("task", "fen", "answer", merged["n"].alias("n"), merged["q"].alias("q"))


@register("append_sink", "SELECT event_id, event_type, value FROM events")
def q_append_sink(spark, sf):
    """A5: two result batches appended to one output folder, read back as one table."""
    from quarry.session import scratch_path
    from quarry.sources import io

    path = scratch_path(spark, "append")
    ev = table(spark, sf, "events").select("event_id", "event_type", "value", "ts")
    for part in (F.dayofmonth("ts") < 15, F.dayofmonth("ts") >= 15):
        io.write_records(ev.filter(part).drop("ts"), path, "parquet", mode="append")
    return io.read_records(spark, path, fmt="parquet")


@register("is_correct", f"WITH {SQL_RESPONSES} SELECT event_id, score = 1.0 AS correct FROM scored2")
def q_is_correct(spark, sf):
    return responses(spark, sf).select("event_id", T.is_correct("text", "truth").alias("correct"))


@register("assert_length", "SELECT doc_id, length(text) AS n FROM documents")
def q_assert_length(spark, sf):
    """Texts pass unchanged where none is longer than the stated bound (20,000 words, in driver tables)."""
    d = table(spark, sf, "documents").select("doc_id", T.assert_length("text", 40_000).alias("text"))
    return d.select("doc_id", F.length("text").cast("bigint").alias("n"))


@register(
    "ledger_tokens",
    f"""WITH {SQL_RESPONSES}
        SELECT count(*) AS rows, count(*) FILTER (WHERE score = 1) AS correct, count(*) FILTER (WHERE score = 0) AS wrong,
               round(count(*) FILTER (WHERE score = 1) / count(*), 6) AS correct_share,
               round(count(*) FILTER (WHERE score = 0) / count(*), 6) AS wrong_share, round(sum(cost), 6) AS total_cost,
               CAST(sum({_sql_len('text')}) AS BIGINT) AS total_tokens
        FROM scored2""",
)
def q_ledger_tokens(spark, sf):
    """D3 over a result file: one row per response with its score, cost and token count."""
    r = scored_responses(spark, sf).select(F.col("score").cast("int").alias("correct"), "cost", T.token_count("text").alias("total_tokens"))
    return scoring.ledger(r)


@register(
    "test_record_info",
    """SELECT coalesce(json_extract_string(props, '$.type'), event_type) AS type, CAST(event_id AS VARCHAR) AS fen,
              json_extract_string(props, '$.k') AS k, 'chess' AS ability, CAST(user_id AS VARCHAR) AS ground_truth
       FROM events""",
)
def q_test_record_info(spark, sf):
    """B18 test records with the metadata map, then B23: its named keys spread over the row."""
    from quarry.functions.records import flatten_info, to_test_record

    ev = table(spark, sf, "events")
    rec = to_test_record(ev, F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string"),
                         F.col("event_type"), "props")
    flat = flatten_info(rec, "extra_info", ["type", "fen", "k"])
    return flat.select("type", "fen", "k", "ability", F.col("reward_model.ground_truth").alias("ground_truth"))


@register(
    "info_found",
    """SELECT d.doc_id, lang, source, CAST(n_chars AS BIGINT) AS n_chars, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def q_info_found(spark, sf):
    """B23 without naming keys: records whose info is a JSON object (labels only where a document has them) are spread
    over columns that are found and typed from the data."""
    from quarry.functions.records import spread_info

    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    info = F.to_json(F.struct(*(c for c in d.columns if c not in ("doc_id", "text")))).alias("info")
    return spread_info(d.select("doc_id", info), "info")
