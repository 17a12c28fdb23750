"""Membership joins and set operations.

The reference's only joins are hash-set membership tests. Here they are semi / anti joins. No side is
hinted for broadcast: the done set and the test set grow with the data, so AQE measures the built side
at runtime and broadcasts it only when it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``;
otherwise it plans a shuffled join and splits skewed partitions (a hot key on the probe side).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import ws_tokens
from quarry.operators.order import first_n


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """G1: the key set (a partial aggregate, so repeated keys collapse map-side)."""
    return df.select(*keys).distinct()


def difference_by_key(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other``; row-preserving, unlike ``EXCEPT``."""
    keys = [on] if isinstance(on, str) else on
    return df.join(distinct_keys(other, *keys), keys, "left_anti")


def append(df: DataFrame, other: DataFrame) -> DataFrame:
    """Bag union by column name (later frames may lack columns; they are null)."""
    return df.unionByName(other, allowMissingColumns=True)


def pending(
    df: DataFrame,
    done: DataFrame,
    on: str = "PuzzleId",
    order_cols: list[str] | None = None,
    max_rows: int | None = None,
    dense: bool = False,
) -> DataFrame:
    """Rows of the target prefix whose id is not in the done set (resume). ``dense``: the order
    column is a gap-free 1-based rank, so the prefix is a filter (see ``first_n``)."""
    target = first_n(df, order_cols or [on], max_rows, dense)
    return difference_by_key(target, done, on)


def exclude_overlap(df: DataFrame, test: DataFrame, key: str, test_key: str | None = None) -> DataFrame:
    """Drop rows whose key appears in the test keys. Rows with a null key are kept."""
    tk = test.select(F.col(test_key or key).alias(key)).distinct()
    return df.join(tk, key, "left_anti")


def flag_overlap(df: DataFrame, test: DataFrame, key: str, test_key: str | None = None,
                 out: str = "overlaps") -> DataFrame:
    """Keep every row and flag membership; distinct keys keep the join from multiplying rows."""
    tk = test.select(F.col(test_key or key).alias(key)).distinct().withColumn("_hit", F.lit(True))
    return df.join(tk, key, "left").withColumn(out, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


# ---- passage grain -----------------------------------------------------------------------------------------------
def lines(df: DataFrame, text_col: str, sep: str = "\n") -> DataFrame:
    """Distinct non-empty lines of every text (column ``_seg``); repeats inside a text collapse before the explode."""
    return df.select("*", F.explode(F.array_distinct(F.split(F.col(text_col), sep))).alias("_seg")).filter("_seg <> ''")


def line_overlap_ids(df: DataFrame, id_col: str, text_col: str, test: DataFrame, test_text: str, sep: str = "\n") -> DataFrame:
    """Line rule: ids of rows that share any non-empty line with the test texts."""
    test_lines = lines(test.select(test_text), test_text, sep).select("_seg").distinct()
    return lines(df.select(id_col, text_col), text_col, sep).join(test_lines, "_seg", "left_semi").select(id_col).distinct()


def _fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate of a frame is within the session's broadcast threshold (no job runs)."""
    plan = df._jdf.queryExecution().optimizedPlan()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(plan.stats().sizeInBytes())) <= limit


def passage_anchors(texts: DataFrame, text_col: str, passages: DataFrame, text: str = "_passage") -> DataFrame:
    """The rarest token of every passage: ``(_passage, _short, _token)``.

    A passage may start and end inside a token of a text, but its inner tokens are tokens of every text that holds it.
    So any inner token may stand for the passage, and the one that occurs least often in the texts does (ties: the
    smallest); one that no text holds takes the passage out of the search. ``_short``: a passage of at most two tokens
    has no inner token and offers all of its own. The texts' tokens are counted where they are read: only those of the
    passages reach the shuffle, as partial counts.
    """
    tokens = ws_tokens(text)
    offered = passages.select(F.col(text).alias("_passage"), tokens.alias("_tokens")).filter(F.size("_tokens") > 0)
    offered = offered.withColumn("_short", F.size("_tokens") <= 2)
    inner = F.when(F.col("_short"), F.col("_tokens")).otherwise(F.slice("_tokens", 2, F.greatest(F.size("_tokens") - 2, F.lit(0))))
    offered = offered.select("_passage", "_short", F.explode(F.array_distinct(inner)).alias("_token"))
    asked = offered.select("_token").distinct()
    if _fits_broadcast(passages):
        asked = F.broadcast(asked)
    held = texts.select(F.explode(ws_tokens(text_col)).alias("_token")).join(asked, "_token", "left_semi")
    counts = held.groupBy("_token").agg(F.count("*").alias("_n"))
    rare = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_token").alias("t"))
    best = offered.join(counts, "_token", "left").groupBy("_passage", "_short").agg(F.min(rare).alias("_rare"))
    return best.filter("_rare.n > 0").select("_passage", "_short", F.col("_rare.t").alias("_token"))


def passage_ids(df: DataFrame, id_col: str, text_col: str, test: DataFrame, test_text: str) -> DataFrame:
    """Passage rule: ids of rows whose text contains a whole test text as a substring.

    Every text looks up its distinct tokens among the passages' anchors (``passage_anchors``), and only a text that
    holds the anchor of a passage is searched for that passage. A passage of at most two tokens is matched at token
    grain: the text must hold its tokens as consecutive tokens. Null and empty passages match nothing.

    If the test texts fit the session's broadcast threshold, a text is searched right where its tokens are looked up,
    in one pass and without a shuffle of texts. Otherwise the lookup carries ids, and the texts join the found pairs.
    """
    passages = test.select(F.col(test_text).alias("_passage")).filter("_passage <> ''").distinct()
    texts = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    anchors = passage_anchors(texts, "_text", passages)
    token = F.explode(F.array_distinct(ws_tokens("_text"))).alias("_token")
    if _fits_broadcast(passages):
        found = texts.select("_id", "_text", token).join(F.broadcast(anchors), "_token")
    else:
        found = texts.join(texts.select("_id", token).join(anchors, "_token").select("_id", "_passage", "_short").distinct(), "_id")
    spaced = lambda c: F.concat(F.lit(" "), F.array_join(ws_tokens(c), " "), F.lit(" "))
    holds = F.when(F.col("_short"), spaced("_text").contains(spaced("_passage"))).otherwise(F.col("_text").contains(F.col("_passage")))
    return found.filter(holds).select(F.col("_id").alias(id_col)).distinct()


RULES = {"line": line_overlap_ids, "passage": passage_ids}


def exclude_passages(df: DataFrame, id_col: str, text_col: str, test: DataFrame, test_text: str, rule: str = "passage") -> DataFrame:
    """Drop every row that overlaps the test set by the named rule. Rows with a null id are kept."""
    return df.join(RULES[rule](df, id_col, text_col, test, test_text), id_col, "left_anti")


def flag_passages(df: DataFrame, id_col: str, text_col: str, test: DataFrame, test_text: str, rule: str = "line",
                  out: str = "overlaps") -> DataFrame:
    """J3 at passage grain: every row with a boolean overlap flag."""
    hits = RULES[rule](df, id_col, text_col, test, test_text).withColumn("_hit", F.lit(True))
    return df.join(hits, id_col, "left").withColumn(out, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")
