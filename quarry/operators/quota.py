"""Rare-tag-balanced quota selection (E3) and its shortfall report.

Semantics: the ``k`` rarest tags are visited rarest first; each tag scans the rows that carry it in
source order and takes a row when its id has not been taken yet, until it has ``n``. A taken row is
credited only to the tag that took it, and an id is taken at most once.

Set-based plan (no per-tag pass over the data):

1. explode to ``(id, tag_rank, src_pos)`` for the k tags only (broadcast of k rows), keeping the first
   row of each ``(id, tag)``; a partial aggregate, so hot ids collapse map-side;
2. prune: when tag ``r`` (0-based) is visited at most ``n*r`` ids are gone, so only its first
   ``n*(r+1)`` candidates can matter. Done as a tree of top-N windows over salt groups (fan-in 16), so a
   popular tag is cut down in parallel and no window task holds more than ``16*n*(r+1)`` rows. What
   survives is at most ``n*k*(k+1)/2`` pairs, whatever the input size;
3. rounds on the pruned pairs: every id proposes to its rarest remaining tag, each tag keeps its first
   ``n`` proposals by ``src_pos``, rejected ids move on. All ids rank tags the same way, so tag ``r`` is
   final after round ``r+1`` and the loop ends within ``k`` rounds. Each round is checkpointed to the
   shared checkpoint folder to cut lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import tags as tag_array
from quarry.operators.tags import rarest_tags
from quarry.session import cut_lineage

def _candidates(df: DataFrame, id_col: str, tags_col: str, order_col: str, themes: DataFrame, split: bool):
    arr = tag_array(tags_col) if split else F.col(tags_col)
    pairs = df.select(
        F.col(id_col).alias("_id"),
        F.col(order_col).alias("src_pos"),
        F.explode(F.array_distinct(arr)).alias("tag"),
    )
    # themes holds at most k rows: a proven bound, so the broadcast is safe.
    pairs = pairs.join(F.broadcast(themes.select("tag", "tag_rank")), "tag")
    return pairs.groupBy("_id", "tag_rank").agg(F.min("src_pos").alias("src_pos"))


# Fan-in of the pruning tree: each level merges this many salt groups of the level below.
FAN_IN = 16


def _levels(max_freq: int, cap: int) -> int:
    """Salt levels so that the first level's groups hold about FAN_IN * cap rows of the largest tag."""
    levels, groups = 0, max(1, max_freq // max(1, FAN_IN * cap))
    while groups > 1:
        groups = -(-groups // FAN_IN)
        levels += 1
    return levels


def _prune(cand: DataFrame, n: int, levels: int) -> DataFrame:
    """Keep the first ``n*(r+1)`` candidates of each tag ``r`` by ``src_pos``.

    A tree of top-N windows: level ``l`` groups rows by ``(tag, hash(id) mod FAN_IN^l)``, from the most
    salt groups down to one group per tag. Groups of level ``l-1`` are unions of FAN_IN groups of level
    ``l``, so every window task holds at most ``FAN_IN * n*(r+1)`` rows whatever the tag's size.
    """
    cap = F.lit(n) * (F.col("tag_rank") + F.lit(1))
    cur = cand.withColumn("_hid", F.xxhash64("_id"))
    for level in range(levels, -1, -1):
        keys = ["tag_rank"] if level == 0 else ["tag_rank", F.pmod(F.col("_hid"), F.lit(FAN_IN ** level))]
        w = Window.partitionBy(*keys).orderBy("src_pos", "_id")
        cur = cur.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= cap).drop("_r")
    return cur.select("_id", "tag_rank", "src_pos")


def _assign(pruned: DataFrame, n: int, k: int) -> tuple[DataFrame, int]:
    """Round-based fixpoint on the pruned pairs; returns ``(_id, tag_rank, src_pos)`` and rounds used."""
    first = F.min(F.struct("tag_rank", "src_pos")).alias("_p")
    cur = pruned.groupBy("_id").agg(first).select("_id", "_p.tag_rank", "_p.src_pos")
    w = Window.partitionBy("tag_rank").orderBy("src_pos", "_id")
    rounds = 0
    while True:
        rounds += 1
        ranked = cut_lineage(cur.withColumn("_rn", F.row_number().over(w)))
        rejected = ranked.filter(F.col("_rn") > F.lit(n)).select("_id", F.col("tag_rank").alias("_from"))
        if rejected.isEmpty():
            return ranked.select("_id", "tag_rank", "src_pos"), rounds
        if rounds > k:  # cannot happen (see module doc); guards against a broken invariant
            raise RuntimeError("quota selection did not converge within k rounds")
        moved = (
            rejected.join(pruned, "_id")
            .filter(F.col("tag_rank") > F.col("_from"))
            .groupBy("_id")
            .agg(first)
            .select("_id", "_p.tag_rank", "_p.src_pos")
        )
        cur = ranked.filter(F.col("_rn") <= F.lit(n)).select("_id", "tag_rank", "src_pos").unionByName(moved)


def _themes(df: DataFrame, tags_col: str, k: int, split: bool) -> DataFrame:
    """The k rarest tags as a local table (k rows at most, a proven bound): counted once, used by every step."""
    found = [(r["tag"], int(r["freq"]), int(r["tag_rank"])) for r in rarest_tags(df, tags_col, k, split).collect()]
    return df.sparkSession.createDataFrame(found, "tag string, freq bigint, tag_rank int")


def quota_assignments(
    df: DataFrame, id_col: str, tags_col: str, order_col: str, n: int, k: int, split: bool = True,
    themes: DataFrame | None = None,
) -> DataFrame:
    """E3 core: ``(id, tag, tag_rank, src_pos)`` of the taken rows."""
    themes = _themes(df, tags_col, k, split) if themes is None else themes
    largest = themes.agg(F.coalesce(F.max("freq"), F.lit(0))).first()[0]  # of at most k local rows
    levels = _levels(int(largest), n * k)
    pruned = cut_lineage(_prune(_candidates(df, id_col, tags_col, order_col, themes, split), n, levels))
    taken, _ = _assign(pruned, n, k)
    return taken.join(F.broadcast(themes.select("tag", "tag_rank")), "tag_rank").select(
        F.col("_id").alias(id_col), "tag", "tag_rank", "src_pos"
    )


def quota_select(
    df: DataFrame, id_col: str, tags_col: str, order_col: str, n: int, k: int, split: bool = True
) -> DataFrame:
    """The taken rows themselves, with ``theme`` and ``theme_rank`` added (N20: sort by
    ``theme_rank, <order_col>`` to get the reference's pre-shuffle order).

    Rows that repeat both id and order value are one candidate: the one taken is the one with the smallest hash of
    the whole row, so a quota of n never yields more than n rows. The selection (at most n*k rows) is joined back
    without a hint: AQE measures its bytes.
    """
    sel = quota_assignments(df, id_col, tags_col, order_col, n, k, split).select(
        F.col(id_col).alias("_sid"), F.col("src_pos").alias("_spos"), F.col("tag").alias("theme"),
        F.col("tag_rank").alias("theme_rank"),
    )
    cond = (F.col(id_col) == F.col("_sid")) & (F.col(order_col) == F.col("_spos"))
    # only a row that carries the tag can have been taken for it
    arr = tag_array(tags_col) if split else F.col(tags_col)
    rows = df.join(sel, cond).filter(F.array_contains(arr, F.col("theme")))
    # min_by is a partial aggregate over the selected rows; a repeated row collapses map-side
    whole = F.struct(*[F.col(c) for c in df.columns])
    one = rows.groupBy("_sid", "theme", "theme_rank").agg(F.min_by(whole, F.xxhash64(whole)).alias("_row"))
    return one.select("_row.*", "theme", "theme_rank")


def quota_shortfall(df: DataFrame, id_col: str, tags_col: str, order_col: str, n: int, k: int,
                    split: bool = True, only_short: bool = True) -> DataFrame:
    """``(theme, theme_rank, found, shortfall)`` for tags that got fewer than ``n`` rows."""
    themes = _themes(df, tags_col, k, split)
    found = quota_assignments(df, id_col, tags_col, order_col, n, k, split, themes).groupBy("tag").agg(
        F.count("*").alias("found")
    )
    rep = themes.join(found, "tag", "left").select(
        F.col("tag").alias("theme"),
        F.col("tag_rank").alias("theme_rank"),
        F.coalesce(F.col("found"), F.lit(0)).cast("bigint").alias("found"),
    ).withColumn("shortfall", (F.lit(n) - F.col("found")).cast("bigint"))
    return rep.filter(F.col("shortfall") > 0) if only_short else rep
