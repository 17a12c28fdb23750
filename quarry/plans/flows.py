"""End-to-end flows of the curation run (survey section 3), composed from the operators.

Each flow returns DataFrames; writing is left to the caller (``quarry.sources.io``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import is_blank
from quarry.operators import joins


def classify(
    df: DataFrame,
    id_col: str,
    text_col: str,
    done: DataFrame,
    test: DataFrame,
    test_text: str = "text",
    out: str = "status",
) -> DataFrame:
    """``(id, status)`` per row: ``invalid`` (blank text, or no row in ``done``) is decided before ``excluded`` (shares a
    line with the test set, or contains a whole test text), the rest is ``kept`` (N12). Texts are judged in the scan;
    the joins that decide the status carry ids and flags only."""
    rows = df.select(id_col, is_blank(text_col).alias("_blank"))
    hits = joins.line_overlap_ids(df, id_col, text_col, test, test_text).unionByName(
        joins.passage_ids(df, id_col, text_col, test, test_text))
    flagged = joins.flag_overlap(rows, done.select(id_col), id_col, out="_labelled")
    flagged = joins.flag_overlap(flagged, hits, id_col, out="_overlap")
    status = (
        F.when(F.col("_blank") | ~F.col("_labelled"), F.lit("invalid"))
        .when(F.col("_overlap"), F.lit("excluded"))
        .otherwise(F.lit("kept"))
    )
    return flagged.select(id_col, status.alias(out))


# ---- 3.1 selection -------------------------------------------------------------------------------------------------
def select_flow(puzzles: DataFrame, id_col: str = "PuzzleId", tags_col: str = "Themes", seed: int = 42,
                n_sft: int = 800, k_sft: int = 50, n_rl: int = 800, k_rl: int = 50) -> dict[str, DataFrame]:
    """Shuffle and halve the puzzles, then pick a rare-tag-balanced subset of each half and shuffle it.

    Returns ``sft`` and ``rl`` (selected rows with ``theme``, ``theme_rank``, ``shuffle_rank``) and their
    D2 profiles. The source order inside a half is its E1 rank, as in the reference.
    """
    from quarry.operators import order, quota, tags
    from quarry.session import cut_lineage

    # Both selections read the ranked halves several times (tag counts, candidates, join back); they are
    # written once to the shared checkpoint folder instead of re-running the rank's shuffle per read, as
    # the reference caches its halves on disk.
    ranked = cut_lineage(order.split_halves(puzzles, id_col, seed).withColumnRenamed("_rank", "src_pos"))
    out = {}
    for name, half, n, k in (("sft", "A", n_sft, k_sft), ("rl", "B", n_rl, k_rl)):
        part = ranked.filter(F.col("half") == half).drop("half")
        sel = quota.quota_select(part, id_col, tags_col, "src_pos", n, k)
        out[name] = order.shuffle_rank(sel, id_col, seed)
        out[name + "_profile"] = tags.profile(out[name], tags_col, "Rating") if "Rating" in puzzles.columns else None
    return out


@dataclass(frozen=True)
class Positions:
    """Landed tables of what is known about positions, keyed by position: ``legal_moves`` (fen, legal_moves) and ``after`` (fen,
    move, fen_after). Repeated keys are one entry. A position that a given table lacks has no legal moves or no position after
    the move (null)."""

    legal_moves: DataFrame | None = None
    after: DataFrame | None = None


def _with_legal_moves(df: DataFrame, fen: str, landed: Positions | None = None) -> DataFrame:
    """``legal_moves`` of the position: the column the caller supplies, else the landed table's, else computed row by row."""
    from quarry.operators import board

    if "legal_moves" in df.columns:
        return df
    if landed is None or landed.legal_moves is None:
        return board.legal_moves(df, fen, out="legal_moves")
    known = landed.legal_moves.groupBy(F.col("fen").alias("_fen")).agg(F.any_value("legal_moves", True).alias("legal_moves"))
    return df.join(known, df[fen] == known["_fen"], "left").drop("_fen")


def _after_move(df: DataFrame, fen: str, move, out: str, landed: Positions | None = None) -> DataFrame:
    """The position after a move, from the landed table if there is one, else computed row by row."""
    from quarry.operators import board

    if landed is None or landed.after is None:
        return board.apply_moves(df, fen, move, out=out)
    known = landed.after.groupBy(F.col("fen").alias("_fen"), F.col("move").alias("_move")).agg(F.any_value("fen_after", True).alias(out))
    moved = df.withColumn("_asked", move)
    return moved.join(known, (moved[fen] == known["_fen"]) & (moved["_asked"] == known["_move"]), "left").drop("_fen", "_move", "_asked")


# ---- 3.2 distillation --------------------------------------------------------------------------------------------
def teacher_rows(selected: DataFrame, done: DataFrame | None = None, id_col: str = "PuzzleId",
                 max_rows: int | None = None, landed: Positions | None = None) -> DataFrame:
    """Pending puzzles with the position after the opponent's move, the answer and the teacher prompt.

    The target is the first ``max_rows`` rows of the selection in its saved order, i.e. the final shuffle
    (``shuffle_rank``, a gap-free rank, so the prefix is a filter); rows of ``done`` are then skipped."""
    from quarry.functions import chess as C
    from quarry.functions.records import teacher_prompt
    from quarry.operators import joins, order

    ranked = "shuffle_rank" in selected.columns
    order_cols = ["shuffle_rank"] if ranked else [id_col]
    if done is not None:
        rows = joins.pending(selected, done, id_col, order_cols, max_rows, dense=ranked)
    else:
        rows = order.first_n(selected, order_cols, max_rows, dense=ranked)
    mv = C.parse_moves("Moves")
    rows = _after_move(rows, "FEN", mv["opponent"], "fen_after", landed).withColumn("best_move", mv["answer"])
    rows = _with_legal_moves(rows, "fen_after", landed)
    prompt = teacher_prompt("fen_after", C.board_text("fen_after"), C.piece_inventory("fen_after"),
                            C.side_to_move("fen_after"), mv["opponent"], "best_move", "Rating", "Themes",
                            "legal_moves", "Moves")
    return rows.withColumn("teacher_prompt", prompt)


def accept_flow(rows: DataFrame, attempts: DataFrame, id_col: str = "PuzzleId", max_attempts: int = 11):
    """Score landed teacher attempts, keep each puzzle's first correct one, join it to its row.

    ``attempts``: ``id, attempt, content, reasoning, total_tokens, prompt_tokens, completion_tokens, cost``.
    Returns ``(distilled, ledger)``.
    """
    from quarry.functions.text import answer_score
    from quarry.operators import scoring

    truth = rows.select(id_col, "best_move")
    scored = attempts.join(truth, id_col).withColumn("score", answer_score("content", "best_move")["score"])
    first = scoring.first_accepted(scored.drop("best_move"), id_col, "attempt", "score", max_attempts)
    distilled = rows.join(first.withColumnRenamed("content", "cot"), id_col).withColumn("correct", F.lit(1))
    return distilled, scoring.attempt_ledger(scored, id_col, "attempt", "score", "cost", max_attempts)


# ---- 3.3 formatting ----------------------------------------------------------------------------------------------
def format_flow(distilled: DataFrame, test_keys: DataFrame, require_correct: bool = False,
                rl_rows: DataFrame | None = None, landed: Positions | None = None):
    """Stage 2: SFT records from the distilled rows and RL records from the RL selection.

    SFT: a row without a position or reasoning text is ``invalid`` (checked before overlap, N12), a row
    whose position key is a test key is ``excluded``, the rest is ``kept``. RL: the position after the
    opponent's move and the answer move are derived from ``FEN`` and ``Moves`` of ``rl_rows`` (the RL
    half of the selection; the distilled rows when omitted); a row without them is ``invalid`` (N10),
    then test positions are ``excluded``.

    ``test_keys``: one column ``key`` of position keys (first four fields) of the test set.
    Returns ``(sft, rl, status_counts)``; the counts are ``(dataset, status, rows)``.
    """
    from quarry.functions import chess as C
    from quarry.functions.records import student_prompt, to_rl, to_sft
    from quarry.functions.text import prefix_key, tags
    from quarry.operators import joins

    def classify_rows(df: DataFrame, fen: str, invalid) -> DataFrame:
        flagged = joins.flag_overlap(df.withColumn("key", prefix_key(fen)).withColumn("_invalid", invalid), test_keys, "key",
                                     out="_overlap")
        status = (F.when(F.col("_invalid"), F.lit("invalid")).when(F.col("_overlap"), F.lit("excluded"))
                  .otherwise(F.lit("kept")))
        return flagged.withColumn("status", status).drop("_overlap", "_invalid")

    sft_rows = classify_rows(distilled, "fen_after", F.col("fen_after").isNull() | is_blank("cot"))
    kept = sft_rows.filter(F.col("status") == "kept")
    if require_correct:
        kept = kept.filter(F.col("correct") == 1)
    kept = _with_legal_moves(kept, "fen_after", landed)
    sft = to_sft(kept, student_prompt("fen_after", C.piece_inventory("fen_after"), "legal_moves"), "cot")

    mv = C.parse_moves("Moves")
    src = distilled if rl_rows is None else rl_rows
    src = src.select(*(c for c in ("PuzzleId", "FEN", "Moves", "Rating", "Themes", "legal_moves") if c in src.columns))
    src = _after_move(src, "FEN", mv["opponent"], "_rl_fen", landed).withColumn("_truth", mv["answer"])
    rl_status = classify_rows(src, "_rl_fen", F.col("_rl_fen").isNull() | F.col("_truth").isNull())
    rl_kept = _with_legal_moves(rl_status.filter(F.col("status") == "kept"), "_rl_fen", landed)
    rl = to_rl(rl_kept, student_prompt("_rl_fen", C.piece_inventory("_rl_fen"), "legal_moves"), "_truth",
               {"fen": "_rl_fen", "puzzle_id": "PuzzleId", "rating": "Rating", "themes": tags("Themes")})

    counts = (sft_rows.select(F.lit("sft").alias("dataset"), "status")
              .unionByName(rl_status.select(F.lit("rl").alias("dataset"), "status"))
              .groupBy("dataset", "status").agg(F.count("*").alias("rows")))
    return sft, rl, counts


def build_test_set(bench: DataFrame, landed: Positions | None = None) -> DataFrame:
    """Benchmark rows ``task, fen, answer, metadata`` -> test records (type = last ``_`` segment of task;
    metadata keys merged over fen/type, metadata wins)."""
    from quarry.functions import chess as C
    from quarry.functions.records import student_prompt, to_test_record
    from quarry.functions.text import last_segment

    withmoves = _with_legal_moves(bench, "fen", landed)
    prompt = student_prompt("fen", C.piece_inventory("fen"), "legal_moves")
    return to_test_record(withmoves, prompt, "answer", "fen", last_segment("task"), "metadata")


def test_keys_of(test_records: DataFrame) -> DataFrame:
    """Position keys of test records (``extra_info['fen']``, first four fields), distinct."""
    from quarry.functions.text import prefix_key

    return test_records.select(prefix_key(F.col("extra_info")["fen"]).alias("key")).distinct()


# ---- 3.4 evaluation ------------------------------------------------------------------------------------------------
def evaluate_flow(responses: DataFrame, test_records: DataFrame, max_tokens: int = 1024,
                  by: list[str] | None = None, info_keys: list[str] | None = None):
    """Score sampled responses against their test records, average per prompt, and summarise.

    ``responses``: ``prompt_id, sample, text`` (+ ``stage, step`` for checkpoints); ``test_records`` carry
    ``prompt_id``. Every test record counts: one without a response (for any of the ``by`` groups that occur) scores 0
    with a null output of length 0. Returns ``(rows, summary)``; rows are the evaluation records ``input, output, gts,
    score, num_tokens`` + the info keys: the ``info_keys`` of a map (without them the map stays), all fields of a struct. ``by`` may
    name columns of the responses and info keys.
    """
    from quarry.functions.records import flatten_info
    from quarry.functions.text import answer_score
    from quarry.operators import scoring

    gts = test_records.select("prompt_id", F.col("reward_model.ground_truth").alias("gts"),
                              F.col("prompt")[0]["content"].alias("input"), "extra_info")
    own = [c for c in (by or []) if c in responses.columns]
    keys = own + ["prompt_id"]
    scored = responses.join(gts.select("prompt_id", "gts"), "prompt_id")
    scored = scored.withColumn("score", answer_score("text", "gts")["score"])
    per = scoring.pass_at_1(scored, keys, "sample", "score", "text", max_tokens)
    asked = gts
    if own:  # each group of responses is an evaluation of the whole test set; the groups are few (checkpoints)
        groups = responses.select(*own).distinct().agg(F.collect_list(F.struct(*own))).scalar()
        asked = gts.select("*", F.explode(groups).alias("_g")).select(*gts.columns, *(f"_g.{c}" for c in own))
    rows = asked.join(per, keys, "left").select(
        *own, "prompt_id", "input", F.col("first_text").alias("output"), "gts",
        F.coalesce("pass_at_1", F.lit(0.0)).alias("score"), F.coalesce("num_tokens", F.lit(0)).alias("num_tokens"),
        F.coalesce("clipped", F.lit(False)).alias("clipped"), "extra_info",
    )
    rows = flatten_info(rows, "extra_info", info_keys)
    summary = scoring.eval_summary(rows, by, "score", "num_tokens", "clipped")
    return rows, summary


def checkpoint_report(responses: DataFrame, test_records: DataFrame, max_tokens: int = 1024):
    """Evaluation of several checkpoints at once: ``responses`` carry ``stage`` and ``step``.

    Returns ``(summary, curve, best)``: per-checkpoint summaries (D5), the accuracy curve with the running
    best per stage (D10), and the best step per stage, ties to the lowest step (D8).
    """
    from quarry.operators import scoring

    _, summary = evaluate_flow(responses, test_records, max_tokens, by=["stage", "step"])
    acc = summary.select("stage", "step", "accuracy")
    return summary, scoring.eval_curve(acc), scoring.best_checkpoint(acc)
