"""Attempts, evaluation summaries and group statistics.

Per-group work is expressed as aggregates (partial on the map side, so a prompt or id holding a third of
all rows is pre-combined before the shuffle) and joined back where row grain is needed; windows are only
used over groups whose size is bounded by design (checkpoints of one stage).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import answer_score, length_flags


def _r6(c: Column) -> Column:
    return F.round(c, 6)


def score_responses(df: DataFrame, text: str, truth: str, out: str = "score", answer: str | None = None) -> DataFrame:
    """B15 applied to a table: adds ``score`` (and ``binary_score``, equal to it for this scorer).

    ``answer`` names a column already holding ``extract_answer(text)``; the score is then derived from it,
    so the answer pattern runs once per row. ``binary_score`` is a copy of the score column, not a second
    evaluation."""
    if answer is None:
        hit = answer_score(text, truth)["score"]
    else:
        hit = F.coalesce((F.col(answer) == F.lower(F.col(truth))).cast("double"), F.lit(0.0))
    return df.withColumn(out, hit).withColumn("binary_score", F.col(out))


# ---- E4 / D3: attempts ------------------------------------------------------------------------------
def first_accepted(attempts: DataFrame, id_col: str, attempt: str = "attempt", score: str = "score",
                   max_attempts: int = 11) -> DataFrame:
    """Per id, the first attempt (lowest number) that scored 1.0 within ``max_attempts``.

    Ids that never succeed within the limit produce no row. ``min_by`` is a partial aggregate.
    """
    others = [c for c in attempts.columns if c not in (id_col,)]
    ok = attempts.filter((F.col(attempt) <= F.lit(max_attempts)) & (F.col(score) == F.lit(1.0)))
    best = ok.groupBy(id_col).agg(F.min_by(F.struct(*others), F.col(attempt)).alias("_a"))
    return best.select(id_col, *[F.col(f"_a.{c}").alias(c) for c in others])


def attempt_ledger(attempts: DataFrame, id_col: str, attempt: str = "attempt", score: str = "score",
                   cost: str = "cost", max_attempts: int = 11) -> DataFrame:
    """D3 (with N4/N5 fixed): per-id outcome folded into one row: ids, accepted, rejected, shares,
    cost of accepted attempts, and cost of every attempt that was made (up to acceptance or the limit)."""
    # an id has at most max_attempts attempts here: they are gathered once, and everything follows from them
    tried = attempts.filter(F.col(attempt) <= F.lit(max_attempts)).groupBy(id_col).agg(
        F.collect_list(F.struct(F.col(attempt).alias("a"), F.col(score).alias("s"), F.col(cost).alias("c"))).alias("_t"))
    accepted = F.array_min(F.transform(F.filter("_t", lambda x: x["s"] == F.lit(1.0)), lambda x: x["a"]))
    tried = tried.select("_t", accepted.alias("_acc"))

    def total(rows: Column) -> Column:  # null if no row has a cost, like sum()
        some = F.filter(F.transform(rows, lambda x: x["c"]), lambda c: c.isNotNull())
        return F.when(F.size(some) > 0, F.aggregate(some, F.lit(0.0), lambda acc, c: acc + c))

    made = F.filter("_t", lambda x: F.col("_acc").isNull() | (x["a"] <= F.col("_acc")))
    per_id = tried.select(
        F.col("_acc").isNotNull().cast("int").alias("_ok"),
        total(F.filter("_t", lambda x: x["a"] == F.col("_acc"))).alias("_acc_cost"),
        total(made).alias("_all_cost"),
        F.size(made).alias("_n"),
    )
    n = F.count("*")
    ok = F.sum("_ok")
    return per_id.agg(
        n.alias("ids"),
        ok.cast("bigint").alias("accepted"),
        (n - ok).cast("bigint").alias("rejected"),
        _r6(F.try_divide(ok, n)).alias("accepted_share"),
        _r6(F.try_divide(n - ok, n)).alias("rejected_share"),
        _r6(F.sum("_acc_cost")).alias("accepted_cost"),
        _r6(F.sum("_all_cost")).alias("total_cost"),
        F.sum("_n").cast("bigint").alias("attempts_made"),
    )


def ledger(df: DataFrame, correct: str = "correct", cost: str = "cost", tokens: str = "total_tokens") -> DataFrame:
    """D3: one row with correct / wrong counts and shares, total cost and total tokens of a result file."""
    n = F.count("*")
    c = F.count_if(F.col(correct) == F.lit(1))
    w = F.count_if(F.col(correct) == F.lit(0))
    return df.agg(
        n.alias("rows"),
        c.alias("correct"),
        w.alias("wrong"),
        _r6(F.try_divide(c, n)).alias("correct_share"),
        _r6(F.try_divide(w, n)).alias("wrong_share"),
        _r6(F.sum(cost)).alias("total_cost"),
        F.sum(tokens).cast("bigint").alias("total_tokens"),
    )


# ---- D4 / D5: evaluation -----------------------------------------------------------------------------
def pass_at_1(df: DataFrame, prompt: str | list[str], sample: str = "sample", score: str = "score",
              text: str = "text", max_tokens: int | None = None) -> DataFrame:
    """Mean score per prompt over its samples, the first sample's text and, with ``max_tokens``,
    that text's token count and clipped flag (N16: length comes from the first sample only)."""
    keys = [prompt] if isinstance(prompt, str) else list(prompt)
    out = df.groupBy(*keys).agg(
        F.count("*").alias("n_samples"),
        _r6(F.avg(score)).alias("pass_at_1"),
        F.min_by(F.col(text), F.col(sample)).alias("first_text"),
    )
    if max_tokens is not None:
        lf = length_flags("first_text", max_tokens)
        out = out.withColumn("num_tokens", lf["num_tokens"]).withColumn("clipped", lf["clipped"])
    return out


def eval_summary(df: DataFrame, by: list[str] | None = None, score: str = "pass_at_1",
                 num_tokens: str = "num_tokens", clipped: str = "clipped") -> DataFrame:
    """Accuracy, score sum, mean length, clipped count and share; empty input gives nulls."""
    n = F.count("*")
    clip = F.sum(F.col(clipped).cast("int"))
    aggs = [
        n.alias("prompts"),
        _r6(F.avg(score)).alias("accuracy"),
        _r6(F.sum(score)).alias("score_sum"),
        _r6(F.avg(num_tokens)).alias("mean_length"),
        F.coalesce(clip, F.lit(0)).cast("bigint").alias("clipped"),
        _r6(F.try_divide(clip, n)).alias("clipped_share"),
    ]
    return df.groupBy(*(by or [])).agg(*aggs)


# ---- D7: status counters -----------------------------------------------------------------------------
def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("rows"))


# ---- D8 / D10: checkpoints -----------------------------------------------------------------------------
def checkpoint_accuracy(df: DataFrame, stage: str, step: str, score: str = "score") -> DataFrame:
    """Accuracy per (stage, step) from scored evaluation rows."""
    return df.groupBy(stage, step).agg(F.count("*").alias("rows"), _r6(F.avg(score)).alias("accuracy"))


def best_checkpoint(evals: DataFrame, stage: str = "stage", step: str = "step",
                    accuracy: str = "accuracy") -> DataFrame:
    """Per stage the step with the highest accuracy; a tie goes to the lowest step."""
    order = F.struct(F.col(accuracy), (-F.col(step)).alias("_neg"))
    return evals.groupBy(stage).agg(
        F.max_by(F.col(step), order).alias("best_step"),
        F.max(accuracy).alias("best_accuracy"),
    )


def eval_curve(evals: DataFrame, stage: str = "stage", step: str = "step", accuracy: str = "accuracy") -> DataFrame:
    """Accuracy per step with the running best so far. One stage's checkpoints form one window
    partition; their number is the number of saved checkpoints, bounded by the training schedule."""
    w = Window.partitionBy(stage).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return evals.withColumn("running_best", F.max(accuracy).over(w))


# ---- D9 / E5: group statistics ---------------------------------------------------------------------------
def informative_groups(df: DataFrame, prompt: str, score: str = "score") -> DataFrame:
    """Prompts whose sampled scores are not all equal (min < max)."""
    return df.groupBy(prompt).agg(F.min(score).alias("_lo"), F.max(score).alias("_hi")).filter(
        F.col("_lo") < F.col("_hi")
    ).select(prompt)


def filter_groups(df: DataFrame, prompt: str, score: str = "score") -> DataFrame:
    """Keep rows of informative prompts only (aggregate, then semi join back)."""
    return df.join(informative_groups(df, prompt, score), prompt, "left_semi")


def group_advantage(df: DataFrame, prompt: str, score: str = "score", eps: float = 1e-6,
                    out: str = "advantage") -> DataFrame:
    """E5: ``(score - group mean) / (group sample std + eps)``; a one-row group has std 0.

    Statistics come from a partial aggregate and are joined back, so a huge group never has to sit in
    one window partition; AQE splits the hot key's join partition.
    """
    stats = df.groupBy(prompt).agg(F.avg(score).alias("_mean"), F.stddev_samp(score).alias("_std"))
    adv = (F.col(score) - F.col("_mean")) / (F.coalesce(F.col("_std"), F.lit(0.0)) + F.lit(eps))
    return df.join(stats, prompt).withColumn(out, adv).drop("_mean", "_std")
