"""Evaluation over growing checkpoints as stored, mergeable state.

Re-evaluating every checkpoint whenever one lands costs more with each of them. Here a landing of scored responses is
folded once into one row for each prompt (samples, score sum, first sample) and kept; rows of several landings merge by
addition. Only the groups that a landing touches are summarised again, from stored state alone: the responses of
earlier landings are never read. Summaries, the best checkpoint and the curve come from one small row for each group.

Layout: ``state/landing=<n>``, ordered by the group columns so that row groups can be skipped, and ``summary/landing=<n>``. A landing writes its own
two folders, so a repeated landing replaces itself; folders without their ``_SUCCESS`` marker do not count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import length_flags
from quarry.operators.scoring import eval_summary
from quarry.sources.io import complete_folders


def prompt_state(scored: DataFrame, keys: list[str], sample: str = "sample", score: str = "score", text: str = "text") -> DataFrame:
    """D4 as mergeable state: ``n``, ``score_sum`` and the first sample of every key (a partial aggregate)."""
    first = F.min_by(F.struct(F.col(sample).alias("sample"), F.col(text).alias("text")), F.col(sample))
    return scored.groupBy(*keys).agg(F.count("*").alias("n"), F.count(score).alias("n_scored"), F.sum(score).alias("score_sum"), first.alias("first"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of several landings as one; the order of the landings does not matter."""
    return states.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("n_scored").alias("n_scored"), F.sum("score_sum").alias("score_sum"),
                                     F.min_by("first", "first.sample").alias("first"))


def pass_at_1_of(state: DataFrame, max_tokens: int) -> DataFrame:
    """The columns of ``scoring.pass_at_1`` from merged state."""
    keys = [c for c in state.columns if c not in ("n", "n_scored", "score_sum", "first")]
    flags = length_flags("first_text", max_tokens)
    out = state.select(*keys, F.col("n").alias("n_samples"), F.round(F.try_divide("score_sum", "n_scored"), 6).alias("pass_at_1"),
                       F.col("first.text").alias("first_text"))
    return out.withColumn("num_tokens", flags["num_tokens"]).withColumn("clipped", flags["clipped"])


def _landings(spark: SparkSession, path: str, kind: str) -> list[tuple[int, str]]:
    """(landing, folder) of the complete folders, in order of the landings."""
    found = complete_folders(spark, f"{path.rstrip('/')}/{kind}", r"landing=(\d+)")
    return sorted((int(m[1]), p) for m, p in found)


def states(spark: SparkSession, path: str) -> DataFrame:
    """The stored state of all landings."""
    found = _landings(spark, path, "state")
    if not found:
        raise ValueError(f"nothing has landed at {path}")
    return spark.read.parquet(*(p for _, p in found))


def land(scored: DataFrame, path: str, landing: int, by: list[str], prompt: str = "prompt_id", sample: str = "sample", score: str = "score",
         text: str = "text", max_tokens: int = 1024) -> None:
    """Store the state of a landing of scored responses and summarise the groups (``by``) that it touches.

    Rows without a group value or prompt are groups and prompts of their own; an empty landing changes nothing.
    """
    spark, own, keys = scored.sparkSession, f"{path.rstrip('/')}/state/landing={landing}", [*by, prompt]
    state = prompt_state(scored, keys, sample, score, text)
    state.sortWithinPartitions(*by).write.mode("overwrite").parquet(own)
    touched = spark.read.parquet(own).select(*(F.col(c).alias(f"_{c}") for c in by)).distinct()  # one row for each group
    stored = states(spark, path)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
    merged = merge_states(stored.join(touched, same, "left_semi"), keys)
    eval_summary(pass_at_1_of(merged, max_tokens), by).write.mode("overwrite").parquet(f"{path.rstrip('/')}/summary/landing={landing}")


def summaries(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """D5 for every group: the summary of the last landing that touched it."""
    found = _landings(spark, path, "summary")
    if not found:
        raise ValueError(f"nothing has landed at {path}")
    every = reduce(DataFrame.unionByName, [spark.read.parquet(p).withColumn("_landing", F.lit(n)) for n, p in found])
    rest = [c for c in every.columns if c not in (*by, "_landing")]
    last = every.groupBy(*by).agg(F.max_by(F.struct(*rest), "_landing").alias("_s"))
    return last.select(*by, "_s.*")
