"""Tag frequency and dataset profiles.

All of these are one explode plus one aggregate: Spark runs a partial (map-side) count before the
shuffle, so a tag held by a third of all rows costs one row per map task, not a hot reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import tags as tag_array


def _tag_col(df: DataFrame, col: str, split: bool) -> DataFrame:
    arr = tag_array(col) if split else F.coalesce(F.col(col), F.array().cast("array<string>"))
    return df.select(F.explode(arr).alias("tag"))


def _counts(df: DataFrame, col: str, split: bool) -> DataFrame:
    return _tag_col(df, col, split).groupBy("tag").agg(F.count("*").alias("freq"))


def tag_frequency(df: DataFrame, col: str, split: bool = True) -> DataFrame:
    """``(tag, freq)`` counting every occurrence (a tag repeated in one row counts twice).

    Ordered ascending by ``(freq, tag)``; the tag tie-break is ours (the reference leaves ties open).
    """
    return _counts(df, col, split).orderBy("freq", "tag")


def rarest_tags(df: DataFrame, col: str, k: int, split: bool = True) -> DataFrame:
    """the ``k`` rarest tags with their 0-based ``tag_rank`` (TakeOrderedAndProject, at most k rows)."""
    top = _counts(df, col, split).orderBy("freq", "tag").limit(k)
    # At most k rows: a window over them is a bounded single-task step.
    return top.withColumn("tag_rank", (F.row_number().over(Window.orderBy("freq", "tag")) - 1).cast("int"))


def tag_listing_desc(df: DataFrame, col: str, split: bool = True) -> DataFrame:
    """every tag with its count, by descending frequency (ties by tag): a range-partitioned sort, so
    a large vocabulary is ordered in parallel."""
    return _counts(df, col, split).orderBy(F.desc("freq"), "tag")


def profile(df: DataFrame, tags_col: str, num_col: str, split: bool = True) -> DataFrame:
    """One row ``rows, distinct_tags, min_value, max_value, mean_value`` from a single aggregate.

    Rows are exploded to one row per tag (``posexplode_outer`` keeps tag-less rows once); row statistics
    read only each row's first position, and the distinct tag count is a partial distinct aggregate.
    """
    arr = tag_array(tags_col) if split else F.col(tags_col)
    x = df.select(F.posexplode_outer(arr).alias("_p", "tag"), F.col(num_col).alias("_v"))
    first = F.coalesce(F.col("_p"), F.lit(0)) == F.lit(0)
    return x.agg(
        F.count_if(first).alias("rows"),
        F.min(F.when(first, F.col("_v"))).alias("min_value"),
        F.max(F.when(first, F.col("_v"))).alias("max_value"),
        F.round(F.avg(F.when(first, F.col("_v"))), 6).alias("mean_value"),
        F.count_distinct("tag").alias("distinct_tags"),
    )
