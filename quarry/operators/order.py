"""Deterministic order, exact splits, batches and samples.

The reference shuffles with a seeded numpy permutation, which cannot be reproduced outside numpy and
depends on row order. Here a row's place is a keyed hash: ``md5("<id>:<seed>")``, ties broken by the id
and then by a hash of the whole row. The order therefore does not depend on file layout, partitioning or
executor count, and it can be recomputed by any engine that has md5 (DuckDB does).

A global ``row_number()`` without a partition would pull every row into one task. Instead the hash's
leading hex digits name a bucket; buckets are contiguous ranges of the order, so a rank is
``rows in earlier buckets + row_number within the bucket``. The number of digits follows the number of rows, the
prefix sum over the buckets runs in two levels, and the windows run one bucket per task in parallel.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(id_col, seed: int) -> Column:
    """E1 order key: lower-case hex md5 of ``"<id>:<seed>"``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))


ROWS_PER_BUCKET = 1 << 16
HOT_ROWS = 1 << 20


def _bucket_digits(rows: int, per_bucket: int) -> int:
    """Leading hex digits that cut ``rows`` into buckets of about ``per_bucket`` to a sixteenth of it."""
    return max(1, math.ceil(math.log(max(rows / per_bucket, 1), 16)))


def _offsets(counts: DataFrame, seg: list[str]) -> DataFrame:
    """Rows before each segment, as a prefix sum in two levels: over blocks of 4,096 buckets, then inside each block."""
    block = F.floor(F.col(seg[0]) / F.lit(4096))
    counts = counts.withColumn("_k", block)
    inside = Window.partitionBy("_k").orderBy(*seg).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.groupBy("_k").agg(F.sum("_n").alias("_kn"))  # one row for 4,096 buckets
    prior = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_k", F.coalesce(F.sum("_kn").over(prior), F.lit(0)).alias("_ks"))
    return counts.join(starts, "_k").select(
        *seg, (F.col("_ks") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_off"))


def shuffle_rank(
    df: DataFrame,
    id_col: str,
    seed: int = 42,
    out: str = "shuffle_rank",
    keep_total: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add a 1-based exact global rank ``out`` in keyed-hash order.

    The order is that of the id's keyed hash, the id, and a hash of the whole row; equal rows are interchangeable. It
    depends on nothing else: ``rows_per_bucket`` and ``hot_rows`` size the tasks and never change a rank.
    ``keep_total`` names an optional column carrying the total row count (used by E2 / E6).

    Buckets are ranges of the order, named by as many leading digits of the hash as the number of rows calls for.
    Their counts are written once. A bucket of more than ``hot_rows`` rows holds a hot id (the hash spreads distinct
    ids evenly). The rows of such a bucket go to segments: one for each gap between hot ids, and for each hot id
    several, which are ranges of the row hash. Equal rows of a hot id collapse to one row with a count before that
    and are expanded, in parts of bounded size, when they are ranked. So no window task holds a hot id or a hot row.
    """
    from quarry.session import cut_lineage

    total = df.count()
    d = min(_bucket_digits(total, rows_per_bucket), 15)
    cols = df.columns
    # Rows identical in id and hash are told apart by a hash of the whole row; truly identical rows are
    # interchangeable, so their relative order cannot change the result.
    keyed = df.select("*", shuffle_key(id_col, seed).alias("_h"), F.xxhash64(*[F.col(c) for c in cols]).alias("_t"))
    keyed = keyed.withColumn("_b", F.conv(F.substring("_h", 1, d), 16, 10).cast("bigint"))

    counts = cut_lineage(keyed.groupBy("_b").agg(F.count("*").alias("_n")))
    big = counts.filter(F.col("_n") > F.lit(hot_rows)).select("_b")
    within = ["_h", id_col, "_t"]
    if big.isEmpty():
        result = _ranked(keyed, cols, _offsets(counts, ["_b"]), ["_b"], within)
    else:
        hot = keyed.join(big, "_b", "left_semi").groupBy("_b", "_h").agg(F.count("*").alias("_c")).filter(
            F.col("_c") > F.lit(hot_rows))
        # per bucket its hot hashes with their number of segments: at most N / hot_rows entries in all
        hot = cut_lineage(hot.groupBy("_b").agg(F.sort_array(F.collect_list(F.struct(
            "_h", F.ceil(F.col("_c") / F.lit(rows_per_bucket)).cast("int").alias("m")))).alias("_hot")))
        cold = keyed.join(hot.select("_b"), "_b", "left_anti")
        marked = keyed.join(hot, "_b")
        here = F.filter("_hot", lambda x: x["_h"] == F.col("_h"))
        before = F.size(F.filter("_hot", lambda x: x["_h"] < F.col("_h")))
        gap = (F.lit(2) * before + F.size(here)).cast("int")
        parts = F.when(F.size(here) > 0, F.get(here, 0)["m"]).otherwise(F.lit(1))
        # the signed row hash, moved to [0, 1): ranges of it are ranges of the order
        place = F.col("_t") / F.lit(2.0**64) + F.lit(0.5)
        part = F.least(F.floor(place * parts), parts - 1).cast("int")
        same = [F.col(c) for c in (*cols, "_h", "_t", "_b")]
        marked = marked.select(*same, gap.alias("_g"), part.alias("_s")).groupBy(*cols, "_h", "_t", "_b", "_g", "_s").agg(
            F.count("*").alias("_copies"))
        marked = cut_lineage(marked)  # written once: counts and ranks read it
        seg = ["_b", "_g", "_s"]
        inner = marked.groupBy(*seg).agg(F.sum("_copies").alias("_n"))
        # a hot bucket's segments stand where the bucket stands; other buckets are one segment
        all_counts = cut_lineage(inner.unionByName(counts.join(hot.select("_b"), "_b", "left_anti").select(
            "_b", F.lit(0).alias("_g"), F.lit(0).alias("_s"), "_n")))
        cold = cold.withColumn("_g", F.lit(0)).withColumn("_s", F.lit(0))
        offsets = _offsets(all_counts, seg)
        result = _ranked(cold, cols, offsets, seg, within).unionByName(_ranked(marked, cols, offsets, seg, within, "_copies"))
    sel = [F.col(c) for c in cols] + [F.col("_rank").cast("bigint").alias(out)]
    if keep_total:
        sel.append(F.lit(total).cast("bigint").alias(keep_total))
    return result.select(*sel)


COPIES = 4096  # copies expanded together


def _ranked(rows: DataFrame, keep: list[str], offsets: DataFrame, seg: list[str], within: list[str],
            copies: str | None = None) -> DataFrame:
    """Columns ``keep`` with ``_rank``: rows before their segment plus their place in it. With ``copies``, a row stands for that
    many equal ones and is expanded to them, parts of a hot row by different tasks."""
    order = Window.partitionBy(*seg).orderBy(*within)
    if copies is None:
        placed = rows.withColumn("_place", F.row_number().over(order)).join(offsets, seg)
        return placed.select(*keep, (F.col("_off") + F.col("_place")).alias("_rank"))
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_place", F.coalesce(F.sum(copies).over(ahead), F.lit(0))).join(offsets, seg)
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / F.lit(COPIES)))).alias("_part")
    parts = placed.select("*", part).repartition("_t", "_part")
    last = F.least(F.col(copies), (F.col("_part") + 1) * F.lit(COPIES)) - 1
    each = parts.select("*", F.explode(F.sequence(F.col("_part") * F.lit(COPIES), last)).alias("_i"))
    return each.select(*keep, (F.col("_off") + F.col("_place") + F.col("_i") + 1).alias("_rank"))


def split_halves(df: DataFrame, id_col: str, seed: int = 42, out: str = "half") -> DataFrame:
    """First floor(N/2) rows of the E1 order are half ``A``, the rest ``B``."""
    r = shuffle_rank(df, id_col, seed, out="_rank", keep_total="_total")
    half = F.when(F.col("_rank") <= F.floor(F.col("_total") / 2), F.lit("A")).otherwise(F.lit("B"))
    return r.withColumn(out, half).drop("_total")


def halves(df: DataFrame, id_col: str, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The two disjoint halves as separate frames (complementary filters of one plan)."""
    s = split_halves(df, id_col, seed)
    return s.filter(F.col("half") == "A").drop("half"), s.filter(F.col("half") == "B").drop("half")


def assign_batches(
    df: DataFrame, id_col: str, batch_size: int, seed: int = 42, drop_last: bool = False, out: str = "batch"
) -> DataFrame:
    """Consecutive batches of ``batch_size`` over the E1 order; a partial last batch is kept unless
    ``drop_last``. Adds ``shuffle_rank`` and ``out`` (0-based)."""
    r = shuffle_rank(df, id_col, seed, keep_total="_total")
    r = r.withColumn(out, F.floor((F.col("shuffle_rank") - 1) / F.lit(batch_size)).cast("bigint"))
    if drop_last:
        r = r.filter(F.col(out) < F.floor(F.col("_total") / F.lit(batch_size)))
    return r.drop("_total")


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42, out: str = "sample_rank") -> DataFrame:
    """The first ``n`` rows of the E1 order (TakeOrderedAndProject keeps n rows per task)."""
    cols = df.columns
    top = (
        df.select("*", shuffle_key(id_col, seed).alias("_h"), F.xxhash64(*[F.col(c) for c in cols]).alias("_t"))
        .orderBy("_h", id_col, "_t")
        .limit(n)
    )
    # n rows only: numbering them in one task is bounded by the sample size.
    w = Window.orderBy("_h", id_col, "_t")
    return top.select(*cols, F.row_number().over(w).cast("bigint").alias(out))


def first_n(df: DataFrame, order_cols: list[str], n: int | None, dense: bool = False) -> DataFrame:
    """the first ``n`` rows by an explicit order column (all rows when ``n`` is None).

    File order is not stable in Spark, so the order must be a column. ``dense=True`` states that the single
    order column is a 1-based rank without gaps (as ``shuffle_rank`` is): the prefix is then the filter
    ``rank <= n``, which needs no sort, runs in every task and reaches the scan. Otherwise a top-n
    (TakeOrderedAndProject) keeps n rows per map task and merges them in one task, meant for small n.
    """
    if n is None:
        return df
    if dense:
        if len(order_cols) != 1:
            raise ValueError("dense prefix needs exactly one rank column")
        return df.filter(F.col(order_cols[0]) <= F.lit(n))
    return df.orderBy(*order_cols).limit(n)


def first_n_per_group(df: DataFrame, group_cols: list[str], order_cols: list, n: int, out: str = "rn") -> DataFrame:
    """first ``n`` rows of every group. The literal bound lets Spark insert a partial
    WindowGroupLimit before the shuffle, so each map task ships at most n rows per group."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= F.lit(n))


def preview(df: DataFrame, order_cols: list[str], n: int = 10) -> DataFrame:
    """bounded preview of a listing."""
    return df.orderBy(*order_cols).limit(n)
