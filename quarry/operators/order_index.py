"""The E1 order as a persisted index (E1, E2, E6 over a growing table).

A global rank shuffles and sorts the whole table, and would do so again for every portion that arrives. The order's
buckets are ranges of the keyed hash, so a rank is the rows of earlier buckets plus the place inside the bucket. The index
stores every row with its bucket and place, and a manifest with the row count of each bucket. An append places only the
buckets that the new rows fall in; the ranks of all other rows move by their bucket's offset, which is computed from the
manifest when the index is read. Their files are neither read nor written.

Layout: ``data/gen=<g>`` holds the buckets placed by append g, ``manifest/gen=<g>`` names for every bucket its rows and the
append that placed it last. The newest manifest with a ``_SUCCESS`` marker counts, so an append that broke off has no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import order
from quarry.session import cut_lineage
from quarry.sources.io import complete_folders


def generation(spark: SparkSession, path: str) -> int | None:
    """The last complete append, or None."""
    return max((int(m[1]) for m, _ in complete_folders(spark, f"{path.rstrip('/')}/manifest", r"gen=(\d+)")), default=None)


def _manifest(spark: SparkSession, path: str, gen: int) -> DataFrame:
    """``_b, _n, gen`` of every bucket, with the ``digits`` that name a bucket."""
    return spark.read.parquet(f"{path.rstrip('/')}/manifest/gen={gen}")


def _live(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """The placed rows that the manifest points at: columns of the table, ``_b``, ``_place`` and ``gen``."""
    root = f"{path.rstrip('/')}/data"
    data = spark.read.option("basePath", root).parquet(*(p for _, p in complete_folders(spark, root, r"gen=(\d+)")))
    return data.join(manifest.select("_b", F.col("gen").cast("int").alias("gen")), ["_b", "gen"], "left_semi")


def _bucket(id_col: str, seed: int, digits: int) -> Column:
    return F.conv(F.substring(order.shuffle_key(id_col, seed), 1, digits), 16, 10).cast("bigint")


def append(df: DataFrame, path: str, id_col: str, seed: int = 42, rows_per_bucket: int = order.ROWS_PER_BUCKET, gen: int | None = None) -> None:
    """Add rows to the index at ``path`` (the first append makes it and fixes the bucket width and the columns).

    ``gen`` names the append (0, 1, ...): one that is complete already is not done again. Ids may repeat and be null; a
    bucket with a hot id is placed in parallel, as ``order.shuffle_rank`` does it.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    last = generation(spark, path)
    if gen is not None and last is not None and gen <= last:
        return
    if last is None:
        rows, old, digits = df, None, min(order._bucket_digits(df.count(), rows_per_bucket), 15)
    else:
        old = _manifest(spark, path, last)
        digits = old.first()["digits"] if not old.isEmpty() else 1
        touched = df.select(F.coalesce(_bucket(id_col, seed, digits), F.lit(-1)).alias("_b")).distinct()
        kept = _live(spark, path, old.join(touched, "_b", "left_semi"))
        rows = kept.select(df.columns).unionByName(df)
    now = 0 if last is None else last + 1
    ranked = order.shuffle_rank(rows, id_col, seed, out="_r").withColumn("_b", F.coalesce(_bucket(id_col, seed, digits), F.lit(-1)))
    ranked = cut_lineage(ranked)  # counts and places read it
    counts = ranked.groupBy("_b").agg(F.count("*").alias("_n"))
    placed = ranked.join(order._offsets(counts, ["_b"]), "_b").select(*df.columns, "_b", (F.col("_r") - F.col("_off")).alias("_place"))
    placed.repartitionByRange("_b", "_place").sortWithinPartitions("_b").write.mode("overwrite").parquet(f"{root}/data/gen={now}")
    counts = counts.withColumn("gen", F.lit(now)).withColumn("digits", F.lit(digits))
    if old is not None:
        counts = old.join(counts.select("_b"), "_b", "left_anti").unionByName(counts)
    counts.write.mode("overwrite").parquet(f"{root}/manifest/gen={now}")


def ranked(spark: SparkSession, path: str, out: str = "shuffle_rank") -> DataFrame:
    """Every row of the index with its exact global rank, equal to ``order.shuffle_rank`` over all rows."""
    last = generation(spark, path)
    if last is None:
        raise ValueError(f"no index at {path}")
    manifest = _manifest(spark, path, last)
    offsets = order._offsets(manifest.select("_b", "_n"), ["_b"])
    rows = _live(spark, path, manifest).join(offsets, "_b")
    cols = [c for c in rows.columns if c not in ("_b", "_place", "_off", "gen")]
    return rows.select(*cols, (F.col("_off") + F.col("_place")).cast("bigint").alias(out))
