"""The done set of a resumable run as a bucketed table (J1, G2 at scale).

A done set grows with the run, and resuming against plain files shuffles and sorts it on every start. Here the done ids
land in a table that is bucketed and sorted by the id; each landing adds at most one file for each bucket. The anti join
then exchanges only the rows to be resumed, into the table's buckets; the done side is read bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.order import first_n

ROWS_PER_BUCKET = 1 << 22


def buckets_for(rows: int) -> int:
    """Buckets for an expected number of done ids (a power of two; growth to a few times that is no harm)."""
    return 1 << max(3, (max(rows - 1, 0) // ROWS_PER_BUCKET).bit_length())


def open_done(spark: SparkSession, table: str, path: str, key: str, kind: str, buckets: int) -> None:
    """Register the done table at ``path`` (empty or landed by an earlier session) under a name."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (`{key}` {kind}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")


def land_done(done: DataFrame, table: str, key: str, buckets: int) -> None:
    """Add ids to the table: those that it does not hold yet, each once; null ids are no ids. A landing that broke off
    may be repeated."""
    spark = done.sparkSession
    new = done.select(key).filter(F.col(key).isNotNull()).distinct()
    new = new.join(spark.table(table), key, "left_anti").repartition(buckets, key)
    path = spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Location'").first()["data_type"]
    new.write.mode("append").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def pending_landed(df: DataFrame, table: str, on: str = "PuzzleId", order_cols: list[str] | None = None,
                   max_rows: int | None = None, dense: bool = False) -> DataFrame:
    """J1 against a landed done table: rows of the target prefix whose id it does not hold; null ids are pending."""
    target = first_n(df, order_cols or [on], max_rows, dense)
    return target.join(df.sparkSession.table(table).hint("merge"), on, "left_anti")
