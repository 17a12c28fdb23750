"""Resumable scored append (H1).

New attempt files landing in a folder are scored and, per id, the first correct attempt within the
limit is appended to the sink once, surviving restarts:

``readStream`` (schema'd files) -> score -> ``foreachBatch``: first accepted per id within the batch,
anti join against what *other* batches already accepted, overwrite this batch's own folder.

The sink is the state (as in the reference, where the output file is the done set), kept as levelled runs: a batch
writes its own folder ``batch_id=<n>``; ``FAN`` neighbouring folders of one level are merged into a folder
``batch_id=<lo>-<hi>`` of the next, so there are at most ``FAN - 1`` folders for each level, plus those of the last
merge, which the next batch removes. A merged folder is ordered by a hash bucket of the id, in files of bounded size, and a
batch reads only the row groups of the buckets its ids fall in. Merging takes batches before the running one only, and a folder counts once it has its
``_SUCCESS`` marker, so a merge that broke off is done again.

Idempotence: a replayed batch rewrites exactly its own folder, and its done set excludes that folder, so a replay never
anti-joins away its own rows; one that a merged folder holds already is skipped. First-correct is by attempt number
within a batch and by arrival across batches. Read the sink with ``accepted_rows``: plain reads of the folder may see a
batch and its merged copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.functions.text import answer_score
from quarry.operators.scoring import first_accepted
from quarry.sources.io import complete_folders, remove

BUCKETS = 1024  # of a merged folder
FAN = 4  # folders of one level that are merged
FILE_BYTES = 128 << 20  # a merged folder is dealt over files of about this size


def _bucket(id_col: str):
    return F.pmod(F.xxhash64(id_col), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True, order=True)
class Run:
    """A complete folder of the sink: the batches lo to hi."""

    lo: int
    hi: int
    path: str

    @property
    def level(self) -> int:
        n, level = self.hi - self.lo + 1, 0
        while n >= FAN:
            n, level = n // FAN, level + 1
        return level

    def covers(self, other: Run) -> bool:
        return self.lo <= other.lo and other.hi <= self.hi and self.path != other.path


def committed(spark: SparkSession, sink: str) -> list[Run]:
    """All complete folders, superseded ones too."""
    found = complete_folders(spark, sink, r"batch_id=(\d+)(?:-(\d+))?")
    return sorted(Run(int(m[1]), int(m[2] or m[1]), p) for m, p in found)


def live(runs: list[Run]) -> list[Run]:
    """The folders that no other covers."""
    return [r for r in runs if not any(o.covers(r) for o in runs)]


def read_runs(spark: SparkSession, runs: list[Run], schema: T.StructType | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The rows of some folders; of the merged ones only the row groups of the given buckets. A schema keeps the files
    unopened until the rows are read."""
    schema = schema if schema is not None else spark.read.parquet(runs[0].path).drop("bucket").schema
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])).parquet(*[r.path for r in runs])
    if buckets is not None:  # a batch's own folder has no buckets
        rows = rows.filter(F.col("bucket").isNull() | F.col("bucket").isin(buckets))
    return rows.drop("bucket")


def compact(spark: SparkSession, sink: str, id_col: str, before: int) -> list[Run]:
    """Remove what earlier merges superseded, merge neighbours of one level among the batches below ``before``, and
    return the live folders."""
    runs = committed(spark, sink)
    now = live(runs)
    for r in runs:
        if r not in now:
            remove(spark, r.path)
    while True:
        old = [r for r in now if r.hi < before]
        group = next((g for g in (old[i : i + FAN] for i in range(len(old) - FAN + 1))
                      if len({r.level for r in g}) == 1 and all(a.hi + 1 == b.lo for a, b in zip(g, g[1:]))), None)
        if group is None:
            return now
        path = f"{sink.rstrip('/')}/batch_id={group[0].lo}-{group[-1].hi}"
        files = -(-sum(_folder_bytes(spark, r.path) for r in group) // FILE_BYTES)
        rows = read_runs(spark, group).withColumn("bucket", _bucket(id_col))
        rows = rows.repartitionByRange(files, "bucket", F.xxhash64(id_col)).sortWithinPartitions("bucket")
        rows.write.mode("overwrite").parquet(path)
        now = live([*now, Run(group[0].lo, group[-1].hi, path)])


def _folder_bytes(spark: SparkSession, path: str) -> int:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()


def _accept_batch(spark: SparkSession, sink: str, id_col: str, attempt: str, max_attempts: int):
    def run(batch: DataFrame, batch_id: int) -> None:
        runs = compact(spark, sink, id_col, batch_id)
        if any(r.lo <= batch_id <= r.hi and r.hi > r.lo for r in runs):
            return  # a replay of a batch that is merged already
        done = [r for r in runs if r.hi != batch_id]
        accepted = first_accepted(batch, id_col, attempt, "score", max_attempts).persist()
        try:
            new = accepted
            if done:
                buckets = None
                if any(r.hi > r.lo for r in done):
                    buckets = [r[0] for r in accepted.select(_bucket(id_col)).distinct().collect()]  # at most BUCKETS
                kept = read_runs(spark, done, accepted.schema, buckets).select(id_col)
                new = accepted.join(kept.distinct(), id_col, "left_anti")
            new.hint("rebalance").write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")
        finally:
            accepted.unpersist()

    return run


def accepted_rows(spark: SparkSession, sink: str) -> DataFrame:
    """Every accepted row once."""
    return read_runs(spark, live(committed(spark, sink)))


def scored_append(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    id_col: str,
    attempt: str = "attempt",
    text: str = "text",
    truth: str = "truth",
    max_attempts: int = 11,
    fmt: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what has landed and stops."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    s = answer_score(text, truth)
    scored = stream.withColumn("score", s["score"])
    writer = scored.writeStream.foreachBatch(_accept_batch(spark, sink, id_col, attempt, max_attempts)).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_available(spark: SparkSession, *args, **kwargs) -> DataFrame:
    """Run ``scored_append`` over everything landed so far, wait for it, and return the sink's rows."""
    q = scored_append(spark, *args, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return accepted_rows(spark, args[2] if len(args) > 2 else kwargs["sink"])
