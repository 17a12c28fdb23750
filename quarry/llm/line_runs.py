"""Line deduplication over levelled sorted runs of line hashes (operator 7, DataFrame functions only).

A run is a table of (line hash, number of documents), bucketed and sorted by the hash; all runs of a corpus have the same
buckets, so a batch joins them bucket by bucket without an exchange. A batch of documents is merge-joined with the
runs; a hash that they hold in at least ``min_docs`` documents already is settled and left out (the anti-join), and what is
left becomes a run of level 0. When a level has ``fanout`` runs they are compacted into one run of the next level by adding
their counts. A batch therefore costs its own lines plus logarithmically many rewrites, and memory holds no hash set.

``dedup_lines`` deals a corpus to ``batches`` batches, more than the fanout, so that levels are built. Its texts are read once
for their hashes, which are counted by batch and land as one table with the runs' buckets.

Line key: the line with ASCII white space stripped at both ends and A-Z lower-cased. Keys are hashed to 128 bits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCHES, FANOUT = 5, 4
BUCKET_BYTES, MAX_BUCKETS = 256 << 20, 100_000  # text whose line hashes share a bucket; Spark's limit


def lines_of(text: Column) -> Column:
    """Lines of a text split at \\n; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def line_hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), key, F.lit("line")).alias("b"))


def _hashes(text: Column) -> Column:
    """Hash per line, null for a line whose key is empty."""
    return F.transform(F.transform(lines_of(text), line_key), lambda k: F.when(F.length(k) > 0, line_hash(k)))


class LineRuns:
    """The levelled runs of one corpus. ``add`` takes batches in any order; ``frequent`` reads what is settled."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT, buckets: int = 8) -> None:
        self.spark, self.min_docs, self.fanout, self.buckets = spark, min_docs, fanout, buckets
        self.root, self.levels, self.compactions = scratch_path(spark, "line-runs"), [[]], 0

    def land(self, rows: DataFrame, dealt: bool, order: list[str]) -> str:
        """Write rows with columns a and b as a bucketed, sorted table and return its name; ``dealt``: they are in the
        buckets already."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows = rows if dealt else rows.repartition(self.buckets, "a", "b")
        rows.write.format("parquet").bucketBy(self.buckets, "a", "b").sortBy(*order).option("path", f"{self.root}/{name}").saveAsTable(name)
        return name

    def drop(self, tables: list[str]) -> None:
        for name in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _merged(self, runs: list[str]) -> DataFrame:
        """The counts of several runs, added. Their files are read and dealt anew: Spark 4.1.2 takes a union of bucketed
        tables for one that is in their buckets, and adds nothing up."""
        rows = self.spark.read.schema("a long, b long, n long").parquet(*(f"{self.root}/{r}" for r in runs)).repartition(self.buckets, "a", "b")
        return rows.groupBy("a", "b").agg(F.sum("n").alias("n"))

    def unsettled(self, new: DataFrame) -> DataFrame:
        """The hashes (a, b, n) of ``new`` that the runs do not hold in ``min_docs`` documents."""
        total = F.lit(0).cast("long")
        for i, run in enumerate(r for level in self.levels for r in level):
            new = new.join(self.spark.table(run).withColumnRenamed("n", f"n{i}").hint("merge"), ["a", "b"], "left")
            total = total + F.coalesce(f"n{i}", F.lit(0))
        return new.where(total < self.min_docs).select("a", "b", "n")

    def add(self, new: DataFrame, dealt: bool = False) -> None:
        """Add one batch of counted hashes (a, b, n); ``dealt``: they are in the runs' buckets already."""
        new = new if dealt else new.repartition(self.buckets, "a", "b")
        self.levels[0].append(self.land(self.unsettled(new), True, ["a", "b"]))
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self.land(self._merged(level), True, ["a", "b"]))
                self.drop(level)
                level.clear()
                self.compactions += 1

    def frequent(self) -> DataFrame:
        """Hashes found in at least min_docs documents, written once; the runs are dropped."""
        runs, path = [r for level in self.levels for r in level], f"{self.root}/frequent"
        if not runs:
            return self.spark.createDataFrame([], "a long, b long")
        self._merged(runs).where(F.col("n") >= self.min_docs).select("a", "b").write.parquet(path)
        self.drop(runs)
        self.levels = [[]]
        return self.spark.read.schema("a long, b long").parquet(path)


def count_hashes(docs: DataFrame, text: str = "text", *by: Column) -> DataFrame:
    """Line hashes (a, b) with the number n of the rows that hold them, for each value of ``by``."""
    rows = docs.select(*by, F.explode(F.array_distinct(_hashes(F.col(text)))).alias("h")).where("h is not null")
    keys = [c for c in rows.columns if c != "h"]
    return rows.select(*keys, "h.a", "h.b").groupBy(*keys, "a", "b").agg(F.count("*").alias("n"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, text: str = "text", key: str = "doc_id", batches: int = BATCHES,
                fanout: int = FANOUT) -> DataFrame:
    """Drop every line whose key stands in at least ``min_docs`` rows; the other lines stay, joined by \\n.

    Returns all columns of the input, with the text replaced, and n_lines, n_dropped (any input columns of these
    names are replaced). Each row is a document: repeated rows, also of one id, count each for themselves. A null or
    empty text is one empty line; lines with an empty key are never dropped; a null id is an id like any other. The
    kept text is never null. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    volume = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(-(-volume // BUCKET_BYTES), spark.sparkContext.defaultParallelism))
    runs = LineRuns(spark, min_docs, fanout, buckets)
    batch = F.pmod(F.xxhash64(key), F.lit(batches)).cast("int").alias("batch")
    hashes = runs.land(count_hashes(docs, text, batch), False, ["batch", "a", "b"])
    for b in range(batches):
        runs.add(spark.table(hashes).where(F.col("batch") == b).select("a", "b", "n"), dealt=True)
    runs.drop([hashes])
    frequent = runs.frequent()
    src, rid = F.col(text), F.xxhash64(text)
    found = (docs.select(F.col(key).alias("id"), rid.alias("t"), F.posexplode(_hashes(src)).alias("pos", "h"))
             .where("h is not null").select("id", "t", "pos", F.col("h.a").alias("a"), F.col("h.b").alias("b"))
             .join(frequent, ["a", "b"], "left_semi")
             .groupBy("id", "t").agg(F.collect_set("pos").alias("gone")))
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    base = docs.select(F.struct(*rest).alias("row"), F.col(key).alias("id"), rid.alias("t"))
    joined = base.alias("l").join(found.alias("r"), F.expr("l.id <=> r.id and l.t = r.t"), "left").select("l.row", "r.gone")
    lines = lines_of(F.col(f"row.{text}"))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone")))
    kept = F.when(F.col("gone").isNull(), F.coalesce(F.col(f"row.{text}"), F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n"))
    out = [kept.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in rest]
    return joined.select(*out, F.size(lines).cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))
