"""Splittable reading of text files whose records may hold the record separator (A1, A10).

A quoted CSV field may hold newlines, and a JSON array is one long value, so a reader that starts in the middle of such a
file cannot tell where it is; Spark's own readers take the whole file in one task. Here a file is cut into byte ranges
like any text file, in three steps:

1. every range (a split of Spark's text source) reports what it does to the scanner's state: whether it holds an odd
   number of quotes, and how much deeper its brackets lead, for both states it could start in;
2. prefix sums over the ranges of a file give the state at the start of each range;
3. every range is read again from that state and yields its records. A record that reaches over the end of a range
   comes as fragments, at most two for each range; only these are shuffled, and joined in file order.

The file is read three times (step 3 once for whole records, once for fragments); no step needs a whole file in one
task, and the records are parsed by Spark's ``from_csv`` and ``from_json``. The scanning itself is a few vector
operations on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_RANGES = 1 << 24  # a range costs 21 bytes of broadcast: 350 MB at most (2 PB in ranges of 128 MB)
PIECE = "file long, start long, body string"


def _pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """The text between separators, with a hash of its file and the start of its byte range, in file order within a
    range."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", sep).text(path).select(
        F.xxhash64(meta["file_path"]).alias("file"), meta["file_block_start"].alias("start"), F.col("value").alias("body"))


def pinned_session(spark: SparkSession, split_bytes: int | None = None) -> SparkSession:
    """A session with the settings of ``spark`` whose split sizes do not depend on the executors that happen to be
    there, so that both passes cut a file alike; ``split_bytes`` replaces the largest split of the settings."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    parts = spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.files.minPartitionNum", str(parts))
    if split_bytes:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    return own


def _runs(batch: pa.RecordBatch, sep: int) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """((file, start), bytes with their separators) of the consecutive rows of each range."""
    file, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    body = batch.column(2).cast(pa.large_string())
    _, off, buf = body.buffers()
    offsets = np.frombuffer(off, np.int64)[body.offset : body.offset + len(body) + 1] if len(body) else np.zeros(1, np.int64)
    text = np.frombuffer(buf, np.uint8) if buf else np.zeros(0, np.uint8)
    turn = np.flatnonzero((file[1:] != file[:-1]) | (start[1:] != start[:-1])) + 1
    bounds = np.concatenate(([0], turn, [len(body)])) if len(body) else np.zeros(0, int)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        at = offsets[lo : hi + 1] - offsets[lo]
        data = np.empty(int(at[-1]) + hi - lo, np.uint8)
        ends = at[1:] + np.arange(hi - lo)
        inside = np.ones(len(data), bool)
        inside[ends] = False
        data[ends] = sep
        data[inside] = text[offsets[lo] : offsets[hi]]
        yield (int(file[lo]), int(start[lo])), data


@dataclass(frozen=True)
class CsvScanner:
    """Records end at newlines outside quotes; a quote inside a quoted field is doubled, which keeps the parity."""

    sep: str = "\n"

    def quotes(self, data: np.ndarray) -> np.ndarray:
        return data == ord('"')

    def deeper(self, data: np.ndarray, outside: np.ndarray) -> int:
        return 0

    def cuts(self, data: np.ndarray, outside: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the separators, whether the segment that follows each belongs to no record)."""
        at = np.flatnonzero(outside & (data == 10))
        return at, np.zeros(len(at), bool)

    def starts_idle(self, depth: int) -> bool:
        return False

    def check_end(self, odd: int, depth: int) -> None:
        if odd:
            raise ValueError("a CSV file ends inside quotes")

    def check_idle(self, text: bytes) -> None:
        pass


@dataclass(frozen=True)
class JsonArrayScanner:
    """Elements of a top-level array end at commas of depth 1 outside strings. The text is cut at closing braces, which
    are never part of an escape; the last piece of a file gets a brace too many, at depth 0."""

    sep: str = "}"

    def quotes(self, data: np.ndarray) -> np.ndarray:
        quotes = data == ord('"')
        other = data != ord("\\")
        if not other.all():  # a quote behind an odd number of backslashes is escaped
            at = np.flatnonzero(quotes)
            last = np.maximum.accumulate(np.where(other, np.arange(len(data)), -1))
            before = np.where(at > 0, last[np.maximum(at - 1, 0)], -1)
            quotes[at[(at - 1 - before) % 2 == 1]] = False
        return quotes

    def _steps(self, data: np.ndarray, outside: np.ndarray) -> np.ndarray:
        step = ((data == ord("{")) | (data == ord("["))).astype(np.int8)
        step -= (data == ord("}")) | (data == ord("]"))
        step[~outside] = 0
        return step

    def deeper(self, data: np.ndarray, outside: np.ndarray) -> int:
        return int(self._steps(data, outside).sum(dtype=np.int64))

    def cuts(self, data: np.ndarray, outside: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        step = self._steps(data, outside)
        after = depth + np.cumsum(step, dtype=np.int64)
        cut = (outside & (data == ord(",")) & (after == 1)) | ((data == ord("[")) & (step > 0) & (after == 1))
        cut |= (data == ord("]")) & (step < 0) & (after == 0)
        at = np.flatnonzero(cut)
        return at, after[at] == 0

    def starts_idle(self, depth: int) -> bool:
        return depth == 0

    def check_end(self, odd: int, depth: int) -> None:
        if odd or depth != -1:  # the brace too many
            raise ValueError("a file is not one JSON array: its brackets or quotes do not close")

    def check_idle(self, text: bytes) -> None:
        if text.strip(b" \t\r\n\xef\xbb\xbf").removesuffix(b"}").strip(b" \t\r\n"):
            raise ValueError(f"text outside a JSON array: {text[:80]!r}")


Scanner = CsvScanner | JsonArrayScanner


def _summarise(scanner: Scanner):
    """For every range: is its number of quotes odd, and how much deeper it leads, starting outside or inside quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for key, data in _runs(batch, ord(scanner.sep)):
                quotes = scanner.quotes(data)
                inside = np.cumsum(quotes, dtype=np.int64) & 1  # after each byte, started outside
                deeper = [scanner.deeper(data, inside == 0), scanner.deeper(data, inside == 1)]
                odd, d0, d1 = found.setdefault(key, [0, 0, 0])
                found[key] = [odd ^ int(inside[-1]), d0 + deeper[odd], d1 + deeper[1 - odd]]
        rows = [(*key, *sums) for key, sums in found.items()]
        cols = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["file", "start", "odd", "d0", "d1"])

    return run


class Ranges:
    """The state at the start of every range: inside quotes, and the depth."""

    def __init__(self, table: pa.Table) -> None:
        cols = {c: table.column(c).to_numpy() for c in table.column_names}
        by = np.lexsort((cols["start"], cols["file"]))
        self.file, self.start = cols["file"][by], cols["start"][by]
        self.inside, self.depth = cols["inside"][by].astype(np.int8), cols["depth"][by].astype(np.int32)

    def state(self, file: int, start: int) -> tuple[int, int]:
        lo, hi = (int(np.searchsorted(self.file, file, side=s)) for s in ("left", "right"))
        at = lo + int(np.searchsorted(self.start[lo:hi], start))
        if at == hi or self.start[at] != start:
            raise RuntimeError("the byte ranges of a file changed between two passes: read it again")
        return int(self.inside[at]), int(self.depth[at])


def range_states(pieces: DataFrame, scanner: Scanner) -> Ranges:
    """Steps 1 and 2; fails if a file does not end in the state that a whole file must have."""
    found = pieces.mapInArrow(_summarise(scanner), "file long, start long, odd long, d0 long, d1 long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    found = found.withColumn("deeper", F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")))
    found = found.withColumn("depth", F.coalesce(F.sum("deeper").over(before), F.lit(0)))
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.desc("start"))) == 1
    table = found.withColumn("last", last).limit(MAX_RANGES + 1).toArrow()
    if table.num_rows > MAX_RANGES:
        raise ValueError(f"more than {MAX_RANGES} byte ranges: raise spark.sql.files.maxPartitionBytes")
    for r in table.filter(table.column("last")).to_pylist():
        scanner.check_end((r["inside"] + r["odd"]) % 2, r["depth"] + r["deeper"])
    return Ranges(table)


SEGMENT = "file long, start long, nth int, opens boolean, closes boolean, first boolean, body string"


def _segments(scanner: Scanner, sent: Broadcast):
    """Step 3: the segments between separators. ``opens``: begins at a separator or at the start of the file;
    ``closes``: ends at a separator; ``first``: begins the file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges: Ranges = sent.value
        key, inside, depth, nth, idle, opens, held = None, 0, 0, 0, False, False, []
        rows: list[tuple] = []

        def end(closes: bool) -> None:
            body = b"".join(held)
            if idle:
                scanner.check_idle(body)
            else:
                rows.append((*key, min(nth, 1), opens, closes, nth == 0 and key[1] == 0, body))

        for batch in batches:
            for now, data in _runs(batch, ord(scanner.sep)):
                if now != key:
                    if key is not None:
                        end(False)  # empty if the range ends at a separator
                    key, nth, held = now, 0, []
                    inside, depth = ranges.state(*now)
                    idle, opens = scanner.starts_idle(depth), now[1] == 0
                quotes = scanner.quotes(data)
                after = (np.cumsum(quotes, dtype=np.int64) + inside) & 1
                outside = after == 0
                cuts, idles = scanner.cuts(data, outside, depth)
                raw, at = data.tobytes(), 0
                for cut, then in zip(cuts.tolist(), idles.tolist()):
                    held.append(raw[at:cut])
                    end(True)
                    at, nth, idle, opens, held = cut + 1, nth + 1, then, True, []
                if at < len(raw):
                    held.append(raw[at:])
                depth += scanner.deeper(data, outside)
                inside = int(after[-1])
            if rows:
                yield _segment_batch(rows)
                rows.clear()
        if key is not None:
            end(False)
        if rows:
            yield _segment_batch(rows)

    return run


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_()]
    body = pa.array(cols[6], pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, types)), body],
                                      names=["file", "start", "nth", "opens", "closes", "first", "body"])


def records(spark: SparkSession, path: str, scanner: Scanner, split_bytes: int | None = None) -> DataFrame:
    """``(body, first)``: the text of every record of the files, and whether it is the first of its file. The order of
    the rows carries no meaning."""
    own = pinned_session(spark, split_bytes)
    pieces = _pieces(own, path, scanner.sep)
    sent = own.sparkContext.broadcast(range_states(pieces, scanner))
    found = pieces.mapInArrow(_segments(scanner, sent), SEGMENT)
    whole = found.filter("opens and closes").select("body", "first")
    order = Window.partitionBy("file").orderBy("start", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = found.filter("not (opens and closes)").withColumn("record", F.sum(F.col("opens").cast("long")).over(order))
    joined = parts.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("start", "nth", "body"))).alias("parts"), F.max("first").alias("first"))
    return whole.unionByName(joined.select(F.array_join(F.col("parts.body"), "").alias("body"), "first"))


def read_quoted_csv(spark: SparkSession, path: str, names: list[str], split_bytes: int | None = None) -> DataFrame:
    """A headered CSV as text columns ``names``, in as many tasks as the files have splits. Quotes occur only around
    fields and, doubled, inside them; blank lines are skipped; a record with another number of fields fails the job."""
    found = records(spark, path, CsvScanner(), split_bytes).filter("not first")
    body = F.regexp_replace("body", r"\r$", "")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parsed = F.from_csv(body, schema.toDDL(), {"escape": '"', "mode": "FAILFAST", "multiLine": "true"})
    return found.filter(F.length(body) > 0).select(parsed.alias("r")).select("r.*")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, split_bytes: int | None = None) -> DataFrame:
    """Files that each hold one JSON array of objects, in as many tasks as the files have splits. An element that does
    not parse fails the job, and so does a file that is not one array; an empty array or file has no rows."""
    found = records(spark, path, JsonArrayScanner(), split_bytes).filter(F.col("body").rlike(r"[^ \t\r\n]"))
    ddl = schema.toDDL() if isinstance(schema, T.StructType) else schema
    return found.select(F.from_json("body", ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")
