"""Sources and sinks (A1-A10).

Types are always given, never inferred. CSV is read by its header names and written with nested columns rendered as
JSON text, since CSV cannot hold arrays.
Existence checks go through the Hadoop FileSystem of the path, so they work on any shared store.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import split_scan

# ---- fixed values --------------------------------------------------------------------------------------------
# Benchmark source: positional columns bound to names (0-based positions of the landed table).
BENCHMARK_COLUMNS = {1: "task", 3: "fen", 6: "answer", 8: "metadata"}

PUZZLE_SCHEMA = T.StructType(
    [
        T.StructField("PuzzleId", T.StringType()),
        T.StructField("FEN", T.StringType()),
        T.StructField("Moves", T.StringType()),
        T.StructField("Rating", T.IntegerType()),
        T.StructField("Themes", T.StringType()),
    ]
)


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a headered CSV (the first file's first line; a header holds no quoted newline)."""
    head = spark.read.option("header", True).option("escape", '"').csv(path).schema
    return head.fieldNames()


def read_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 fmt: str = "csv", multi_line: bool = False, split_bytes: int | None = None) -> DataFrame:
    """A1 / A2: headered CSV, Parquet, JSON Lines or JSON arrays (``json_array``), with an explicit schema.

    CSV columns are bound by their header names: the columns of ``schema`` are cast (a value that does not fit fails
    the job), in whatever order the file has them; every other column of the file passes through as text behind them,
    and a missing name is an error. Repeated header names are an error too. ``multi_line`` is for files whose quoted
    fields hold newlines (reasoning text). Such files and JSON arrays are split too, at ``split_bytes`` (default: the
    session's largest split) with the state at each split found first (``split_scan``); a JSON array needs a schema.
    """
    if fmt == "csv":
        names = _header(spark, path)
        if len(set(names)) < len(names):
            raise ValueError(f"repeated column names in the header of {path}: {names}")
        if multi_line:
            raw = split_scan.read_quoted_csv(spark, path, names, split_bytes)
        else:
            text = T.StructType([T.StructField(n, T.StringType()) for n in names])
            raw = spark.read.schema(text).option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
        if schema is None:
            return raw
        typed = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        missing = [n for n in typed.fieldNames() if n not in names]
        if missing:
            raise ValueError(f"columns {missing} are not in the header of {path}: {names}")
        rest = [n for n in names if n not in typed.fieldNames()]
        quoted = lambda n: F.col(f"`{n}`")
        return raw.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in typed], *[quoted(n) for n in rest])
    if fmt == "json_array":
        if schema is None:
            raise ValueError("a JSON array needs a schema")
        return split_scan.read_json_array(spark, path, schema, split_bytes)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "json":
        return reader.json(path)
    raise ValueError(f"unknown format {fmt}")


def load_benchmark(spark: SparkSession, path: str, fmt: str = "parquet",
                   columns: dict[int, str] | None = None, multi_line: bool = False) -> DataFrame:
    """A3: a landed copy of the benchmark split; positional columns are bound to names."""
    df = read_records(spark, path, fmt=fmt, multi_line=multi_line)
    cols = columns or BENCHMARK_COLUMNS
    return df.select(*[F.col(f"`{df.columns[i]}`").alias(name) for i, name in sorted(cols.items())])


def _csv_safe(df: DataFrame) -> DataFrame:
    """Arrays, maps and structs -> JSON text (CSV holds scalars only)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _array_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of one array file: its elements behind an opening bracket or a comma, and the closing bracket."""
    opened = False
    for batch in batches:
        if batch.num_rows:
            lead = pa.array(["," if opened else "["] + [","] * (batch.num_rows - 1))
            opened = True
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(lead, batch.column(0).cast(pa.string()), "")], names=["value"])
    yield pa.RecordBatch.from_arrays([pa.array(["]" if opened else "[]"])], names=["value"])


def write_records(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, files: int | None = None) -> None:
    """CSV (header, nested -> JSON), Parquet (nested kept), JSON Lines and JSON arrays (UTF-8 verbatim, nulls kept).

    ``mode='append'`` adds files next to the existing ones (A5): each task writes its own file, so there
    is no shared header to guard. A JSON array file is one array for each task (an empty task writes ``[]``). ``files``
    deals the rows to that many tasks first; with 1, one task streams all rows into one file.
    """
    df = df.repartition(files) if files else df
    if fmt == "csv":
        w = _csv_safe(df).write.mode(mode).option("header", True).option("escape", '"')
        w = w.partitionBy(*partition_by) if partition_by else w
        w.csv(path)
    elif fmt == "parquet":
        w = df.write.mode(mode)
        w = w.partitionBy(*partition_by) if partition_by else w
        w.parquet(path)
    elif fmt == "json":
        w = df.write.mode(mode).option("ignoreNullFields", False)
        w = w.partitionBy(*partition_by) if partition_by else w
        w.json(path)
    elif fmt == "json_array":
        if partition_by:
            raise ValueError("JSON arrays are not partitioned by a column")
        lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
        lines.mapInArrow(_array_lines, "value string").write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def is_complete(spark: SparkSession, path: str) -> bool:
    """A written output folder with its ``_SUCCESS`` marker."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def complete_folders(spark: SparkSession, path: str, name: str) -> list[tuple[re.Match, str]]:
    """Sub-folders whose name matches a pattern, that have their ``_SUCCESS`` marker."""
    if not path_exists(spark, path):
        return []
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    paths = [f.getPath().toString() for f in found if f.isDirectory()]
    names = [(re.fullmatch(name, p.rpartition("/")[2]), p) for p in paths]
    return [(m, p) for m, p in names if m and is_complete(spark, p)]


def cache_path(base: str, name: str, seed: int | None = None) -> str:
    """Cache folder that includes the seed (N7: a cache made with another seed is never reused)."""
    return f"{base.rstrip('/')}/{name}" + (f"-seed{seed}" if seed is not None else "")


def inputs_fingerprint(spark: SparkSession, inputs: Sequence[str]) -> str:
    """The files under some paths by name, size and time, as one number and their count; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(inputs))
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total = files.select("path", "length", "modificationTime").agg(F.count("*"), F.sum(each)).first()
    return f"{n}:{total}"


def content_key(df: DataFrame, inputs: Sequence[str], **params) -> str:
    """A name for what a frame computes: its optimized plan (without expression ids), schema, input files and any
    parameters. It changes when one of them does, and is the same in another session."""
    plan = re.sub(r"#\d+L?|\bplan_id=\d+", "", df._jdf.queryExecution().optimizedPlan().toString())
    what = [plan, df.schema.json(), inputs_fingerprint(df.sparkSession, inputs), json.dumps(params, sort_keys=True, default=str)]
    return hashlib.sha256("\0".join(what).encode()).hexdigest()[:24]


def materialize(spark: SparkSession, build: Callable[[], DataFrame], path: str, fmt: str = "parquet",
                inputs: Sequence[str] | None = None, **params) -> DataFrame:
    """Read ``path`` if a complete output is there; otherwise build, write and read back.

    Reading back (not caching) cuts the lineage and survives executor loss. With ``inputs`` (the paths that the build
    reads) the output goes to a folder of ``path`` named by ``content_key``, so that a changed input, plan or parameter
    is built anew and never served from an older output; ``params`` name what the plan does not show.
    """
    df = build() if inputs is not None else None
    if df is not None:
        path = f"{path.rstrip('/')}/{content_key(df, inputs, **params)}"
    if not is_complete(spark, path):
        write_records(build() if df is None else df, path, fmt)
    return read_records(spark, path, fmt=fmt)


def materialize_all(spark: SparkSession, build: Callable[[], dict[str, DataFrame]], paths: dict[str, str],
                    fmt: str = "parquet") -> dict[str, DataFrame]:
    """A9 for a set of outputs (the two halves): reuse only when *every* output is complete."""
    if not all(is_complete(spark, p) for p in paths.values()):
        frames = build()
        for k, p in paths.items():
            write_records(frames[k], p, fmt)
    return {k: read_records(spark, p, fmt=fmt) for k, p in paths.items()}


def materialize_split(spark: SparkSession, build: Callable[[], DataFrame], path: str, column: str,
                      values: Sequence[str]) -> dict[str, DataFrame]:
    """A9 for the parts of one frame: written once, partitioned by ``column``, and read back part by part (a part is a
    folder, so nothing else is scanned). Reused only when the whole output is complete."""
    if not is_complete(spark, path):
        write_records(build(), path, "parquet", partition_by=[column])
    whole = spark.read.parquet(path)
    return {v: whole.filter(F.col(column) == v).drop(column) for v in values}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch output that is not needed any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def convert(spark: SparkSession, src: str, dst: str, src_fmt: str, dst_fmt: str,
            src_schema: T.StructType | str | None = None,
            dst_schema: T.StructType | str | None = None, multi_line: bool = False,
            files: int | None = None, split_bytes: int | None = None) -> DataFrame:
    """A10: format conversion of a released split; returns the written data read back (CSV and JSON arrays need
    ``dst_schema`` to read back; CSV holds nested columns as JSON text)."""
    df = read_records(spark, src, src_schema, src_fmt, multi_line, split_bytes)
    write_records(df, dst, dst_fmt, files=files)
    return read_records(spark, dst, dst_schema, dst_fmt, multi_line, split_bytes)
