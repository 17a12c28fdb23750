"""Ask-and-answer exchanges between chunks of documents and hash buckets.

A corpus-wide question about hashes ("does this window occur elsewhere", "how often does this n-gram occur") would
shuffle one row per token if it were a plain join. Here each chunk of documents sends every bucket one sorted, delta
coded and compressed block of its distinct hashes; the bucket merges the blocks of all chunks and sends back a block
aligned with what the chunk sent. A hash of a hot passage costs one entry per chunk, however often it occurs.
Chunks and buckets hold a bounded volume each; their number follows the size of the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

CHUNK_BYTES = 8 << 20  # text per chunk, and text whose hashes share a bucket
ASK = "bucket int, chunk int, n long, body binary"
U64 = np.uint64


def text_volume(docs: DataFrame, col: str = "text") -> int:
    """Bytes of text in the frame (one number)."""
    return docs.agg(F.sum(F.octet_length(F.col(col)))).first()[0] or 0


def parts_for(spark: SparkSession, volume: int, per_part: int = CHUNK_BYTES) -> int:
    """Parts of a bounded volume, and at least two for each core so that a small input uses them all."""
    return max(-(-volume // per_part), 2 * spark.sparkContext.defaultParallelism)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Range buckets: sorted hashes have ascending buckets."""
    return ((hashes >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def pack(values: np.ndarray) -> bytes:
    """An integer array as compressed byte planes; leading zero planes cost almost nothing."""
    values = np.ascontiguousarray(values)
    return pa.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def unpack(body: bytes, n: int, dtype: type) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype)
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(body, decompressed_size=n * width, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(dtype)[:, 0]


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 keys, as differences."""
    return pack(np.diff(keys, prepend=U64(0)))


def unpack_sorted(body: bytes, n: int) -> np.ndarray:
    return np.cumsum(unpack(body, n, U64), dtype=U64)


def write(df: DataFrame, path: str) -> None:
    """Write a frame; the shuffle files of the job that makes it go when it is done."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(key, before)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
