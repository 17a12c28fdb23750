"""Variable-capacity best-fit packing of documents into training sequences (operator 10).

Several sequence lengths are permitted. A sequence of length c costs c, a fixed ``overhead``, and c**2 / ``span`` for attention,
which grows with the square of the length: long sequences waste less at their ends, short ones attend less. Texts
longer than the largest length are cut into pieces of that length and a rest, so nothing is dropped. Pieces are placed
in descending length into the open bin with the least room that still fits. If none fits, a bin is opened. For each
permitted length that holds the piece, the lengths still to be placed are tried for the rest of the room, longest first;
the bin opened is the one with the least cost for each token that it would hold, at the length it would be downsized to.
So all lengths are weighed jointly against the lengths that are really left. At last each bin is downsized to the smallest
permitted length that holds its contents.

Pieces are dealt by hash to shards (one for about ``shard_docs`` documents), each packed by one task on its own; a shard adds
at most a few partly filled bins, so the loss vanishes as shards grow. Equal rows are counted first and dealt in blocks of
``COPIES``, so that no shard gets all copies of a row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16
SPAN = 24_576  # a sequence of this length would spend as much on attention as on all else
SHARD_DOCS = 8192
COPIES = 1024  # equal pieces dealt together


def cost(c: int, overhead: int, span: int) -> float:
    return c + overhead + c * c / span


class Remaining:
    """The lengths not placed yet; they are taken from the longest down."""

    def __init__(self, lengths: np.ndarray) -> None:
        values, counts = np.unique(lengths, return_counts=True)
        self.values, self.counts = values.tolist(), counts.tolist()

    def take(self) -> None:
        self.counts[-1] -= 1
        if not self.counts[-1]:
            self.values.pop()
            self.counts.pop()

    def fill(self, room: int) -> int:
        """How much of a room the remaining lengths fill, longest first."""
        filled, end = 0, len(self.values)
        while True:
            k = bisect_right(self.values, room - filled, 0, end) - 1
            if k < 0 or not self.values[k]:
                return filled
            filled += self.values[k] * min(self.counts[k], (room - filled) // self.values[k])
            end = k


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin of each piece, length each bin was opened with, length it ends with). Lengths are at most the largest
    capacity; pieces of length 0 take no room. Ties go to the earlier piece, the earlier bin and the shorter length."""
    sizes = np.array(sorted(capacities))
    order = np.argsort(-lengths, kind="stable")
    bin_of, opened, used = np.zeros(len(lengths), np.int64), [], []
    rooms: list[int] = []  # rooms of open bins that occur, ascending
    open_at: dict[int, list[int]] = {}
    left = Remaining(lengths)
    for i in order.tolist():
        n = int(lengths[i])
        left.take()
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            b = heappop(open_at[room])
            if not open_at[room]:
                del open_at[room], rooms[k]
        else:
            fit = sizes[np.searchsorted(sizes, n) :].tolist()
            held = [n + left.fill(c - n) for c in fit]
            ends = sizes[np.searchsorted(sizes, held)].tolist()
            room = min(zip(fit, held, ends), key=lambda x: (cost(x[2], overhead, span) / max(x[1], 1), x[0]))[0]
            b = len(opened)
            opened.append(room)
            used.append(0)
        bin_of[i], used[b] = b, used[b] + n
        if room - n not in open_at:
            open_at[room - n] = []
            insort(rooms, room - n)
        heappush(open_at[room - n], b)
    return bin_of, np.array(opened, np.int64), sizes[np.searchsorted(sizes, np.array(used, np.int64))]


def _pack(capacities: tuple[int, ...], overhead: int, span: int):
    def run(shard: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("tie", "ascending"), ("piece", "ascending"), ("block", "ascending")])
        rows = rows.take(pa.array(np.repeat(np.arange(rows.num_rows), rows.column("copies").to_numpy())))
        n = rows.column("n_tokens").to_numpy()
        bin_of, first_size, size = best_fit(n, capacities, overhead, span)
        by = np.lexsort((np.arange(len(n)), bin_of))  # inside a bin, in order of the documents
        n, bin_of = n[by], bin_of[by]
        total = np.cumsum(n) - n
        first = np.searchsorted(bin_of, np.arange(len(size)))
        rows = rows.take(pa.array(by))
        key = shard[0].as_py()
        return pa.table({"shard": pa.array([key] * len(n), pa.int32()), "bin": pa.array(bin_of), "capacity": pa.array(size[bin_of]), "opened": pa.array(first_size[bin_of]),
                         "offset": pa.array(total - total[first][bin_of] if len(n) else total), "doc_id": rows.column("doc_id"),
                         "piece": rows.column("piece"), "start": rows.column("start"), "n_tokens": rows.column("n_tokens")})

    return run


def pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD, text: str = "text",
         key: str = "doc_id", n_tokens: str | None = None, shard_docs: int = SHARD_DOCS, span: int = SPAN) -> DataFrame:
    """One row per piece: shard, bin (numbered within the shard), capacity of the bin, the length it was opened with,
    offset in it, doc_id, piece, start (first token of the piece in its document), n_tokens.

    Tokens of a document: the column ``n_tokens`` if named, else its ASCII-white-space words and one end token. A
    null or empty text is its end token alone; a null or non-positive count is one piece of length 0; a null id is
    kept; repeated rows are pieces of their own. An empty table gives an empty table.
    """
    most = max(capacities)
    words = F.size(F.split(F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+"))
    blank = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\x0c\r")) == ""
    count = F.greatest(F.coalesce(F.col(n_tokens).cast("long"), F.lit(0)), F.lit(0)) if n_tokens else F.when(blank, 1).otherwise(words + 1)
    tie = F.xxhash64(text) if text in docs.columns else F.lit(0).cast("long")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), tie.alias("tie"), count.cast("long").alias("total"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("total") / most)).cast("int") - 1)))
    start = F.col("piece").cast("long") * most
    rows = rows.select("doc_id", "tie", "piece", start.alias("start"), F.least(F.lit(most), F.col("total") - start).alias("n_tokens"))
    shards = max(1, -(-docs.count() // shard_docs))
    equal = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES).cast("int")))
    dealt = equal.withColumn("block", block).withColumn("copies", F.least(F.lit(COPIES), F.col("n") - F.col("block").cast("long") * COPIES)).drop("n")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("doc_id", "tie", "piece", "block"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(_pack(tuple(capacities), overhead, span), "shard int, bin long, capacity long, opened long, "
                                               "offset long, doc_id long, piece int, start long, n_tokens long")
