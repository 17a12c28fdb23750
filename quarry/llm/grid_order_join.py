"""Embedding near-duplicates by an epsilon grid order join (operator 9).

On unit vectors a cosine of at least c is a distance of at most epsilon = sqrt(2 - 2c). The leading principal
directions (from the covariance, summed up by Spark) give each vector a cell of a grid with edge epsilon. Vectors are
range-partitioned and sorted by their cells (the epsilon grid order) and cut into blocks of consecutive vectors. Only
blocks with neighbouring cells are paired, and of these only those whose bounding boxes in the principal directions
are within epsilon: projections never lengthen a distance, so other blocks are provably apart. A pair of blocks is
joined recursively: its sequence intervals are halved until they are small, and halves whose boxes are too far apart
are skipped; what is left is compared by cosine in double precision.

Exact copies collapse to one vector with a multiplicity before the join. A pair of blocks returns for each of its
vectors the number of links found and the root of its component inside the pair, never the links themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import chunks
from quarry.llm.components import components
from quarry.llm.prefix_tree_join import Forest

THRESHOLD = 0.9
DIRECTIONS, CELL_DIRECTIONS = 6, 3
BLOCK, LEAF = 8192, 512
SLACK = 1e-9


def _units(column: pa.Array, dim: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _moments(dim: int):
    """Per task: sums of the vectors and of their outer products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, outer = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = _units(b.column("vec"), dim)
            n, total, outer = n + len(x), total + x.sum(axis=0), outer + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([[float(n), *total, *outer.ravel()]], pa.list_(pa.float64()))], names=["sums"])

    return run


def directions(vectors: DataFrame, dim: int, count: int) -> np.ndarray:
    """The leading principal directions as columns. 1 + dim + dim**2 numbers reach the driver."""
    sums = vectors.select("vec").mapInArrow(_moments(dim), "sums array<double>").select(F.posexplode("sums").alias("i", "x"))
    flat = np.zeros(1 + dim + dim * dim)
    for r in sums.groupBy("i").agg(F.sum("x").alias("x")).collect():
        flat[r.i] = r.x
    n, mean = max(flat[0], 1.0), flat[1 : dim + 1] / max(flat[0], 1.0)
    _, axes = np.linalg.eigh(flat[dim + 1 :].reshape(dim, dim) / n - np.outer(mean, mean))
    return np.ascontiguousarray(axes[:, ::-1][:, :count])


def _cells(dim: int, axes: np.ndarray, edge: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = np.floor(_units(b.column("vec"), dim) @ axes / edge).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(cell), pa.list_(pa.int32()))], names=[*b.schema.names, "cell"])

    return run


def _blocks(dim: int, axes: np.ndarray, size: int):
    """Per task: its sorted vectors as packed blocks with their bounding boxes and cells."""

    def pack(number: int, part: pa.Table) -> pa.RecordBatch:
        p = _units(part.column("vec"), dim) @ axes
        cells = {tuple(c[:CELL_DIRECTIONS]) for c in part.column("cell").to_pylist()}
        return pa.RecordBatch.from_pylist([{
            "block": number, "lo": p.min(axis=0).tolist(), "hi": p.max(axis=0).tolist(), "cells": [list(c) for c in sorted(cells)],
            **{name: part.column(c).to_numpy().tobytes() for name, c in (("reps", "rep"), ("tags", "tag"), ("copies", "copies"))},
            "vecs": part.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).tobytes()}], schema=_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, TaskContext.get().partitionId() << 32
        for b in batches:
            table = pa.Table.from_batches([b])
            held = table if held is None else pa.concat_tables([held, table])
            while len(held) >= size:
                yield pack(number, held.slice(0, size))
                held, number = held.slice(size), number + 1
        if held is not None and len(held):
            yield pack(number, held)

    return run


VECTORS = "rep long, tag long, copies long, vec array<double>"
_BLOCK = pa.schema([("block", pa.int64()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("cells", pa.list_(pa.list_(pa.int32()))),
                    ("reps", pa.binary()), ("tags", pa.binary()), ("copies", pa.binary()), ("vecs", pa.binary())])
BLOCKS = "block long, lo array<double>, hi array<double>, cells array<array<int>>, reps binary, tags binary, copies binary, vecs binary"


class _Sequence:
    """The vectors of one block in grid order."""

    def __init__(self, row: dict, dim: int, axes: np.ndarray) -> None:
        self.reps, self.tags, self.copies = (np.frombuffer(row[c], np.int64) for c in ("reps", "tags", "copies"))
        self.x = _units(pa.FixedSizeListArray.from_arrays(pa.array(np.frombuffer(row["vecs"], np.float64)), dim), dim)
        self.p = self.x @ axes


def _apart(a: np.ndarray, b: np.ndarray, epsilon: float) -> bool:
    gap = np.maximum(np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)), 0)
    return math.sqrt(float(gap @ gap)) > epsilon + SLACK


def _pair(dim: int, axes: np.ndarray, threshold: float, leaf: int):
    epsilon = math.sqrt(max(0.0, 2 - 2 * threshold))

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        blocks = [_Sequence(r, dim, axes) for r in rows.sort_by("block").to_pylist()]
        a, b = blocks[0], blocks[-1]
        same = len(blocks) == 1
        shift = 0 if same else len(a.reps)
        reps, tags = (a.reps, a.tags) if same else (np.concatenate((a.reps, b.reps)), np.concatenate((a.tags, b.tags)))
        links, forest = np.zeros(len(reps), np.int64), Forest(len(reps))
        stack = [(0, len(a.reps), 0, len(b.reps))]
        while stack:
            i, j, k, m = stack.pop()
            if (same and m <= i) or _apart(a.p[i:j], b.p[k:m], epsilon):
                continue
            if j - i <= leaf and m - k <= leaf:
                near = a.x[i:j] @ b.x[k:m].T >= threshold
                if same:  # each pair once: the second vector comes later in the block
                    near &= np.arange(i, j)[:, None] < np.arange(k, m)[None, :]
                if near.any():
                    links[i:j] += near @ b.copies[k:m]
                    links[shift + k : shift + m] += a.copies[i:j] @ near
                    for u, v in _spanning(near):
                        forest.join(i + u, shift + k + v)
                continue
            if same and (i, j) == (k, m):
                h = (i + j) // 2
                stack += [(i, h, i, h), (i, h, h, j), (h, j, h, j)]
            elif j - i >= m - k:
                h = (i + j) // 2
                stack += [(i, h, k, m), (h, j, k, m)]
            else:
                h = (k + m) // 2
                stack += [(i, j, k, h), (i, j, h, m)]
        hit = np.flatnonzero(links)
        return pa.table({"rep": pa.array(reps[hit]), "tag": pa.array(tags[hit]), "links": pa.array(links[hit]),
                         "root": pa.array(np.array([reps[forest.find(x)] for x in hit.tolist()], np.int64))})

    return run


def _spanning(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect what the links of a leaf connect: row stars, with rows merged through the columns."""
    owner = np.full(near.shape[1], -1, np.int64)
    for u in np.flatnonzero(near.any(axis=1)).tolist():
        columns = np.flatnonzero(near[u])
        fresh = owner[columns] < 0
        for v in columns[fresh].tolist():
            yield u, v
        for w in np.unique(owner[columns[~fresh]]).tolist():
            yield u, int(columns[~fresh][owner[columns[~fresh]] == w][0])
        owner[columns[fresh]] = u


def _joined(vectors: DataFrame, dim: int, threshold: float, block: int, leaf: int) -> DataFrame:
    """(rep, tag, links, root) rows of all block pairs; vectors: rep, tag, copies, vec, all of one dimension."""
    edge = math.sqrt(max(1e-12, 2 - 2 * threshold)) + SLACK
    axes = directions(vectors, dim, min(dim, DIRECTIONS))
    cells = vectors.mapInArrow(_cells(dim, axes, edge), VECTORS + ", cell array<int>")
    ordered = cells.repartitionByRange("cell", "rep", "tag").sortWithinPartitions("cell", "rep", "tag")
    blocks = chunks.store(ordered.mapInArrow(_blocks(dim, axes, block), BLOCKS), "grid-blocks")
    meta = blocks.select("block", "lo", "hi", F.explode("cells").alias("cell"))
    step = F.array(F.lit(-1), F.lit(0), F.lit(1))
    around = meta.select(F.col("block").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.col("cell").alias("c"))
    for d in range(min(dim, CELL_DIRECTIONS)):
        moved = [F.get("c", F.lit(i)) + (F.col("s") if i == d else F.lit(0)) for i in range(min(dim, CELL_DIRECTIONS))]
        around = around.withColumn("s", F.explode(step)).withColumn("c", F.array(*moved)).drop("s")
    gap = F.aggregate(F.zip_with(F.zip_with("lo", "bhi", lambda x, y: x - y), F.zip_with("blo", "hi", lambda x, y: x - y),
                                 lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x)
    pairs = meta.join(around, F.col("cell") == F.col("c")).where("block <= b").where(gap <= (edge + SLACK) ** 2)
    pairs = pairs.select(F.col("block").alias("a"), "b").distinct()
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    return sides.join(blocks.select("block", "reps", "tags", "copies", "vecs"), "block").groupBy("a", "b").applyInArrow(
        _pair(dim, axes, threshold, leaf), LINKS)


LINKS = "rep long, tag long, links long, root long"


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding",
                    block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """(key, n_links, component_id, kept) of every row: links are pairs of rows with cosine >= threshold.

    Vectors that are null or empty, hold null or non-finite components or are zero link with nothing, and so do
    vectors of different lengths with each other; labels and other columns are not used. Copies of a vector link
    with each other. A row with a null id links with nothing: its component is null and it is not kept. Rows that
    repeat an id are vectors of their own under one id. An empty table gives an empty table. The threshold is
    positive.
    """
    rows = table.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("vec"))
    finite = ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    valid = rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    # the tag tells different vectors of one repeated id apart
    groups = valid.groupBy("vec").agg(F.min("id").alias("rep"), F.count("*").alias("copies")).withColumn("tag", F.xxhash64("vec"))
    groups = chunks.store(groups, "grid-vectors")
    spark, parts = table.sparkSession, []
    for r in groups.select(F.size("vec").alias("d")).distinct().collect():
        parts.append(_joined(groups.where(F.size("vec") == r.d).select("rep", "tag", "copies", "vec"), r.d, threshold, block, leaf))
    found = spark.createDataFrame([], LINKS)
    for p in parts:
        found = found.unionByName(p)
    found = chunks.store(found, "grid-links")
    links = found.groupBy("rep", "tag").agg(F.sum("links").alias("links"))
    # an id with several vectors connects their representatives
    tagged = valid.select("id", "vec", F.xxhash64("vec").alias("t"))
    many = tagged.groupBy("id").agg(F.min("t").alias("x"), F.max("t").alias("y")).where("x <> y").select("id")
    twice = tagged.join(many, "id", "left_semi").join(groups, "vec").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    comps = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")).unionByName(twice))
    named = (groups.join(links, ["rep", "tag"], "left").join(comps.withColumnRenamed("node", "rep"), "rep", "left")
             .select("vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rep").alias("component")))
    own = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    out = rows.withColumn("ok", F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
    out = out.withColumn("vec", F.when(F.col("ok"), F.col("vec"))).join(named, "vec", "left")
    return out.select(F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"))
