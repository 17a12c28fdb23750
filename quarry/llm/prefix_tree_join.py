"""N-gram Jaccard join over prefix trees (operator 4).

1. Documents with equal n-gram sets collapse to one set (a 128-bit sum over the distinct n-grams identifies it).
2. The number of sets that hold an n-gram is counted with one compressed exchange (see ``chunks``). Rarest first, then
   by hash, is the global order; two sets that link share an n-gram among the first ``n - ceil(3n/4) + 1`` of both.
   A set whose prefix has only n-grams of its own links with nothing and is done. Most sets end here.
3. Sets connected through shared prefix n-grams form blocks; a set is sent to one block only. A block too large for one
   task is cut into pieces by hash.
4. In a piece the sets are stored in a path-compressed trie, most frequent n-gram first, so that they share partial
   overlaps. Each set traverses the trie; a subtree is left when the overlap so far plus what can remain of either
   side cannot reach the threshold, or when all its sets are in the traversing set's component already. Links found
   are kept as a union-find forest, so a piece returns one edge per set and never the pairs of a group.
5. For blocks of several pieces, one set of each component found meets in a second round; blocks which then still
   have several components compare their pieces two by two, again skipping what is connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import chunks, words
from quarry.llm.components import components
from quarry.llm.words import U64

GRAM, NUMER, DENOM = 5, 75, 100
PIECE_TOKENS = 1 << 20  # n-grams in one piece of a block
SLICE_BYTES = 1 << 20  # bytes of text shingled at once: some twenty arrays of 8 bytes for each word


@dataclass
class Sets:
    """The distinct n-gram hashes of consecutive texts, ascending: text i has hashes[at[i]:at[i + 1]]."""

    at: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, w: words.Words, gram: int) -> Sets:
        begin, end = w.windows(gram, short=True)
        h, owner = words.FIRST.spans(w.hashes(), begin, end), w.window_owner(gram, short=True)
        by = np.lexsort((h, owner))
        h, owner = h[by], owner[by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        return cls(np.searchsorted(owner[new], np.arange(len(w.first))), h[new])

    @classmethod
    def of_texts(cls, texts: pa.Array | pa.ChunkedArray, gram: int) -> Sets:
        """Of many texts, a slice at a time: only the sets themselves are held for all."""
        parts = [cls.of(w, gram) for _, _, w in words.slices(texts, words.FOLDED, SLICE_BYTES)]
        sizes = np.concatenate([np.zeros(1, np.int64), *(p.sizes() for p in parts)])
        return cls(np.cumsum(sizes), np.concatenate([np.zeros(0, U64), *(p.hashes for p in parts)]))

    def sizes(self) -> np.ndarray:
        return np.diff(self.at)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), self.sizes())

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit sums that identify each set."""
        out = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            sums = np.concatenate((np.zeros(1, U64), np.cumsum(words.mix(self.hashes ^ U64(salt)), dtype=U64)))
            out.append((sums[self.at[1:]] - sums[self.at[:-1]]).view(np.int64))
        return out[0], out[1]


def _identify(gram: int, texts: bool):
    """mapInArrow: (id, a, b, n) of every row, or with texts (a, b, n, text) of every set the task sees first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for lo, hi, w in words.slices(batch.column("text"), words.FOLDED, SLICE_BYTES):
                s = Sets.of(w, gram)
                a, b = s.keys()
                part, n = batch.slice(lo, hi - lo), s.sizes()
                if not texts:
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(a), pa.array(b), pa.array(n)], names=["id", "a", "b", "n"])
                    continue
                fresh = np.zeros(len(n), bool)
                for i, k in enumerate(zip(a.tolist(), b.tolist())):
                    if n[i] and k not in seen:
                        seen.add(k)
                        fresh[i] = True
                mask = pa.array(fresh)
                yield pa.RecordBatch.from_arrays([pa.array(a[fresh]), pa.array(b[fresh]), pa.array(n[fresh]), part.column("text").filter(mask)],
                                                 names=["a", "b", "n", "text"])

    return run


def _distinct(docs: pa.Table) -> pa.Table:
    """One row per set, in a fixed order."""
    docs = docs.sort_by([("a", "ascending"), ("b", "ascending")])
    a, b = docs.column("a").to_numpy(), docs.column("b").to_numpy()
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return docs.filter(pa.array(new))


def _ask(gram: int, buckets: int):
    """Per chunk: its distinct n-grams with the number of its sets that hold them."""

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        s = Sets.of_texts(_distinct(docs).column("text"), gram)
        h, n = np.unique(s.hashes, return_counts=True)
        cuts = np.searchsorted(chunks.bucket_of(h, buckets), np.arange(buckets + 1))
        rows = [(b, key[0].as_py(), hi - lo, chunks.pack_sorted(h[lo:hi]), chunks.pack(n[lo:hi].astype(np.uint32)))
                for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if hi > lo]
        cols = list(zip(*rows)) or [[]] * 5
        return pa.table({"bucket": pa.array(cols[0], pa.int32()), "chunk": pa.array(cols[1], pa.int32()),
                         "n": pa.array(cols[2], pa.int64()), "body": pa.array(cols[3], pa.binary()),
                         "counts": pa.array(cols[4], pa.binary())})

    return run


def _count(key: tuple[pa.Scalar, ...], asked: pa.Table) -> pa.Table:
    """Per bucket: the corpus-wide number of sets for each n-gram asked about."""
    n = asked.column("n").to_pylist()
    h = np.concatenate([chunks.unpack_sorted(b, k) for b, k in zip(asked.column("body").to_pylist(), n)])
    c = np.concatenate([chunks.unpack(b, k, np.uint32) for b, k in zip(asked.column("counts").to_pylist(), n)])
    _, inverse = np.unique(h, return_inverse=True)
    total = np.minimum(np.bincount(inverse, weights=c), 2**32 - 1).astype(np.uint32)[inverse]
    cuts = np.cumsum([0, *n])
    return pa.table({"chunk": asked.column("chunk"), "bucket": asked.column("bucket"), "n": asked.column("n"),
                     "body": pa.array([chunks.pack(total[cuts[i] : cuts[i + 1]]) for i in range(len(n))], pa.binary())})


def _prefixes(gram: int):
    """Per chunk: the sets whose prefix holds an n-gram of another set, with their shared n-grams and that prefix."""

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs, answers = _distinct(docs), answers.sort_by("bucket")
        s = Sets.of_texts(docs.column("text"), gram)
        h, inverse = np.unique(s.hashes, return_inverse=True)
        parts = [chunks.unpack(b, k, np.uint32) for b, k in zip(answers.column("body").to_pylist(), answers.column("n").to_pylist())]
        held = (np.concatenate(parts) if parts else np.zeros(0, np.uint32))[inverse]
        n, owner = s.sizes(), s.owner()
        by = np.lexsort((held, owner))  # hashes ascend within a set already, and the sort is stable
        place = np.arange(len(by)) - s.at[:-1][owner]
        prefix = n - -(-n * NUMER // DENOM) + 1
        shared = held[by] >= 2
        first = shared & (place < prefix[owner])
        live = np.bincount(owner[first], minlength=len(n)) > 0
        rows = np.flatnonzero(live)
        h8, sh = s.hashes[by], np.concatenate(([0], np.cumsum(shared)))
        all_shared, all_first = h8[shared], h8[first].view(np.int64)
        fi = np.concatenate(([0], np.cumsum(first)))
        tokens = [all_shared[sh[s.at[i]] : sh[s.at[i + 1]]].tobytes() for i in rows]
        lead = [all_first[fi[s.at[i]] : fi[s.at[i + 1]]] for i in rows]
        docs = docs.take(pa.array(rows))
        return pa.table({"a": docs.column("a"), "b": docs.column("b"), "n": docs.column("n"),
                         "tokens": pa.array(tokens, pa.binary()), "prefix": pa.array(lead, pa.list_(pa.int64()))})

    return run


class Forest:
    """Union-find over 0..n-1 with the smallest member as root."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


@dataclass
class Node:
    label: np.ndarray  # ranks on the edge to this node
    rest: int  # most ranks below it in any of its sets
    least: int  # smallest set size below it
    comps: set[int]  # components below it, as of the last look
    children: dict[int, Node] = field(default_factory=dict)
    ends: list[int] = field(default_factory=list)  # sets whose ranks end here


def link(tokens: list[np.ndarray], sizes: list[int], comp: list[int]) -> Forest:
    """Components of the sets of one piece. ``sizes`` are whole set sizes, ``tokens`` those n-grams that any other set
    can hold; sets with equal ``comp`` are known to be connected and not compared."""
    forest, first = Forest(len(tokens)), {}
    for i, c in enumerate(comp):
        forest.join(first.setdefault(c, i), i)
    if not tokens:
        return forest
    flat = np.concatenate(tokens)
    _, inverse, held = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.empty(len(held), np.int64)
    rank[np.argsort(-held, kind="stable")] = np.arange(len(held))
    common = int((held > 1).sum())  # ranks beyond stand in one set only
    ranks = rank[inverse]
    cuts = np.cumsum([0, *map(len, tokens)])
    marks = np.zeros(len(held) + 1, np.int64)
    root = Node(np.zeros(0, np.int64), 0, 1 << 62, set())
    for i in sorted(range(len(tokens)), key=lambda i: (sizes[i], i)):
        x = np.sort(ranks[cuts[i] : cuts[i + 1]])
        x = x[x < common]
        marks[x] = 1
        _traverse(root, x, i, sizes, marks, forest)
        marks[x] = 0
        _insert(root, x, i, sizes[i])
    return forest


def _traverse(root: Node, x: np.ndarray, i: int, sizes: list[int], marks: np.ndarray, forest: Forest) -> None:
    n, find, total = sizes[i], forest.find, NUMER + DENOM
    shortest = -(-n * NUMER // DENOM)
    stack = [(root, 0, 0)]
    while stack:
        node, overlap, depth = stack.pop()
        node.comps = {find(c) for c in node.comps}
        if not node.comps or (len(node.comps) == 1 and find(i) in node.comps):
            continue
        left = len(x) - depth
        if len(node.label):
            overlap += int(marks[node.label].sum())
            left = len(x) - int(np.searchsorted(x, node.label[-1], side="right"))
        # the smallest overlap with any set below: total * overlap >= NUMER * (n + size)
        if total * (overlap + min(left, node.rest)) < NUMER * (n + max(node.least, shortest)):
            continue
        for y in node.ends:
            if total * overlap >= NUMER * (n + sizes[y]):
                forest.join(i, y)
        own = node.children.get(int(x[len(x) - left])) if left else None
        stack.extend((c, overlap, len(x) - left) for c in node.children.values() if c is not own)
        if own is not None:
            stack.append((own, overlap, len(x) - left))  # first the path the set itself takes


def _insert(root: Node, x: np.ndarray, i: int, size: int) -> None:
    node, at = root, 0
    while True:
        node.rest, node.least = max(node.rest, len(x) - at), min(node.least, size)
        node.comps.add(i)
        if at == len(x):
            node.ends.append(i)
            return
        child = node.children.get(int(x[at]))
        if child is None:
            node.children[int(x[at])] = Node(x[at:].copy(), 0, size, {i}, ends=[i])
            return
        k = min(len(child.label), len(x) - at)
        differ = np.flatnonzero(child.label[:k] != x[at : at + k])
        same = int(differ[0]) if len(differ) else k
        if same < len(child.label):  # part the edge
            tail = child.label[same:]
            upper = Node(child.label[:same], child.rest + len(tail), child.least, set(child.comps), {int(tail[0]): child})
            child.label = tail
            node.children[int(x[at])] = upper
            child = upper
        node, at = child, at + same


def _pieces(bin_: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Join the pieces of one bin: (u, v) edges from each set to the root of its component within the piece."""
    rows = rows.sort_by([("piece", "ascending"), ("rep", "ascending")])
    piece, rep = rows.column("piece").to_pylist(), rows.column("rep").to_pylist()
    sizes, comp, tokens = rows.column("n").to_pylist(), rows.column("comp").to_pylist(), rows.column("tokens").to_pylist()
    us, vs, lo = [], [], 0
    while lo < len(piece):
        hi = lo
        while hi < len(piece) and piece[hi] == piece[lo]:
            hi += 1
        forest = link([np.frombuffer(t, U64) for t in tokens[lo:hi]], sizes[lo:hi], comp[lo:hi])
        for i in range(hi - lo):
            r = forest.find(i)
            if r != i:
                us.append(rep[lo + i])
                vs.append(rep[lo + r])
        lo = hi
    return pa.table({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})


def _join(sets: DataFrame, piece: Column, bins: int) -> DataFrame:
    keyed = sets.select(piece.alias("piece"), "rep", "n", "comp", "tokens")
    keyed = keyed.withColumn("bin", F.pmod(F.xxhash64("piece"), F.lit(bins)))
    return keyed.groupBy("bin").applyInArrow(_pieces, "u long, v long")


def _relabel(sets: DataFrame, edges: DataFrame) -> DataFrame:
    """Sets with comp replaced by the component that the edges give it."""
    found = components(edges)
    return (sets.drop("comp").join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("comp", F.coalesce("component", "rep")).drop("component"))


def _links(sets: DataFrame, piece_tokens: int) -> DataFrame:
    """(u, v) edges that connect exactly the sets connected by links; sets: rep, n, tokens, prefix."""
    spark = sets.sparkSession
    grams = sets.select("rep", F.explode("prefix").alias("gram"))
    hubs = grams.groupBy("gram").agg(F.min("rep").alias("v"), F.count("*").alias("k")).where("k > 1")
    blocks = components(grams.join(hubs, "gram").where("rep <> v").select(F.col("rep").alias("u"), "v").distinct())
    sets = sets.drop("prefix").join(blocks.select(F.col("node").alias("rep"), F.col("component").alias("block")), "rep")
    weight = sets.groupBy("block").agg(F.sum(F.octet_length("tokens") / 8).alias("w"))
    weight = weight.select("block", F.ceil(F.col("w") / piece_tokens).cast("int").alias("pieces"))
    sets = chunks.store(sets.join(weight, "block").withColumn("comp", F.col("rep"))
                        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")), "join-sets")
    bins = chunks.parts_for(spark, sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0, 8 * piece_tokens)
    edges = chunks.store(_join(sets, F.concat_ws("/", "block", "part"), bins), "join-edges")
    large = sets.where("pieces > 1")
    if large.isEmpty():
        return edges
    # one set of every component of every piece
    roots = large.join(edges.select(F.col("u").alias("rep")).distinct(), "rep", "left_anti")
    share = roots.groupBy("block").agg(F.ceil(F.sum(F.octet_length("tokens")) / (8 * piece_tokens)).cast("int").alias("shares"))
    roots = roots.join(share, "block")
    second = _join(roots, F.concat_ws("/", "block", F.pmod(F.xxhash64("rep", F.lit("second")), F.col("shares"))), bins)
    edges = chunks.store(edges.unionByName(second), "join-edges")
    large = _relabel(large, edges)
    open_blocks = large.groupBy("block").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("block")
    large = large.join(open_blocks, "block", "left_semi")
    other = F.explode(F.filter(F.sequence(F.lit(0), F.col("pieces") - 1), lambda j: j != F.col("part")))
    large = large.withColumn("other", other)
    pair = F.concat_ws("/", "block", F.least("part", "other"), F.greatest("part", "other"))
    return edges.unionByName(_join(large, pair, bins))


def jaccard_components(docs: DataFrame, gram: int = GRAM, text: str = "text", key: str = "doc_id",
                       chunk_bytes: int = chunks.CHUNK_BYTES, piece_tokens: int = PIECE_TOKENS) -> DataFrame:
    """Documents linked by a Jaccard similarity of at least 0.75 between their sets of ``gram``-word shingles.

    Returns (key, n_shingles, component_id) for every row; component_id is the smallest id reachable by links. Words
    are runs of non-white-space with A-Z lower-cased. A text of fewer words is one shingle; a null or empty text has
    none and links with nothing. A null id gives a row with a null id, which takes part in links under the smallest
    other id of equal sets, or else under no id: its component_id is then null. Repeated rows of an id are one node.
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    parts = chunks.parts_for(spark, chunks.text_volume(docs, text), chunk_bytes)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    ids = chunks.store(rows.mapInArrow(_identify(gram, False), "id long, a long, b long, n long"), "join-ids")
    full = ids.where("n > 0 and id is not null")
    # rows that share an id are one node: their sets are connected through it
    reps = chunks.store(full.groupBy("a", "b").agg(F.min("id").alias("rep"), F.max("id").alias("top")), "join-reps")
    texts = rows.where("id is not null").mapInArrow(_identify(gram, True), "a long, b long, n long, text string")
    texts = texts.withColumn("chunk", F.pmod("a", F.lit(parts)).cast("int"))
    asked = texts.groupBy("chunk").applyInArrow(_ask(gram, parts), chunks.ASK + ", counts binary")
    counted = asked.groupBy("bucket").applyInArrow(_count, "chunk int, bucket int, n long, body binary")
    sets = texts.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        _prefixes(gram), "a long, b long, n long, tokens binary, prefix array<long>")
    sets = chunks.store(sets, "join-prefixes").join(reps.select("a", "b", "rep"), ["a", "b"]).drop("a", "b")
    edges = _links(sets, piece_tokens)
    # an id with several sets connects their smallest ids
    many = full.groupBy("id").agg(F.min(F.struct("a", "b")).alias("x"), F.max(F.struct("a", "b")).alias("y")).where("x <> y").select("id")
    twice = full.join(many, "id", "left_semi").join(reps, ["a", "b"]).select(F.col("id").alias("u"), F.col("rep").alias("v"))
    found = components(edges.unionByName(twice))
    labels = reps.join(found, reps.rep == found.node, "left").select("a", "b", F.coalesce("component", "rep").alias("component"))
    return (ids.join(labels, ["a", "b"], "left")
            .select(F.col("id").alias(key), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id")))
