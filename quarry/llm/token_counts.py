"""Token counts by a map-side two-tier lookup (operator 12).

A tokenizer that drops white space treats every pre-token on its own, so the length of a text is the sum of the
lengths of its pre-tokens. The first tier is a compact open-addressing hash table of the corpus' frequent pre-tokens
(64-bit hash, length), broadcast to all tasks and probed for a whole slice of text at once. What it misses goes to the
second tier, a cache in each Python worker from pre-token to length, and what that misses is encoded by the tokenizer
library. No pre-token is ever shuffled: the frequent ones come from one bounded summary for each task over all
documents, merged by a tree of fixed fan-in. The table and the caches only save work; no result depends on them.

A pre-token is an ASCII letter run, one digit, a run of other ASCII characters or a contraction, as the tokenizer's
pattern has them. A run between ASCII white space that holds a non-ASCII byte or may hold a special string is one unit
as a whole and left to the library. Hashes have 64 bits: with 2**16 entries and 10**10 different units, fewer than
0.0001 wrong lookups are expected in the whole corpus.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm import chunks, words
from quarry.llm.words import U64

TABLE = 1 << 16  # frequent pre-tokens
SUMMARY = 1 << 13  # pre-tokens a task reports
SLICE_TOP = 1 << 11  # pre-tokens a slice reports to its task
CACHE = 1 << 18  # pre-tokens a worker remembers
LONGEST = 64  # bytes of a pre-token worth remembering
FAN_IN = 64
SLICE_BYTES = 1 << 20
# the pattern whose pieces ``pretokens`` finds in ASCII text (fixed value: it is the tokenizer's own)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_KIND = np.full(256, 3, np.uint8)
_KIND[list(words.SPACE)] = 0
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2
_FOLD = words.FOLDED[1]
_ONE = np.zeros(256, bool)
_ONE[list(b"stmd")] = True
_TWO = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


def check_tokenizer(spec: str) -> None:
    """Raise unless the tokenizer drops white space and splits by ``PATTERN``, so that units can be counted alone."""
    found = json.loads(spec)
    splits = [p for p in (found["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
    if not (len(splits) == 1 and splits[0]["pattern"] == {"Regex": PATTERN} and splits[0]["invert"] and splits[0]["behavior"] == "Removed"):
        raise ValueError("the tokenizer's pre-tokens are not those of this operator")
    if any(set(t["content"].encode()) & set(words.SPACE) or not t["content"].startswith("<|") or t["lstrip"] or t["rstrip"]
           for t in found["added_tokens"]):
        raise ValueError("special strings must start with <| and hold no white space")


def pretokens(w: words.Words) -> words.Words:
    """The units of the texts, from their words between ASCII white space (bytes as they are)."""
    data, n = w.data, len(w.data)
    if not len(w.start):
        return w
    odd = data >= 0x80
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    seen = np.concatenate(([0], np.cumsum(odd)))
    fine = seen[w.end] == seen[w.start]
    edge = np.zeros(n + 1, np.int8)
    edge[w.start[fine]] += 1
    edge[w.end[fine]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    data = np.where(inside, _FOLD[data], data)
    kind = _KIND[data]
    begin = kind == 2
    begin[1:] |= kind[1:] != kind[:-1]
    begin[w.start] = True
    mark = np.flatnonzero(begin & inside & (data == ord("'")))
    limit = w.end[np.searchsorted(w.start, mark, side="right") - 1]
    next1, next2 = data[np.minimum(mark + 1, n - 1)], data[np.minimum(mark + 2, n - 1)]
    one = (mark + 1 < limit) & _ONE[next1]
    two = (mark + 2 < limit) & np.any([(next1 == a) & (next2 == b) for a, b in _TWO], axis=0)
    begin[mark[one | two] + 1] = False
    for at, end in ((mark[one] + 2, limit[one]), (mark[two] + 3, limit[two])):
        begin[at[at < end]] = True
    begin &= inside
    begin[w.start] = True
    start = np.flatnonzero(begin)
    end = np.minimum(np.append(start[1:], n), w.end[np.searchsorted(w.start, start, side="right") - 1])
    return words.Words(data, w.text, start, end, np.searchsorted(start, w.text))


def _units(texts: pa.Array) -> Iterator[tuple[int, int, words.Words]]:
    for lo, hi, w in words.slices(texts, words.CASED, SLICE_BYTES):
        yield lo, hi, pretokens(w)


def _bytes(w: words.Words, at: np.ndarray) -> list[bytes]:
    data = w.data.tobytes()
    return [data[s:e] for s, e in zip(w.start[at].tolist(), w.end[at].tolist())]


def _top(counts: dict[bytes, int], n: int) -> dict[bytes, int]:
    return dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n])


_SUMMARY = "part long, units array<binary>, counts array<long>"
_SUMMARY_ARROW = pa.schema([("part", pa.int64()), ("units", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))])


def _summary(part: int, counts: dict[bytes, int]) -> pa.Table:
    return pa.table([[part], [list(counts)], [list(counts.values())]], schema=_SUMMARY_ARROW)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the task: its frequent units and their counts, pruned to a bounded size after every slice."""
    counts: dict[bytes, int] = {}
    for batch in batches:
        for _, _, w in _units(batch.column(0)):
            at = np.flatnonzero(w.end - w.start <= LONGEST)
            _, first, n = np.unique(w.hashes()[at], return_index=True, return_counts=True)
            top = np.argsort(-n, kind="stable")[:SLICE_TOP]
            for unit, c in zip(_bytes(w, at[first[top]]), n[top].tolist()):
                counts[unit] = counts.get(unit, 0) + c
            if len(counts) > 4 * SUMMARY:
                counts = _top(counts, 2 * SUMMARY)
    yield from _summary(TaskContext.get().partitionId(), _top(counts, SUMMARY)).to_batches()


def _merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    counts: dict[bytes, int] = {}
    for units, ns in zip(rows.column("units").to_pylist(), rows.column("counts").to_pylist()):
        for unit, n in zip(units, ns):
            counts[unit] = counts.get(unit, 0) + n
    return _summary(key[0].as_py(), _top(counts, TABLE))


def frequent_units(docs: DataFrame, text: str = "text") -> list[bytes]:
    """At most ``TABLE`` units that are frequent in all documents, most frequent first."""
    found = chunks.store(docs.select(F.col(text)).mapInArrow(_summarise, _SUMMARY), "token-units")
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        found = found.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part").applyInArrow(_merge, _SUMMARY)
        parts = -(-parts // FAN_IN)
    row = found.first()
    return [bytes(u) for u in row.units] if row else []


class Lengths:
    """The broadcast tier: an open-addressing table from a unit's hash to its length."""

    def __init__(self, units: list[bytes], lengths: list[int]) -> None:
        data = np.frombuffer(b"".join(units), np.uint8)
        end = np.cumsum([len(u) for u in units], dtype=np.int64)
        h = words.FIRST.spans(data, end - np.array([len(u) for u in units], np.int64), end, words.FIRST.table)
        bits = max(4, int(4 * len(units)).bit_length())
        self.shift, self.mask, self.probes = U64(64 - bits), (1 << bits) - 1, 0
        self.keys, self.values = np.zeros(1 << bits, U64), np.zeros(1 << bits, np.uint8)
        left = np.flatnonzero(h)
        slot = (h >> self.shift).astype(np.int64)
        while len(left):
            self.probes += 1
            free = left[self.keys[slot[left]] == 0]
            self.keys[slot[free]] = h[free]  # of several units for a slot, the last stays
            won = free[self.keys[slot[free]] == h[free]]
            self.values[slot[won]] = np.asarray(lengths, np.uint8)[won]
            left = left[self.keys[slot[left]] != h[left]]
            slot[left] = (slot[left] + 1) & self.mask

    def find(self, h: np.ndarray) -> np.ndarray:
        """The length of each unit, -1 if it is not in the table."""
        out = np.full(len(h), -1, np.int64)
        slot, left = (h >> self.shift).astype(np.int64), np.arange(len(h))
        for _ in range(self.probes):
            keys = self.keys[slot]
            hit = (keys == h[left]) & (keys != 0)
            out[left[hit]] = self.values[slot[hit]]
            go = ~hit & (keys != 0)
            left, slot = left[go], (slot[go] + 1) & self.mask
        return out


_TOKENIZER: list = [None, None]  # of this worker: the specification and its tokenizer
_SEEN: dict[bytes, int] = {}  # of this worker: the length of units that the table does not hold


def encoded_lengths(spec: str, units: list[bytes]) -> list[int]:
    """Lengths by the library, with its default handling of special strings and none added."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    if _TOKENIZER[0] != spec:
        _TOKENIZER[:] = spec, Tokenizer.from_str(spec)
        _TOKENIZER[1].no_truncation()
        _TOKENIZER[1].no_padding()
        _SEEN.clear()
    out: list[int] = []
    for i in range(0, len(units), 4096):
        part = [u.decode("utf-8", "replace") for u in units[i : i + 4096]]
        out.extend(len(e.ids) for e in _TOKENIZER[1].encode_batch_fast(part, add_special_tokens=False))
    return out


def _worker_lengths(spec: str, units: list[bytes]) -> np.ndarray:
    if _TOKENIZER[0] != spec:
        encoded_lengths(spec, [])
    out = [_SEEN.get(u, -1) for u in units]
    new = [i for i, n in enumerate(out) if n < 0]
    for i, n in zip(new, encoded_lengths(spec, [units[i] for i in new])):
        out[i] = n
        if len(units[i]) <= LONGEST:
            if len(_SEEN) >= CACHE:
                _SEEN.clear()
            _SEEN[units[i]] = n
    return np.array(out, np.int64)


def _count(sent: Broadcast, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, table = sent.value
        for batch in batches:
            for lo, hi, w in _units(batch.column(len(keep))):
                h = w.hashes()
                n = table.find(h)
                missed = np.flatnonzero(n < 0)
                _, first, which = np.unique(h[missed], return_index=True, return_inverse=True)
                n[missed] = _worker_lengths(spec, _bytes(w, missed[first]))[which]
                below = np.concatenate(([0], np.cumsum(n)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(np.diff(w.text), pa.int64()),
                                                  pa.array(np.diff(below[w.first]), pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) with n_bytes (UTF-8) and n_tokens of every whole text; ``tokenizer`` is the
    path, on the driver, of a specification that ``check_tokenizer`` accepts.

    A null or empty text has no bytes and no tokens. Each repeated row is counted on its own. Input columns named like
    the new ones are replaced. An empty table gives an empty table. A text of any length is counted whole; it is a
    slice of its own beyond ``SLICE_BYTES``.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    check_tokenizer(spec)
    units = frequent_units(docs, text)
    sent = docs.sparkSession.sparkContext.broadcast((spec, Lengths(units, encoded_lengths(spec, units))))
    new = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in {f.name for f in new}]
    rows = docs.select(*keep, F.col(text).alias("text" + "_" * max(map(len, keep), default=0)))
    return rows.mapInArrow(_count(sent, keep), T.StructType([docs.schema[c] for c in keep] + new))
