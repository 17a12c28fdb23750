"""WARC archives with an index (operator 5).

Writing: each task appends its pages to archives in the shared folder, one gzip member for each record, and returns
the index rows: archive, offset, length, URL, digest. The index is written as a table, so only the archives of
committed task attempts are ever referenced; a retried task writes archives under names of its own. Of equal payloads
of at least ``min_revisit`` bytes the record with the largest id holds the payload, the others are revisit records
that refer to it. Which pages revisit is found on (id, digest) rows alone.

Reading takes any selection of index rows, deals them by archive, sorts them by offset and joins neighbouring byte
ranges into one read, so a dense selection reads sequentially and a sparse one reads little else.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import chunks
from quarry.session import scratch_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 32 << 20
GAP, MOST = 64 << 10, 8 << 20  # bytes between ranges read along, and in one read
INDEX = ("archive string, offset long, length long, page_id long, url string, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder that Spark names, local or remote."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri) if ":" in uri else f"file://{uri}")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record: a response with its HTTP block, or a revisit without payload."""
    revisit = refers_to is not None
    head = HTTP % len(payload)
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """(WARC headers, length of the full payload, payload; empty for revisits) of one record."""
    at = raw.index(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in raw[:at].decode().split("\r\n")[1:])
    block = raw[at + 4 : at + 4 + int(headers["Content-Length"])]
    cut = block.index(b"\r\n\r\n") + 4
    return headers, int(re.search(rb"Content-Length: (\d+)", block[:cut])[1]), block[cut:]


def _write(root: str, archive_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        fs.create_dir(folder, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                payload = r["payload"].encode()
                data = record(r["page_id"], r["url"], payload, r["digest"], r["refers_to"], date)
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = pack.compress(data) + pack.flush()
                if out is None or offset + len(member) > archive_bytes > 0 and offset:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                out.write(member)
                rows.append({"archive": name, "offset": offset, "length": len(member), "page_id": r["page_id"], "url": r["url"],
                             "payload_bytes": len(payload), "payload_digest": r["digest"],
                             "record_type": "response" if r["refers_to"] is None else "revisit", "refers_to": r["refers_to"]})
                offset += len(member)
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
        if out is not None:
            out.close()

    return run


_INDEX = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def write_archives(pages: DataFrame, root: str | None = None, key: str = "page_id", url: str = "url", html: str = "html",
                   min_revisit: int = MIN_REVISIT, archive_bytes: int = ARCHIVE_BYTES, date: str = "1970-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """Write a record per row; returns (folder, index). The index lies in the folder too, as ``index``.

    A null html is an empty payload, a null url gives a record without target. Rows that repeat both id and payload
    are equal: if theirs is the largest id, all of them are responses. A null id is smaller than any id. An empty
    table gives an empty index.
    """
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"),
                        F.sha1(payload.cast("binary")).alias("digest"))
    large = rows.where(F.octet_length("payload") >= min_revisit).select("page_id", "digest")
    tops = large.groupBy("digest").agg(F.max("page_id").alias("top"), F.count("*").alias("n")).where("n > 1 and top is not null").drop("n")
    revisits = large.join(tops, "digest").where("page_id is null or page_id < top").distinct()
    revisits = revisits.select(F.col("page_id").alias("id"), F.col("digest").alias("d"), F.col("top").alias("refers_to"))
    joined = rows.join(revisits, F.expr("page_id <=> id and digest = d"), "left").drop("id", "d")
    chunks.write(joined.mapInArrow(_write(root, archive_bytes, date), INDEX), f"{root}/index")
    return root, read_index(spark, root)


def read_index(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{root}/index")


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def ranges(rows: list[tuple[str, int, int]], gap: int = GAP, most: int = MOST) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """(archive, offset, length, [(offset in the range, length)]) of coalesced reads; rows are sorted."""
    at = 0
    while at < len(rows):
        name, start, length = rows[at]
        end, to = start + length, at + 1
        while to < len(rows) and rows[to][0] == name and rows[to][1] - end <= gap and rows[to][1] + rows[to][2] - start <= most:
            end, to = max(end, rows[to][1] + rows[to][2]), to + 1
        yield name, start, end - start, [(o - start, n) for _, o, n in rows[at:to]]
        at = to


def _read(root: str, payloads: bool):
    def number(value: str) -> int | None:
        digits = re.fullmatch(r"<urn:page:(-?\d*)>", value)[1]
        return int(digits) if digits else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        name, source = None, None
        for batch in batches:
            wanted = list(zip(batch.column("archive").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist()))
            for archive, offset, length, parts in ranges(wanted):
                if archive != name:
                    name, source = archive, fs.open_input_file(f"{folder}/{archive}")
                data, out = source.read_at(length, offset), []
                for o, n in parts:
                    headers, size, payload = parse(zlib.decompress(data[o : o + n], 31))
                    revisit = headers["WARC-Type"] == "revisit"
                    out.append({"page_id": number(headers["WARC-Record-ID"]), "url": headers.get("WARC-Target-URI"), "payload_bytes": size,
                                "payload_digest": headers["WARC-Payload-Digest"].split(":")[1] if revisit else hashlib.sha1(payload).hexdigest(),
                                "record_type": headers["WARC-Type"], "refers_to": number(headers["WARC-Refers-To"]) if revisit else None,
                                "payload": payload if payloads and not revisit else None})
                yield pa.RecordBatch.from_pylist(out, schema=_READ)

    return run


def read_records(selected: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """The records of the selected index rows, read back from the archives. The digest and length of a response are
    those of the bytes read; a revisit has those of its headers and no payload (join on refers_to for it)."""
    places = selected.select("archive", "offset", "length").repartition("archive").sortWithinPartitions("archive", "offset")
    return places.mapInArrow(_read(root, payloads), READ)
