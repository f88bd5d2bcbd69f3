"""WARC archives with a two-level capture index.

Archives: gzip members, one record each, written by tasks into the shared
folder. Of records with equal payloads the one with the largest page id is a
``response``; the others are ``revisit`` records that carry no payload but
its digest and length and the page they refer to.

Index, level 2: one line per capture, keyed by the reversed-host URL
(``com,example,www)/path``) and the page id, dealt by key range, sorted, and
packed into compressed blocks of ``BLOCK_LINES`` lines. Level 1: a sparse
directory with the first key and the place of every block, kept per index
file behind its blocks. A lookup finds its index file by binary search over
the files' first keys, its block by binary search in that file's directory,
reads the one block, and yields file, offset and length; records are then
read by range, in file order.

A finished-files table is written after the files, so a lost or repeated
task leaves at most an unlisted file.

Defined cases: a null html is an empty payload; a null url has the key '';
page ids are the tie-break (rows repeated with one page id share its
record type, and each has a record of its own); a null page id counts as
smaller than all others; an empty table gives no file and no row; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, scratch_dir, ship, stage, table

BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
READ_GAP = 1 << 16
READ_SPAN = 8 << 20
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "page_id long, n long, key string, file string, offset long, length long"
INDEX = "first_key string, file string"
PLACE = "key string, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def url_key(url: str) -> str:
    """Sortable key of a URL: reversed host, then path and query."""
    try:
        u = urlsplit(url)
        host, port = (u.hostname or "").lower(), u.port
    except ValueError:
        return url.lower()
    if not host:
        return url.lower()
    if host.startswith("www."):
        host = host[4:]
    key = ",".join(reversed(host.split(".")))
    if port and port not in (80, 443):
        key += f":{port}"
    return f"{key}){u.path or '/'}" + (f"?{u.query}" if u.query else "")


def _key(url: str | None, page_id: int | None, n: int) -> str:
    """Index key: URL key, page id (null first) and the copy's number."""
    of_id = "" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{url_key(url or '')} {of_id} {n:020d}"


def record(row: dict) -> bytes:
    """One WARC record as a gzip member; ``row`` has page_id, n, url, payload,
    sha1 (hex) and resp (the response's page id, for a revisit)."""
    revisit = row["revisit"]
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    name = "null" if row["page_id"] is None else row["page_id"]
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Target-URI", url),
        ("WARC-Date", DATE),
        ("WARC-Record-ID", f"<urn:page:{name}:{row['n']}>"),
        ("Content-Type", "text/html"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Payload-Length", str(len(row["payload"]))),
    ]
    if revisit:
        head.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        head.append(("WARC-Refers-To", f"<urn:page:{row['resp']}>"))
    body = b"" if revisit else row["payload"]
    head.append(("Content-Length", str(len(body))))
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    return gzip.compress(lines.encode() + body + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> dict:
    """The record of one gzip member; a response's digest is taken from its payload."""
    import hashlib

    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    h = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[: int(h["Content-Length"])]
    digest, length = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["WARC-Payload-Length"])
    if h["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if (found, len(body)) != (digest, length):
            raise ValueError(f"{h['WARC-Record-ID']}: wrong payload")
    name = h["WARC-Record-ID"].split(":")[2]
    to = h.get("WARC-Refers-To", "<urn:page:null>")[10:-1]
    return {
        "page_id": None if name == "null" else int(name),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": h["WARC-Type"],
        "refers_to": None if to == "null" else int(to),
        "url": h["WARC-Target-URI"],
    }


def _rows(rows: list[dict], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in ddl.split(", ")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in fields]))


def plan_records(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """Pages with payload, digest and, for a revisit, the response's page id.

    Only digests that occur more than once take part in the join; they are
    counted with partial sums, written, and read with their exact size.
    """
    keyed = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    groups = (
        pages.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("p"))
        .filter(F.length("p") >= revisit_bytes)
        .groupBy(F.sha1("p").alias("g_sha1"))
        .agg(F.max("page_id").alias("resp"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("g_sha1", "resp")
    )
    groups = stage(groups, "warc-groups")
    return (
        keyed.join(groups, F.col("sha1") == F.col("g_sha1"), "left")
        .withColumn("revisit", F.col("resp").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("resp")))
        .select("page_id", "url", "payload", "sha1", "resp", "revisit")
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write the archives; returns the place of every record."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        fs, path = filesystem(folder)
        out = None
        for batch in batches:
            places = []
            for row in batch.to_pylist():
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name, at = f"part-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                row["n"] = (part << 32) + n
                n += 1
                data = record(row)
                out.write(data)
                places.append(
                    {
                        "page_id": row["page_id"], "n": row["n"], "key": _key(row["url"], row["page_id"], row["n"]),
                        "file": name, "offset": at, "length": len(data),
                    }
                )
                at += len(data)
                if at >= FILE_BYTES:
                    out.close()
                    out = None
            yield _rows(places, MANIFEST)
        if out is not None:
            out.close()

    done = f"{folder}/captures"
    records.mapInArrow(write, MANIFEST).write.parquet(done)
    return records.sparkSession.read.schema(MANIFEST).parquet(done)


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted index files; returns (first_key, file), one row per file."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, path = filesystem(folder)
        out, lines, directory, at = None, [], [], 0

        def flush():
            nonlocal at
            block = zlib.compress("\n".join(lines).encode(), 6)
            out.write(block)
            directory.append([lines[0].split("\t", 1)[0], at, len(block)])
            at += len(block)
            lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.cdx"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                lines.append("\t".join([json.dumps(r["key"]), r["file"], str(r["offset"]), str(r["length"])]))
                if len(lines) == block_lines:
                    flush()
        if out is not None:
            if lines:
                flush()
            sparse = zlib.compress(json.dumps(directory).encode(), 6)
            out.write(sparse + struct.pack("<I", len(sparse)))
            out.close()
            yield _rows([{"first_key": json.loads(directory[0][0]), "file": name}], INDEX)

    done = f"{folder}/index"
    by_key = captures.select("key", "file", "offset", "length").repartitionByRange("key").sortWithinPartitions("key")
    by_key.mapInArrow(write, INDEX).write.parquet(done)
    return captures.sparkSession.read.schema(INDEX).parquet(done)


class IndexFile:
    """Lookups in one index file: sparse directory first, then one block."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        (n,) = struct.unpack("<I", self._at(size - 4, 4))
        self.directory = json.loads(zlib.decompress(self._at(size - 4 - n, n)))
        self.first = [json.loads(d[0]).encode() for d in self.directory]
        self.held, self.block = -1, {}

    def _at(self, offset: int, length: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(length)

    def find(self, key: str) -> list[str] | None:
        """[file, offset, length] of the capture, or None."""
        k = bisect.bisect_right(self.first, key.encode()) - 1
        if k < 0:
            return None
        if k != self.held:
            _, at, length = self.directory[k]
            lines = (x.split("\t") for x in zlib.decompress(self._at(at, length)).decode().split("\n"))
            self.held, self.block = k, {json.loads(x[0]): x[1:] for x in lines}
        return self.block.get(key)


def lookup(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """(key) -> (key, file, offset, length) through the two index levels.

    The list of index files has one row per index partition; it is what
    every task holds. Keys go to the task of their index file, in order.
    """
    files = sorted(((r["first_key"], r["file"]) for r in index.collect()), key=lambda x: x[0].encode())
    if not files:
        return keys.sparkSession.createDataFrame([], PLACE)
    starts, names = [f[0].encode() for f in files], [f[1] for f in files]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        held, reader = -1, None
        for batch in batches:
            out = []
            for key in batch.column(0).to_pylist():
                at = max(0, bisect.bisect_right(starts, key.encode()) - 1)
                if at != held:
                    held, reader = at, IndexFile(fs, f"{path}/{names[at]}")
                if place := reader.find(key):
                    out.append({"key": key, "file": place[0], "offset": int(place[1]), "length": int(place[2])})
            yield _rows(out, PLACE)

    dealt = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return dealt.mapInArrow(find, PLACE)


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at (file, offset, length), by range reads in file order."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        name, file = None, None
        for batch in batches:
            rows, out, k = batch.to_pylist(), [], 0
            while k < len(rows):
                if rows[k]["file"] != name:
                    name = rows[k]["file"]
                    file = fs.open_input_file(f"{path}/{name}")
                # One read covers records that lie close together.
                first, stop, end = rows[k]["offset"], k, rows[k]["offset"]
                while (
                    stop < len(rows) and rows[stop]["file"] == name and rows[stop]["offset"] <= end + READ_GAP
                    and (stop == k or rows[stop]["offset"] + rows[stop]["length"] - first <= READ_SPAN)
                ):
                    end = rows[stop]["offset"] + rows[stop]["length"]
                    stop += 1
                file.seek(first)
                data = file.read(end - first)
                for r in rows[k:stop]:
                    out.append(parse(data[r["offset"] - first : r["offset"] - first + r["length"]]))
                k = stop
            yield _rows(out, RECORD)

    dealt = places.select("file", "offset", "length").repartitionByRange("file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD)


@ship
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record for every page, index them, and read each back through
    the index."""
    folder = scratch_dir(spark, "warc")
    captures = write_archives(plan_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")), folder)
    index = write_index(captures, folder)
    places = stage(lookup(captures, index, folder), "warc-places")
    return read_records(places, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex FROM p),
bytes5 AS (  -- 32 base32 digits, five bits each, from 40 hex digits
  SELECT page_id, payload_bytes, hex,
    list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform(range(0, 4),
      lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + CAST((CAST('0x' || substr(hex, 1 + g * 5, 5) AS BIGINT) >> (15 - 5 * d)) & 31 AS INTEGER), 1)),
      'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM hashed),
grouped AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS resp FROM bytes5)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN resp IS NULL OR page_id IS NOT DISTINCT FROM resp THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN resp IS NULL OR page_id IS NOT DISTINCT FROM resp THEN NULL ELSE resp END AS refers_to
FROM grouped"""

QUERIES = {"op2_warc": op2_warc}
SQL = {"op2_warc": WARC_SQL}
