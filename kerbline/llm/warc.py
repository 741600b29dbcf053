"""WARC archives and a two-level capture index over them.

``write_archives`` writes one gzip member per record to files in the shared folder and lands a table of captures. A page whose
payload another page with a larger id has too becomes a revisit record of it. ``build_index`` range-sorts the captures by their
key (host reversed, then path) and writes index files: compressed blocks of ``BLOCK_LINES`` lines, then a sparse directory
with the first key and the place of each block. The first and last key of every file are a small table.

``find`` looks keys up in two levels: a binary search over the files' first keys deals every key to the files that may hold it, and each
task reads the directories of its files, binary-searches them and reads only the blocks it needs by range. ``read_records``
reads records by range, in file order. Files are opened through pyarrow's file systems by their URI, inside tasks. Every
attempt of a task writes files of its own; only those that the landed tables name are used, so a lost executor
leaves at most orphans behind.

Defined cases: a null payload is empty; a null url has no target and the key ``-``; a null page id is written without one and
revisits the page that has one, or is a response; pages with equal ids and payloads are all responses if their id is the largest;
urls that cannot be parsed are indexed as they are; repeated rows are records each; other columns are ignored; an empty
table gives no files and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbline.llm.common import land, small_batches
from kerbline.shared import fresh_path, sized

DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20
READ_BYTES = 32 << 20
BLOCK_LINES = 256
FILE_CAPTURES = 100_000


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)


def search_key(url: str | None) -> str:
    """Host reversed and parted by commas, then path and query; scheme, user, port, www and fragment are dropped."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").encode("idna").decode()
    except (ValueError, UnicodeError):
        host = ""
    if not host:
        return "~" + quote(url, safe="/:?=&%")
    host = host.removeprefix("www.")
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + quote(rest, safe="/:?=&%,;@+$!*'()~")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(row: dict) -> bytes:
    """One WARC 1.1 record as a gzip member."""
    payload = row["payload"] or b""
    revisit = row["refers_to"] is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, json.dumps([row['page_id'], row['url'], row['digest']]))}>",
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
        "WARC-Payload-Digest": f"sha1:{row['digest']}",
        "X-Payload-Length": str(len(payload)),
    }
    if row["url"] is not None:
        head["WARC-Target-URI"] = quote(row["url"], safe="/:?#[]@!$&'()*+,;=")
    if row["page_id"] is not None:
        head["X-Page-ID"] = str(row["page_id"])
    if revisit:
        head["WARC-Profile"] = REVISIT
        head["X-Refers-To-Page"] = str(row["refers_to"])
    lines = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    return gzip.compress(lines.encode() + block + b"\r\n\r\n", 6, mtime=0)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def with_references(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and refers_to: the page with the largest id of all with the same payload, null for itself."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")
    ).withColumn("sha", F.sha1("payload")).withColumn("size", F.length("payload"))
    groups = rows.groupBy("sha", "size").agg(F.max("page_id").alias("original"), F.count("*").alias("pages"))
    shared = sized(groups.filter("pages > 1").drop("pages"))
    marked = rows.join(shared, ["sha", "size"], "left")
    other = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return marked.select("page_id", "url", "payload", F.when(other, F.col("original")).alias("refers_to"))


CAPTURE = "key string, page_id bigint, digest string, type string, file string, offset bigint, length bigint"


def write_archives(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the records of ``pages`` (page_id, url, html) and land the captures: key, page_id, digest, type, file, offset, length."""
    small_batches(pages.sparkSession)
    folder = folder or fresh_path(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = opened(folder)
        out, path, at = None, "", 0
        try:
            for batch in batches:
                captures = []
                for row in batch.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        system.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, path, at = system.open_output_stream(f"{root}/{name}", compression=None), name, 0
                    row["digest"] = base32_sha1(row["payload"] or b"")
                    member = record_bytes(row)
                    out.write(member)
                    kind = "response" if row["refers_to"] is None else "revisit"
                    captures.append((search_key(row["url"]), row["page_id"], row["digest"], kind, f"{folder}/{path}", at, len(member)))
                    at += len(member)
                yield _captures(captures)
        finally:
            if out is not None:
                out.close()

    return land(with_references(pages).mapInArrow(run, CAPTURE), "captures")


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    names = ["key", "page_id", "digest", "type", "file", "offset", "length"]
    types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def build_index(captures: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the index files of landed captures and land their table: first, last (keys), path, blocks."""
    folder = folder or fresh_path(captures.sparkSession, "cdx")
    files = 1 + captures.count() // FILE_CAPTURES
    order = [F.col("key"), F.col("page_id"), F.col("file"), F.col("offset")]
    spread = max(files, min(64, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    ranged = captures.repartitionByRange(spread, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, directory, at, out, first, last = [], [], 0, None, None, None
        path = f"{folder}/{uuid.uuid4().hex}.cdx"
        system, root = opened(path)

        def flush() -> None:
            nonlocal at
            block = zlib.compress("".join(lines).encode())
            directory.append((lines[0].split("\t", 1)[0], at, len(block)))
            out.write(block)
            at += len(block)
            lines.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    system.create_dir(root.rpartition("/")[0], recursive=True)
                    out, first = system.open_output_stream(root, compression=None), row["key"]
                last = row["key"]
                lines.append("\t".join([row["key"], json.dumps([row[c] for c in ("page_id", "digest", "type", "file", "offset", "length")])]) + "\n")
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            table = zlib.compress(json.dumps(directory).encode())
            out.write(table + struct.pack("<Q", len(table)))
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([first]), pa.array([last]), pa.array([path]), pa.array([len(directory)], pa.int64())], names=["first", "last", "path", "blocks"]
            )

    return land(ranged.mapInArrow(run, "first string, last string, path string, blocks bigint"), "index-files")


class IndexFile:
    """An open index file: its directory, and its blocks by range."""

    def __init__(self, path: str):
        system, root = opened(path)
        self.file = system.open_input_file(root)
        size = self.file.size()
        length = struct.unpack("<Q", self.file.read_at(8, size - 8))[0]
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, size - 8 - length)))
        self.keys = [d[0] for d in self.directory]
        self.held = (-1, [])

    def block(self, i: int) -> list[tuple[str, str]]:
        if self.held[0] != i:
            _, offset, length = self.directory[i]
            text = zlib.decompress(self.file.read_at(length, offset)).decode()
            self.held = (i, [tuple(x.split("\t", 1)) for x in text.split("\n")[:-1]])
        return self.held[1]

    def find(self, key: str) -> Iterator[list]:
        i = max(0, bisect.bisect_left(self.keys, key) - 1)
        while i < len(self.keys) and self.keys[i] <= key:
            lines = self.block(i)
            at = bisect.bisect_left(lines, (key,))
            while at < len(lines) and lines[at][0] == key:
                yield json.loads(lines[at][1])
                at += 1
            i += 1


def keys_of(pages: DataFrame) -> DataFrame:
    """The distinct keys of the urls of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([search_key(u) for u in batch.column(0).to_pylist()], pa.string())], names=["key"])

    return pages.select("url").distinct().mapInArrow(run, "key string").distinct()


def find(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures of the distinct ``keys``: key, page_id, digest, type, file, offset, length.

    The table of files (one row for FILE_CAPTURES captures or a task) is what tasks hold of the index.
    """
    files = sorted(tuple(r) for r in index.select("first", "last", "path").collect())
    firsts, lasts = [f[0] for f in files], [f[1] for f in files]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dealt = []
            for key in batch.column(0).to_pylist():
                i = bisect.bisect_left(lasts, key)
                while i < len(files) and firsts[i] <= key:
                    dealt.append((i, key))
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in dealt], pa.int32()), pa.array([d[1] for d in dealt], pa.string())], names=["part", "key"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, file = -1, None
        for batch in batches:
            found = []
            for p, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if p != part:
                    part, file = p, IndexFile(files[p][2])
                found += [(key, *capture) for capture in file.find(key)]
                if len(found) >= 10_000:
                    yield _captures(found)
                    found = []
            yield _captures(found)

    dealt = keys.select("key").mapInArrow(deal, "part int, key string")
    return dealt.repartition("part").sortWithinPartitions("part", "key").mapInArrow(look, CAPTURE)


RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def read_records(captures: DataFrame) -> DataFrame:
    """The records of captures, read by range in file order. Digest and length of a response are those of the payload read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file = None, None
        for batch in batches:
            out = []
            for name, offset, length in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if name != path:
                    system, root = opened(name)
                    path, file = name, system.open_input_file(root)
                head, payload = parsed(file.read_at(length, offset))
                response = head["WARC-Type"] == "response"
                page, refers, uri = head.get("X-Page-ID"), head.get("X-Refers-To-Page"), head.get("WARC-Target-URI")
                out.append(
                    (
                        int(page) if page else None,
                        unquote(uri) if uri is not None else None,
                        len(payload) if response else int(head["X-Payload-Length"]),
                        base32_sha1(payload) if response else head["WARC-Payload-Digest"].removeprefix("sha1:"),
                        head["WARC-Type"],
                        int(refers) if refers else None,
                        payload if response else None,
                    )
                )
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    stretch = F.floor(F.col("offset") / READ_BYTES)
    ordered = captures.select("file", "offset", "length").repartition("file", stretch).sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, RECORD)
