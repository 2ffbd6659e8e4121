"""WARC archives with a two-level capture index.

Archives: one gzip member per record, so a record is read by its byte range alone. Of records
with equal payloads of at least MIN_REVISIT bytes the one with the smallest id is written
whole (``response``); the others (``revisit``) refer to it and carry its digest.

Index: entries are sorted by reversed-host key and written as compressed blocks of BLOCK_ROWS
entries; each index file ends with the directory of its blocks (first key, offset, length).
A small table names each index file with its first and last key.

Lookup: a key is searched in the file table, in the directory of each file that can hold it,
and in the block that the directory names; then the records are read by range, each stretch
of an archive by one task in the order of its offsets.

A task writes files under names of its own and returns what it wrote; that table is stored at
once. Files of a lost or repeated attempt are in no table and are never read. Files are opened
with pyarrow's file systems, so the folder may be any that they and Spark both know.

Cases: a NULL payload counts as empty; a NULL address has the empty key; a NULL id is written
as such and refers to the smallest id like others; rows that repeat an id and its payload are
the same record type; equal addresses are all returned by a lookup, equal rows as often as
they occur; an empty table gives no archives and no rows; only the three columns are read.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postloom.llm.store import keep
from postloom.session import scratch_path

MIN_REVISIT = 100
BLOCK_ROWS = 512
ARCHIVE_BYTES = 1 << 26
READ_BYTES = 1 << 23
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
FOOTER = "<QQ4s"
MAGIC = b"PLI1"
ENTRY = "key string, page_id bigint, url string, archive string, offset bigint, length bigint"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path inside it."""
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def reversed_host(url: str | None) -> str:
    """Sort key of an address: ``https://blog.Example.com:8080/a?b#c`` is ``com,example,blog:8080)/a?b``.

    Scheme, user, fragment and the usual ports are left out; what has no host stays as it is.
    """
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return url
    if not host:
        return url
    usual = {"http": 80, "https": 443}.get(parts.scheme)
    name = ",".join(reversed(host.split("."))) + (f":{port}" if port and port != usual else "")
    return f"{name}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record, not compressed."""
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http.encode() + (b"" if revisit else payload)
    # A header is one line: what could end it is written as an escape.
    target = json.dumps(url or "", ensure_ascii=False)[1:-1]
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {_record_id(refers_to)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str
    kind: str
    payload_bytes: int
    digest: str
    refers_to: int | None
    payload: bytes | None


def parse_record(data: bytes) -> Record:
    """Read one record; a damaged one raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record does not end where its length says")
    _, _, payload = rest[:size].partition(b"\r\n\r\n")
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"]
    length = int(fields["X-Payload-Length"])
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    number = lambda name: int(fields[name]) if fields.get(name, "") not in ("", "None") else None
    url = json.loads(f'"{fields["WARC-Target-URI"]}"')
    return Record(number("X-Page-ID"), url, kind, length, digest, number("X-Refers-To-Page"), payload if kind == "response" else None)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, first): first is the smallest id of a repeated payload.

    Only the digests that occur more than once are joined back, by a key of which Spark
    splits hot values; payloads move only if that table is too large to broadcast.
    """
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    hashed = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), body.alias("payload"),
        F.sha2(body, 256).alias("digest"),
    )
    large = hashed.filter(F.octet_length("payload") >= MIN_REVISIT).select("page_id", F.col("digest").alias("repeated"))
    firsts = keep(
        large.groupBy("repeated").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("times")).filter("times > 1").drop("times"),
        "repeated-payloads",
    )
    return hashed.join(firsts, F.col("digest") == F.col("repeated"), "left").drop("repeated")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives; the entries (key, page_id, url, archive, offset, length) are stored."""

    def run(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            entries = []
            ids, urls, payloads, digests, firsts = batch.columns
            for i in range(batch.num_rows):
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                page_id, url, first = ids[i].as_py(), urls[i].as_py(), firsts[i].as_py()
                revisit = first is not None and first != page_id
                record = build_record(page_id, url, payloads[i].as_py(), digests[i].as_py(), first, revisit)
                data = gzip.compress(record, LEVEL, mtime=0)
                out.write(data)
                entries.append((reversed_host(url), page_id, url, name, at, len(data)))
                at += len(data)
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*entries) if entries else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "page_id", "url", "archive", "offset", "length"])
        if out is not None:
            out.close()

    return keep(with_revisits(pages, id_col, url_col, payload_col).mapInArrow(run, ENTRY), "captures")


def write_index(entries: DataFrame, folder: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Write the sorted blocks and directories; one row per index file (file, first, last) is stored."""

    def run(batches):
        fs, base = file_system(folder)
        fs.create_dir(base, recursive=True)
        name, out, at, held, directory, last = f"{uuid.uuid4().hex}.idx", None, 0, [], [], ""

        def flush():
            nonlocal at, held
            data = zlib.compress("\n".join(held).encode(), LEVEL)
            directory.append([json.loads(held[0])[0], at, len(data)])
            out.write(data)
            at, held = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                held.append(json.dumps(row))
                last = row[0]
                if len(held) >= block_rows:
                    flush()
        if out is not None:
            if held:
                flush()
            listed = zlib.compress(json.dumps(directory).encode(), LEVEL)
            out.write(listed + struct.pack(FOOTER, at, len(listed), MAGIC))
            out.close()
            columns = [pa.array([x], pa.string()) for x in (name, directory[0][0], last)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "first", "last"])

    # The place of the record makes the order total, so a key that holds a third of all rows is dealt out.
    ordered = entries.select("key", "page_id", "url", "archive", "offset", "length").orderBy("key", "archive", "offset")
    return keep(ordered.mapInArrow(run, "file string, first string, last string"), "index-files")


def read_directory(source: pa.NativeFile) -> list[list]:
    """Blocks of one index file: [first key, offset, length]."""
    size = source.size()
    source.seek(size - struct.calcsize(FOOTER))
    at, length, magic = struct.unpack(FOOTER, source.read(struct.calcsize(FOOTER)))
    if magic != MAGIC:
        raise ValueError("not a capture index")
    source.seek(at)
    return json.loads(zlib.decompress(source.read(length)))


def find_in_file(source: pa.NativeFile, directory: list[list], keys: Iterator[str]) -> Iterator[list]:
    """Entries of the sorted keys: each is searched in the directory, then in its blocks."""
    firsts = [d[0] for d in directory]
    open_block, lines, lines_keys = -1, [], []
    for key in keys:
        block = max(0, bisect.bisect_left(firsts, key) - 1)
        while block < len(directory) and firsts[block] <= key:
            if block != open_block:
                source.seek(directory[block][1])
                lines = [json.loads(x) for x in zlib.decompress(source.read(directory[block][2])).decode().split("\n")]
                lines_keys, open_block = [x[0] for x in lines], block
            for at in range(bisect.bisect_left(lines_keys, key), bisect.bisect_right(lines_keys, key)):
                yield lines[at]
            block += 1


def lookup(spark: SparkSession, index: DataFrame, folder: str, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Entries of all captures of the given addresses, by their reversed-host keys.

    The file table has a row per index file, of which there are at most as many as shuffle
    partitions; it alone goes to the driver and to every task.
    """
    files = index.orderBy("first", "last").collect()
    firsts, lasts, names = ([r[c] for r in files] for c in ("first", "last", "file"))

    def place(batches):
        for batch in batches:
            out = []
            for url in batch.column(0).to_pylist():
                key = reversed_host(url)
                at = bisect.bisect_left(lasts, key)
                while at < len(files) and firsts[at] <= key:
                    out.append((names[at], key))
                    at += 1
            columns = [pa.array(c, pa.string()) for c in (zip(*out) if out else [[]] * 2)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "key"])

    def search(batches):
        fs, base = file_system(folder)
        source, directory, name = None, [], None
        for batch in batches:
            wanted, keys = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(wanted):
                end = at
                while end < len(wanted) and wanted[end] == wanted[at]:
                    end += 1
                if wanted[at] != name:
                    if source is not None:
                        source.close()
                    name, source = wanted[at], fs.open_input_file(f"{base}/{wanted[at]}")
                    directory = read_directory(source)
                found = list(find_in_file(source, directory, keys[at:end]))
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 6, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "page_id", "url", "archive", "offset", "length"])
                at = end
        if source is not None:
            source.close()

    placed = urls.select(F.col(url_col)).mapInArrow(place, "file string, key string").distinct()
    # With a number, adaptive execution does not merge the few small partitions into one task.
    dealt = placed.repartition(max(1, len(files)), "file")
    return dealt.sortWithinPartitions("file", "key").mapInArrow(search, ENTRY)


def reading_tasks(spark: SparkSession, folder: str) -> int:
    """Tasks that read the archives of a folder, by its bytes: entries are too small to tell."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES))


def read_records(entries: DataFrame, folder: str, payload: bool = False) -> DataFrame:
    """Read records by their byte ranges; each stretch of an archive is read by one task, in order.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and the
    payload of responses if asked for.
    """

    def run(batches):
        fs, base = file_system(folder)
        source, name = None, None
        for batch in batches:
            out = []
            for archive, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, fs.open_input_file(f"{base}/{archive}")
                source.seek(offset)
                r = parse_record(gzip.decompress(source.read(length)))
                out.append((r.page_id, r.url, r.payload_bytes, r.digest, r.kind, r.refers_to, r.payload if payload else None))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)
        if source is not None:
            source.close()

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    stretch = F.floor(F.col("offset") / READ_BYTES)
    ranges = entries.select("archive", "offset", "length").repartition(reading_tasks(entries.sparkSession, folder), "archive", stretch)
    read = ranges.sortWithinPartitions("archive", "offset").mapInArrow(run, schema)
    return read if payload else read.drop("payload")


def archive_and_read(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives and index, look up the address of every page, and read what is found."""
    folder = folder or scratch_path(spark, "warc")
    entries = write_archives(pages, folder)
    index = write_index(entries, folder)
    return read_records(lookup(spark, index, folder, pages.select("url")), folder)
