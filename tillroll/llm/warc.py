"""WARC archives of pages with a two-level capture index.

Write: each task writes its rows as records, a gzip member each, to an archive of its own in the shared
folder.  Of pages with equal payloads of at least ``MIN_REVISIT_BYTES``, the one with the largest id
is a ``response``; the others are ``revisit`` records (identical payload digest) that refer to it.  Which
page is which is decided on (id, digest) rows; pages move once, to meet that decision.

Index: captures are sorted by key (reversed-host URL, tab, page id) over many tasks.  Each writes
compressed blocks of ``BLOCK_LINES`` lines and, after them, a sparse directory of the blocks' first keys.
One row a file (its first key) makes the upper level.

Read: sorted keys are looked up by binary search over the files, then the file's directory, then the
block, which is one range read.  The places found are put in archive order, neighbours are fetched
in one range read, records are parsed and their payload digests checked.

Files go through the file system of the shared folder's URI, which every executor reaches.  A task that
dies leaves files that no table names; its second attempt writes new ones.

Defined results: a null html is an empty payload.  A null or odd url has the key of an empty host or of
its own text.  A null page id is always a response and comes back null.  Rows that share id and
payload share their record type, a record for each.  Extra columns are ignored, whatever their
names.  An empty table gives no archive and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import new_folder, staged

MIN_REVISIT_BYTES = 1000
BLOCK_LINES = 512
ARCHIVE_BYTES = 1 << 30   # a task's archive is closed and a new one begun beyond that
TASK_BYTES, LEAST_TASK_BYTES = 128 << 20, 1 << 20  # archive bytes read back by a task
READ_BYTES = 4 << 20      # neighbouring records are read together up to that
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"  # the table has no capture times
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEP = "\x1f"
CAPTURE = "key string, archive string, offset long, length long"


def url_key(url: str | None) -> str:
    """``https://www.Example.com:8080/a?b`` -> ``com,example:8080)/a?b``; control characters are quoted."""
    text = (url or "").strip()
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        parts, host, port = None, "", None
    if not host:
        return quote(text, safe="/:?#[]@!$&'()*+,;=%~ ")
    host = ",".join(reversed(host.removeprefix("www.").split(".")))
    port_text = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return host + port_text + ")" + quote(rest, safe="/:?#[]@!$&'()*+,;=%~")


def capture_key(url: str | None, page_id: int | None) -> str:
    return url_key(url) + "\t" + ("" if page_id is None else str(page_id))


def _file_system(uri: str):
    """(pyarrow file system, path) of a qualified URI."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder's URI with its scheme, created."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path)
    return store.makeQualified(path).toString()


def _record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), ("WARC-Date", DATE), *headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A page's response record, or its revisit record where ``refers_to`` names the response's page."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    headers = [("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("Content-Type", "application/http;msgtype=response")]
    if url:
        headers.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~")))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _record("response", headers, http + payload)
    return _record("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")], http)


def parse_record(raw: bytes) -> dict:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload) of a record; checks the
    length and, for responses, the digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        text = fields.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    return {"page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"), "payload": payload}


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) to archives in ``folder``; the captures (key, archive, offset,
    length) as a written table."""
    spark = pages.sparkSession
    root = _qualified(spark, folder)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"),
                     F.sha1(html).alias("digest"))
    large = p.where(F.octet_length("payload") >= MIN_REVISIT_BYTES).select("page_id", "digest")
    last = (large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("first"))
            .where("first < refers_to").select("digest", "refers_to"))
    revisits = large.join(last, "digest").where("page_id < refers_to").distinct()
    rows = p.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = _file_system(root)
        out, name, at = None, "", 0
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64).to_pydict()
                found = {"key": [], "archive": [], "offset": [], "length": []}
                for page_id, url, payload, refers_to in zip(*part.values()):
                    if out is None or at > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"pages-{uuid.uuid4().hex}.warc.gz"
                        out, at = store.open_output_stream(f"{base}/{name}", compression=None), 0
                        info = _gzip(_record("warcinfo", [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Filename", name),
                                                          ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                        out.write(info)
                        at += len(info)
                    member = _gzip(page_record(page_id, url, payload, refers_to))
                    out.write(member)
                    for k, v in zip(found, (capture_key(url, page_id), name, at, len(member))):
                        found[k].append(v)
                    at += len(member)
                yield pa.RecordBatch.from_pydict(found)
        if out is not None:
            out.close()

    return staged(rows.mapInArrow(run, CAPTURE), "captures")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Sorted blocks and their directories in ``folder``; one row (first, file) an index file, written."""
    root = _qualified(captures.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = _file_system(root)
        out, at, lines, directory, name = None, 0, [], [], f"index-{uuid.uuid4().hex}.cdx"

        def flush():
            nonlocal at, lines
            block = zlib.compress("\n".join(lines).encode(), LEVEL)
            out.write(block)
            directory.append(f"{lines[0].partition(SEP)[0]}{SEP}{at}{SEP}{len(block)}")
            at += len(block)
            lines = []

        for batch in batches:
            for row in zip(*batch.to_pydict().values()):
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                lines.append(SEP.join(map(str, row)))
                if len(lines) == BLOCK_LINES:
                    flush()
        if out is not None:
            if lines:
                flush()
            packed = zlib.compress("\n".join(directory).encode(), LEVEL)
            out.write(packed + at.to_bytes(8, "big") + len(packed).to_bytes(8, "big"))
            out.close()
            yield pa.RecordBatch.from_pydict({"first": [directory[0].partition(SEP)[0]], "file": [name]})

    rows = captures.select("key", "archive", "offset", "length")
    return staged(rows.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, "first string, file string"), "index-files")


class _IndexFile:
    """One index file's directory, and the block read last."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        end = self.file.size()
        at, n = (int.from_bytes(x, "big") for x in (self.file.read_at(8, end - 16), self.file.read_at(8, end - 8)))
        rows = [x.split(SEP) for x in zlib.decompress(self.file.read_at(n, at)).decode().split("\n")]
        self.first, self.place = [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]
        self.block, self.keys, self.lines = -1, [], []

    def captures(self, key: str) -> Iterator[list[str]]:
        """The lines of a key: from the last block that starts before it to the first that starts after."""
        b = max(0, bisect.bisect_left(self.first, key) - 1)
        while b < len(self.first) and self.first[b] <= key:
            if b != self.block:
                at, n = self.place[b]
                self.lines = [x.split(SEP) for x in zlib.decompress(self.file.read_at(n, at)).decode().split("\n")]
                self.keys, self.block = [x[0] for x in self.lines], b
            lo = bisect.bisect_left(self.keys, key)
            while lo < len(self.keys) and self.keys[lo] == key:
                yield self.lines[lo]
                lo += 1
            b += 1


def look_up(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """The captures of distinct keys (key), by binary search.  The upper level, a row an index file, has
    at most as many rows as the index was written by tasks."""
    root = _qualified(keys.sparkSession, folder)
    files = sorted((r["first"], r["file"]) for r in index.collect())

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = _file_system(root)
        firsts, opened = [f for f, _ in files], {}
        for batch in batches:
            found = []
            for key in batch.column(0).to_pylist():
                f = max(0, bisect.bisect_left(firsts, key) - 1)
                while f < len(firsts) and firsts[f] <= key:
                    if f not in opened:
                        if len(opened) > 8:  # keys come sorted: earlier files are done with
                            opened.clear()
                        opened[f] = _IndexFile(store, f"{base}/{files[f][1]}")
                    found += opened[f].captures(key)
                    f += 1
            yield pa.RecordBatch.from_pydict({"key": [x[0] for x in found], "archive": [x[1] for x in found],
                                              "offset": [int(x[2]) for x in found], "length": [int(x[3]) for x in found]},
                                             schema=pa.schema([("key", pa.string()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    return keys.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(run, CAPTURE)


def read_records(captures: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records at captures (archive, offset, length), read in archive order, neighbours together."""
    root = _qualified(captures.sparkSession, folder)
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(),
             "refers_to": pa.int64()} | ({"payload": pa.binary()} if with_payload else {})
    schema = pa.schema(list(kinds.items()))

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = _file_system(root)
        name, file = None, None
        for batch in batches:
            rows = list(zip(*batch.to_pydict().values()))
            i = 0
            while i < len(rows):
                archive, start, n = rows[i]
                j, end = i + 1, start + n
                while j < len(rows) and rows[j][0] == archive and rows[j][1] == end and end - start < READ_BYTES:
                    end += rows[j][2]
                    j += 1
                if archive != name:
                    name, file = archive, store.open_input_file(f"{base}/{archive}")
                data = file.read_at(end - start, start)
                records = [parse_record(zlib.decompress(data[o - start:o - start + m], 31)) for _, o, m in rows[i:j]]
                yield pa.RecordBatch.from_pydict({k: [r[k] for r in records] for k in kinds}, schema=schema)
                i = j

    # Tasks by the bytes that they will read: the captures themselves are small, and would be put into one task.
    total = captures.agg(F.sum("length")).first()[0] or 0
    cores = captures.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, math.ceil(total / TASK_BYTES), min(2 * cores, total // LEAST_TASK_BYTES))
    ordered = (captures.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")
               .sortWithinPartitions("archive", "offset"))
    return ordered.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
                              + ", payload binary" * with_payload)


def capture_keys(pages: DataFrame) -> DataFrame:
    """The distinct capture keys of rows (page_id, url)."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"key": pa.array([capture_key(u, i) for i, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], pa.string())})

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(run, "key string").distinct()


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive, index, look up every page's key, and read the records back."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    index = write_index(write_archives(pages, folder), folder)
    found = staged(look_up(capture_keys(pages), index, folder), "found")
    return read_records(found, folder)
