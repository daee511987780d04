"""WARC archives with a two-level capture index.

Writing.  Each page becomes a WARC record in its own gzip member.  Of pages
with equal payloads of at least ``MIN_REVISIT`` bytes (equal SHA-256), the one
with the smallest id is a response and the others are revisits of it without a
block; smaller payloads are always responses.  A task writes files under names
of its own, and only the files named in the rows that Spark commits count, so
what a lost task leaves behind is never read.

Index.  Records are range-sorted by key: the URL with its host reversed, then
the page id.  Each range is a shard file of compressed blocks of ``LINES``
lines, followed by its directory: the first key, place and length of each
block.  The manifest has one row for each shard (its first key, and where its
directory lies), so it is as long as the sort had partitions.

Reading.  Sought keys are range-sorted too; a task finds the shard in the
manifest, the block in the shard's directory and the line in the block by
binary search, reading only these ranges.  The places found are then sorted by
file and offset, and each record is read as a range, unpacked, and checked
against its digest.

The folder must be one that all executors and ``pyarrow.fs`` can open (a
shared file system, HDFS or an object store); it is below
``spark.checkpoint.dir`` unless given.

Null html is an empty payload, null url the key ``-``.  A null page id sorts
last and is read back as null.  Equal ids are kept apart by their digest;
fully equal rows are written and read back as often as they occur, and those
with the smallest id of a payload are all responses.  Extra columns are
ignored; an empty table makes an archive without files.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.llm.common import bounded_batches, by_value, read, table
from tabsmith.session import scratch_dir

MIN_REVISIT = 100
#: Index lines in a block, bytes of a WARC file after which the next one begins, and largest gap that two reads share.
LINES = 1024
FILE_BYTES = 1 << 28
GAP = 1 << 16
#: Bytes of records that a reading task takes.
READ_BYTES = 64 << 20

DATE = "1970-01-01T00:00:00Z"


def surt(url: str | None) -> str:
    """Key of a URL: reversed host, then path and query; scheme, user, fragment and default ports are left out."""
    if url is None:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return ")" + url
    if not host:
        return ")" + url
    port_text = f":{port}" if port and (parts.scheme, port) not in (("http", 80), ("https", 443)) else ""
    return ",".join(reversed(host.split("."))) + port_text + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def capture_key(url: str | None, page_id: int | None, digest: str) -> str:
    """Sorts by URL key, then id, then digest; control characters of the URL cannot break a line."""
    clean = "".join(f"%{ord(c):02X}" if c < " " else c for c in surt(url))
    return f"{clean}\t{'~' if page_id is None else f'{page_id + (1 << 63):020d}'}\t{digest}"


def pack(data: bytes) -> bytes:
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def unpack(data: bytes) -> bytes:
    return zlib.decompress(data, 31)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, n_bytes: int, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no block, but the digest and length of the full payload."""
    revisit = refers_to is not None
    block = b"" if revisit else (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                                 % len(payload)) + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>", f"WARC-Date: {DATE}",
             f"WARC-Target-URI: {''.join(f'%{ord(c):02X}' if c < ' ' else c for c in url or '-')}",
             f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {n_bytes}"]
    lines += [f"Page-ID: {page_id}"] if page_id is not None else []
    lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"Refers-To-Page-ID: {refers_to}"] if revisit else []
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2] if headers["WARC-Type"] == "response" else b""


def _open(root: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(root)


class Archive:
    """Where an archive lies and its manifest: ``(first key, file, directory offset, directory length)`` of every shard."""

    def __init__(self, root: str, manifest: list[tuple[str, str, int, int]]):
        self.root, self.manifest = root, sorted(manifest)


def write(pages: DataFrame, root: str | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> Archive:
    spark = pages.sparkSession
    bounded_batches(spark)
    root = root or scratch_dir(spark, "warc")
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("n_bytes", F.octet_length("payload").cast("long"))
    narrow = rows.where(F.col("n_bytes") >= MIN_REVISIT).select("page_id", "digest")
    first = table(narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
                  .select("digest", "first"), "warc-first")
    # narrow rows find their response; the payloads are joined by their own id, which no other page shares
    revisits = table(narrow.join(first, "digest").where("first IS NOT NULL AND NOT page_id <=> first")
                     .select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), F.col("first").alias("refers_to"))
                     .distinct(), "warc-revisits")
    typed = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    typed = typed.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "digest", "n_bytes", "refers_to")
    lines = pa.schema([("key", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])

    def write_records(batches):
        out, name, at = None, "", 0
        fs = base = None
        try:
            for batch in batches:
                found = []
                for r in batch.to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        else:
                            fs, base = _open(root)
                            fs.create_dir(base, recursive=True)
                        name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    data = pack(record(r["page_id"], r["url"], r["payload"] or b"", r["digest"], r["n_bytes"], r["refers_to"]))
                    out.write(data)
                    found.append((capture_key(r["url"], r["page_id"], r["digest"]), name, at, len(data)))
                    at += len(data)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), lines.types, strict=True)], schema=lines)
        finally:
            if out is not None:
                out.close()

    captures = table(typed.mapInArrow(write_records, "key string, file string, offset long, length long"), "warc-captures")
    shards = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    manifest = table(shards.mapInArrow(lambda b: _write_shard(b, root), "first string, file string, offset long, length long"), "warc-manifest")
    return Archive(root, [tuple(r) for r in manifest.collect()])  # one row for each partition of the sort


def _write_shard(batches, root: str):
    """One shard file: blocks of lines, then the directory."""
    held: list[str] = []
    directory: list[str] = []
    out, name, at = None, f"index-{uuid.uuid4().hex}.gz", 0

    def flush():
        nonlocal at
        data = pack("\n".join(held).encode("utf-8", "surrogatepass"))
        out.write(data)
        directory.append(f"{at}\t{len(data)}\t{held[0]}")
        at += len(data)
        held.clear()

    for batch in batches:
        for r in batch.to_pylist():
            if out is None:
                fs, base = _open(root)
                fs.create_dir(base, recursive=True)
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
                first = r["key"]
            held.append(f"{r['key']}\t{r['file']}\t{r['offset']}\t{r['length']}")
            if len(held) >= LINES:
                flush()
    if out is not None:
        if held:
            flush()
        data = pack("\n".join(directory).encode("utf-8", "surrogatepass"))
        out.write(data)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([name]), pa.array([at]), pa.array([len(data)])],
                                         names=["first", "file", "offset", "length"])


class Reader:
    """Looks keys up in shards, directories and blocks by binary search and range reads; keeps the last of each."""

    def __init__(self, archive: Archive):
        self.archive = archive
        self.fs, self.base = _open(archive.root)
        self.firsts = [m[0] for m in archive.manifest]
        self.shard, self.file, self.places, self.heads = -1, None, [], []
        self.block, self.lines, self.keys = None, [], []

    def _load_shard(self, k: int) -> None:
        if k == self.shard:
            return
        if self.file is not None:
            self.file.close()
        _, name, offset, length = self.archive.manifest[k]
        self.file = self.fs.open_input_file(f"{self.base}/{name}")
        entries = [e.split("\t", 2) for e in unpack(self.file.read_at(length, offset)).decode("utf-8", "surrogatepass").split("\n")]
        self.places = [(int(a), int(b)) for a, b, _ in entries]
        self.heads = [line.rsplit("\t", 3)[0] for _, _, line in entries]
        self.shard, self.block = k, None

    def _load_block(self, b: int) -> None:
        if b != self.block:
            at, size = self.places[b]
            self.lines = [x.rsplit("\t", 3) for x in unpack(self.file.read_at(size, at)).decode("utf-8", "surrogatepass").split("\n")]
            self.keys = [x[0] for x in self.lines]
            self.block = b

    def captures(self, low: str, high: str) -> Iterator[tuple[str, str, int, int]]:
        """All captures with ``low <= key <= high``: key, file, offset, length."""
        k = max(0, bisect.bisect_left(self.firsts, low) - 1)
        while k < len(self.firsts) and self.firsts[k] <= high:
            self._load_shard(k)
            b = max(0, bisect.bisect_left(self.heads, low) - 1)
            while b < len(self.heads) and self.heads[b] <= high:
                self._load_block(b)
                for x in self.lines[bisect.bisect_left(self.keys, low):bisect.bisect_right(self.keys, high)]:
                    yield x[0], x[1], int(x[2]), int(x[3])
                b += 1
            k += 1


def locate(keys: DataFrame, archive: Archive) -> DataFrame:
    """``(key, file, offset, length)`` of every capture whose key is among the distinct strings of column ``key``."""
    held = by_value(keys.sparkSession, archive)

    def run(batches):
        reader = None
        for batch in batches:
            reader = reader or Reader(held())
            got = [x for key in batch.column(0).to_pylist() for x in reader.captures(key, key)]
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*got, strict=True)], names=["key", "file", "offset", "length"])

    sought = keys.select("key").where("key IS NOT NULL").distinct()
    parts = max(keys.sparkSession.sparkContext.defaultParallelism, len(archive.manifest))
    return (sought.repartitionByRange(parts, "key").sortWithinPartitions("key")
            .mapInArrow(run, "key string, file string, offset long, length long"))


def captures_of(urls: DataFrame, archive: Archive, url_col: str = "url") -> DataFrame:
    """``(url, key, file, offset, length)`` of all captures of every distinct URL."""
    held = by_value(urls.sparkSession, archive)

    def run(batches):
        reader = None
        for batch in batches:
            reader = reader or Reader(held())
            for url in batch.column(0).to_pylist():
                low = capture_key(url, None, "")[:-2]
                got = [(url, *x) for x in reader.captures(low, low + "\x7f")]
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*got, strict=True)],
                                                     names=["url", "key", "file", "offset", "length"])

    return urls.select(F.col(url_col).alias("url")).distinct().mapInArrow(run, "url string, key string, file string, offset long, length long")


def fetch(places: DataFrame, archive: Archive, payloads: bool = False) -> DataFrame:
    """The records at ``(file, offset, length)``, checked against their digests (a bad one raises ValueError).

    ``(page_id, url, payload_bytes, payload_digest, record_type, refers_to)`` and, if asked for, ``payload``
    (null for a revisit).
    """
    root = archive.root
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads
    schema = pa.schema(fields)

    def row(data: bytes) -> tuple:
        headers, payload = parse(unpack(data))
        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {headers['WARC-Record-ID']} does not have its digest")
        number = [int(headers[n]) if n in headers else None for n in ("Page-ID", "Refers-To-Page-ID")]
        n_bytes = len(payload) if kind == "response" else int(headers["Payload-Length"])
        return (number[0], headers["WARC-Target-URI"], n_bytes, digest, kind, number[1],
                *([payload if kind == "response" else None] if payloads else []))

    def run(batches):
        fs, base = _open(root)
        name, file = None, None
        for batch in batches:
            rows = batch.to_pylist()
            out, k = [], 0
            while k < len(rows):
                if rows[k]["file"] != name:
                    if file is not None:
                        file.close()
                    name, file = rows[k]["file"], fs.open_input_file(f"{base}/{rows[k]['file']}")
                start, stop, j = rows[k]["offset"], rows[k]["offset"] + rows[k]["length"], k + 1
                while j < len(rows) and rows[j]["file"] == name and rows[j]["offset"] - stop <= GAP:  # neighbours share a read
                    stop = max(stop, rows[j]["offset"] + rows[j]["length"])
                    j += 1
                data = file.read_at(stop - start, start)
                out += [row(data[r["offset"] - start:r["offset"] - start + r["length"]]) for r in rows[k:j]]
                k = j
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), schema.types, strict=True)], schema=schema)
        if file is not None:
            file.close()

    kinds = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    # rows of some bytes stand for records of any size: the number of tasks follows the bytes to be read
    spark = places.sparkSession
    sought = table(places.select("file", "offset", "length"), "warc-places")
    size = sought.agg(F.sum("length")).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // READ_BYTES))
    return (sought.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
            .mapInArrow(run, kinds + (", payload binary" if payloads else "")))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    archive = write(pages)
    html = F.coalesce("html", F.lit("")).cast("binary")

    def run(batches):
        for batch in batches:
            keys = [capture_key(*r) for r in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"])
    keys = pages.select("url", "page_id", F.sha2(html, 256)).mapInArrow(run, "key string")
    return fetch(locate(keys, archive), archive).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100
"""
