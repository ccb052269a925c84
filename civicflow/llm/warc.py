"""WARC archives: deduplicating writer and splittable reader (operator 8).

The writer makes one gzip member per record. The reader's tasks each take a
byte range of an archive, search it for gzip magic, accept a candidate only if
its header decodes to a WARC record whose block has the stated length, and own
the records that start inside their range (the last may end beyond it).
Archives lie in the session's shared folder and are reached through
``pyarrow.fs``, so any store that it knows serves.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.session import scratch_path

from .common import fresh_columns, ship, stored, table

MAGIC = b"\x1f\x8b\x08"
#: Bytes of an archive per reading task, and of one read within it.
SPLIT = 8 << 20
CHUNK = 1 << 20
#: Archives are closed at about this many bytes.
ARCHIVE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (or of a plain local path)."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, digest: str, size: int, refers_to, payload: bytes | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit (``payload`` None) without."""
    kind = "revisit" if payload is None else "response"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if payload is None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (payload or b"")
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def classify(pages: DataFrame, key: str = "page_id", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Add payload_digest, payload_bytes, record_type and refers_to to pages.

    Of records with equal payloads of at least ``min_bytes`` bytes the smallest
    key (null last) is the response and the others revisit it; smaller payloads
    are all responses, and so are rows that repeat both key and payload of a response.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)
    digest, size, first, known = fresh_columns(pages, "payload_digest", "payload_bytes", "_first", "_known")
    at = pages.columns.index(html)

    def run(batches):
        for b in batches:
            raw = [(t or "").encode() for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([payload_digest(x) for x in raw], pa.string()),
                 pa.array(list(map(len, raw)), pa.int64())], names=[*b.schema.names, digest, size])

    marked = pages.mapInArrow(run, f"{schema}, `{digest}` string, `{size}` long")
    heads = marked.where(F.col(size) >= min_bytes).groupBy(digest).agg(
        F.min(F.struct(F.col(key).isNull().alias("n"), F.col(key).alias("k"))).alias(first)).withColumn(known, F.lit(True))
    out = marked.join(heads, digest, "left")  # a hot payload is one skewed key, which Spark splits
    revisit = (F.col(size) >= min_bytes) & ~F.col(f"{first}.k").eqNullSafe(F.col(key))
    return out.withColumn("record_type", F.when(revisit, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(revisit, F.col(f"{first}.k"))).drop(first, known)


def write_archives(rows: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write classified pages as .warc.gz files; returns the manifest: path, bytes, records, starts (offset of each record).

    A file gets a new name in every attempt and counts only through the
    manifest, which holds the files of finished tasks, so a task that is lost
    or run twice leaves at most an unread file.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        store, base = open_store(folder)
        out, path, size, starts = None, "", 0, []
        done = []
        for b in batches:
            for r in b.to_pylist():
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    store.create_dir(base, recursive=True)
                    out, size, starts = store.open_output_stream(path, compression=None), 0, []
                payload = None if r["_type"] == "revisit" else (r["_html"] or "").encode()
                m = record(r["_key"], r["_url"], r["_digest"], r["_size"], r["_refers"], payload)
                out.write(m)
                starts.append(size)
                size += len(m)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, size, starts))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, starts))
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{p.rsplit('/', 1)[1]}" for p, _, _ in done], pa.string()),
                                          pa.array([s for _, s, _ in done], pa.int64()),
                                          pa.array([len(x) for _, _, x in done], pa.int64()),
                                          pa.array([x for _, _, x in done], pa.list_(pa.int64()))], names=["path", "bytes", "records", "starts"])

    picked = rows.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(html).alias("_html"),
                         F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_size"),
                         F.col("record_type").alias("_type"), F.col("refers_to").alias("_refers"))
    return stored(picked.mapInArrow(run, "path string, bytes long, records long, starts array<long>"), "warc_manifest")


# ---------------------------------------------------------------- reader

class _Window:
    """Forward reads of a file from any offset, a chunk at a time."""

    def __init__(self, f, size: int):
        self.f, self.size = f, size
        self.at, self.data = 0, b""

    def get(self, offset: int, n: int) -> bytes:
        n = min(n, self.size - offset)
        if n <= 0:
            return b""
        if offset < self.at or offset + n > self.at + len(self.data):
            want = max(n, CHUNK)
            self.f.seek(offset)
            self.at, self.data = offset, self.f.read(min(want, self.size - offset))
        return self.data[offset - self.at:offset - self.at + n]


def parse_member(w: _Window, offset: int, end: int | None = None) -> tuple[dict, bytes, int] | None:
    """Header, block and length of the record whose gzip member starts at ``offset``; None if there is none.

    The header is decoded and judged before anything else of the member is read; it may be of any length.
    """
    flags = w.get(offset, 4)[3:4]
    if not flags or flags[0] & 0xE0:  # reserved gzip flags
        return None
    z, raw, at = zlib.decompressobj(31), bytearray(), offset
    parts: list[bytes] = []
    head = None
    try:
        while not z.eof:
            data = w.get(at, 4096 if head is None and not raw else 65536)
            if not data:
                return None
            at += len(data)
            piece = z.decompress(data)
            if head is None:
                raw += piece
                if raw[:5] != b"WARC/"[:len(raw[:5])]:
                    return None
                cut = raw.find(b"\r\n\r\n", max(0, len(raw) - len(piece) - 3))
                if cut >= 0:
                    head = _header(bytes(raw[:cut]))
                    if head is None:
                        return None
                    parts = [bytes(raw[cut + 4:])]
            else:
                parts.append(piece)
    except zlib.error:
        return None
    if head is None:
        return None
    block = b"".join(parts)
    length = int(head["content-length"])
    if len(block) != length + 4 or block[length:] != b"\r\n\r\n":
        return None
    return head, block[:length], at - len(z.unused_data) - offset


def _header(raw: bytes) -> dict | None:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        return None
    out = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:]))
    return out if "warc-type" in out and out.get("content-length", "").isdigit() else None


def scan_range(w: _Window, lo: int, hi: int) -> Iterator[tuple[int, dict, bytes, int]]:
    """Records that start in [lo, hi): offset, header, block, length."""
    at = lo
    while at < hi:
        data = w.get(at, CHUNK)
        found = data.find(MAGIC)
        if found < 0:
            if len(data) < len(MAGIC) or at + len(data) >= w.size:
                return
            at += len(data) - len(MAGIC) + 1
            continue
        if at + found >= hi:
            return
        got = parse_member(w, at + found)
        if got is None:
            at += found + 1
        else:
            head, block, n = got
            yield at + found, head, block, n
            at += found + n  # bytes inside an accepted member start no record


def read_archives(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """All records of the archives: path, offset, length, record_type, page_id, url, payload_digest,
    payload_bytes, refers_to, payload (null for revisits). One task reads one byte range at a time,
    and fails when it does not find the records that the manifest has there."""
    spark = manifest.sparkSession
    ranges = manifest.select("path", "bytes", "starts", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("lo"))
    ranges = ranges.select("path", "bytes", "lo", F.size(F.filter(
        "starts", lambda x: (x >= F.col("lo")) & (x < F.col("lo") + split))).alias("records"))
    n = manifest.select(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    ranges = ranges.repartition(int(max(n, spark.sparkContext.defaultParallelism)), F.col("path"), F.col("lo"))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                store, path = open_store(r["path"])
                rows, n = [], 0
                with store.open_input_file(path) as f:
                    w = _Window(f, r["bytes"])
                    for offset, head, block, length in scan_range(w, r["lo"], r["lo"] + split):
                        rows.append((r["path"], offset, length, head, block))
                        n += 1
                        if len(rows) == 256:
                            yield _batch(rows)
                            rows = []
                if n != r["records"]:
                    raise RuntimeError(f"{r['path']} from byte {r['lo']}: {n} records read, {r['records']} written")
                yield _batch(rows)

    return ranges.mapInArrow(run, "path string, offset long, length long, record_type string, page_id long, url string, "
                                  "payload_digest string, payload_bytes long, refers_to long, payload binary")


def _batch(rows: list) -> pa.RecordBatch:
    def number(h, k):
        return int(h[k]) if k in h else None

    payloads = [b[b.find(b"\r\n\r\n") + 4:] if h["warc-type"] == "response" else None for _, _, _, h, b in rows]
    heads = [r[3] for r in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.int64()), pa.array([h["warc-type"] for h in heads], pa.string()),
         pa.array([number(h, "x-page-id") for h in heads], pa.int64()),
         pa.array([h.get("warc-target-uri") for h in heads], pa.string()),
         pa.array([payload_digest(p) if p is not None else h["warc-payload-digest"].partition(":")[2]
                   for h, p in zip(heads, payloads, strict=True)], pa.string()),
         pa.array([len(p) if p is not None else number(h, "x-payload-length")
                   for h, p in zip(heads, payloads, strict=True)], pa.int64()),
         pa.array([number(h, "x-refers-to-page-id") for h in heads], pa.int64()),
         pa.array(payloads, pa.binary())],
        names=["path", "offset", "length", "record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to", "payload"])


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
               min_bytes: int = 0, split: int = SPLIT) -> DataFrame:
    """Write pages as WARC archives in the shared folder and read every record back.

    One row per input row, columns as ``read_archives``. Null html counts as
    empty, a null url or key is left out of the record and read as null (keys
    are integers; key null sorts last for the response). Extra columns are not
    written; an empty table gives no archives and no rows.
    """
    spark = pages.sparkSession
    ship(spark)
    rows = classify(pages.select(key, url, html), key, html, min_bytes)
    return read_archives(write_archives(rows, scratch_path(spark, "llm", "warc"), key, url, html), split)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 8 over all pages, from the records read back."""
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
