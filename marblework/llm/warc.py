"""WARC archives: a writer with revisits, and a splittable reader.

The writer gives each row a gzip member of its own.  Rows with equal payloads of
at least ``min_bytes`` share one response record, that of the largest id; the
others become revisit records that refer to it.  Tasks write files of their own
under names never used before, and only files of tasks that Spark committed get
into the manifest, so a task that is lost and repeated leaves nothing behind
that a reader would see.

The reader cuts files into byte ranges.  A task looks for gzip magic from its
range's start, takes a place for a member only if it inflates to a WARC header,
and reads on member by member as long as they begin inside its range.

Equal payloads are those of equal SHA-256; the digest in a record is SHA-1, as
the format has it.  Owners are found from digests alone and written, so the join
that brings them to the payloads is one that Spark splits where very many pages
are equal.

Null payload is empty.  Ids are integers; null ids, and others that are no
integer, are written without an id and read back as null; they are never referred
to.  Rows that repeat an id with equal payload are
all responses if the id is the largest.  An empty table makes no file and no
record.  Records of any length are read whole.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marblework.llm.common import cut, pieces, release, ship

MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 20
_BREAK = re.compile(r"[\x00-\x20]")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, digest_: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record, not yet compressed."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _BREAK.sub(lambda m: f"%{ord(m[0]):02X}", url))
    head += ["Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest_}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(df: DataFrame, folder: str, min_bytes: int = 0, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives below ``folder`` (any URI that pyarrow opens); the manifest: path, bytes, records.

    The manifest is written to the shared folder when this returns.
    """
    ship(df.sparkSession)
    raw = F.coalesce(df[payload_column], F.lit("")).cast("binary")
    rows = df.select(df[id_column].try_cast("long").alias("page"), df[url_column].cast("string").alias("url"), raw.alias("payload")).withColumn("sha", F.unhex(F.sha2("payload", 256)))
    owner = cut(rows.filter(F.length("payload") >= min_bytes).groupBy("sha").agg(F.max("page").alias("owner"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    refers = F.when(F.length("payload") >= min_bytes, F.when(F.col("page") < F.col("owner"), F.col("owner")))
    ready = rows.join(owner, "sha", "left").select("page", "url", "payload", refers.alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, n = None, None, 0, 0
        try:
            for batch in pieces(batches, 64):
                if batch.num_rows and out is None:
                    place, at = fs.FileSystem.from_uri(folder)
                    place.create_dir(at, recursive=True)
                    path = f"pages-{uuid.uuid4().hex}.warc.gz"
                    out = place.open_output_stream(f"{at}/{path}", compression=None)
                for page, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    press = zlib.compressobj(6, zlib.DEFLATED, 31)
                    member = press.compress(record(page, url, payload, digest(payload), refers_to, date)) + press.flush()
                    out.write(member)
                    size, n = size + len(member), n + 1
        finally:
            if out is not None:
                out.close()
        if out is not None:
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{path}"], "bytes": [size], "records": [n]})

    manifest = cut(ready.mapInArrow(run, "path string, bytes long, records long"))
    release(owner)
    return manifest


def members(read, size: int, start: int, end: int) -> Iterator[bytes]:
    """The inflated members that begin in [start, end) of a file of ``size`` bytes; ``read(at, n)`` gives its bytes."""
    at, known = start, start == 0
    while at < end:
        if not known:
            at = next_member(read, size, at, end)
            if at is None:
                return
        got = inflate(read, size, at)
        if got is None:
            at, known = at + 1, False
            continue
        content, at = got
        known = True
        yield content


def next_member(read, size: int, at: int, end: int) -> int | None:
    """The first place from ``at`` and before ``end`` whose member inflates to a WARC header."""
    while at < end:
        window = read(at, min(_READ, end - at + len(MAGIC) - 1))
        i = window.find(MAGIC)
        while i >= 0 and at + i < end:
            press = zlib.decompressobj(31)
            try:
                if press.decompress(read(at + i, 4096), 64).startswith(b"WARC/"):
                    return at + i
            except zlib.error:
                pass
            i = window.find(MAGIC, i + 1)
        at += max(1, len(window) - len(MAGIC) + 1)
    return None


def inflate(read, size: int, at: int) -> tuple[bytes, int] | None:
    """A whole member and where it ends; None if it is broken."""
    press, out = zlib.decompressobj(31), []
    try:
        while not press.eof:
            if at >= size or not (raw := read(at, _READ)):
                return None
            out.append(press.decompress(raw))
            at += len(raw)
    except zlib.error:
        return None
    return b"".join(out), at - len(press.unused_data)


def parse(content: bytes) -> dict:
    """The fields of one record; a response's payload is digested anew."""
    head, _, block = content.partition(b"\r\n\r\n")
    said = {k.lower(): v for k, _, v in (x.partition(": ") for x in head.decode().split("\r\n")[1:])}
    block = block[: int(said["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda name: int(v) if (v := re.sub(r"\D", "", said.get(name, ""))) else None
    kind = said["warc-type"]
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    if kind == "response" and len(payload) != length:
        raise ValueError(f"the payload has {len(payload)} of {length} bytes")
    sign = -1 if "<urn:page:-" in said["warc-record-id"] else 1
    page = number("warc-record-id")
    return {
        "page_id": None if page is None else sign * page,
        "url": said.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
        "payload_bytes": length,
        "payload_digest": digest(payload) if kind == "response" else said["warc-payload-digest"].removeprefix("sha1:"),
        "record_type": kind,
        "refers_to": (-1 if "<urn:page:-" in said["warc-refers-to"] else 1) * number("warc-refers-to") if kind == "revisit" else None,
    }


def read(manifest: DataFrame, split_bytes: int = 32 << 20, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to."""
    ship(manifest.sparkSession)
    ranges = manifest.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    tasks = max(1, ranges.count())
    fields = ["page_id", "url", *["payload"] * with_payload, "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    arrow = pa.schema([(f, kinds[f]) for f in fields])
    ddl = ", ".join(f"{f} {'long' if kinds[f] == pa.int64() else 'binary' if kinds[f] == pa.binary() else 'string'}" for f in fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place, at = fs.FileSystem.from_uri(path)
                with place.open_input_file(at) as f:
                    rows, held = [], 0
                    for content in members(lambda i, n, f=f, size=size: f.read_at(min(n, size - i), i), size, start, min(size, start + split_bytes)):
                        rows.append(parse(content))
                        held += len(content)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist([{k: r[k] for k in fields} for r in rows], schema=arrow)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([{k: r[k] for k in fields} for r in rows], schema=arrow)

    return ranges.repartition(tasks).mapInArrow(run, ddl)
