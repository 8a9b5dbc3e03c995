"""WARC archives: a writer, and a sequential reader.

One gzip member per record. The reader walks an archive as a stream: members are
inflated incrementally, a record is framed by its Content-Length, and each full
payload is held against its digest. Archives lie in the shared folder; a task
writes files under names of its own, and only the manifest rows of tasks that
succeeded count, so a lost executor leaves orphans that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, shared_dir, with_group_value

CRLF = b"\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
#: Bytes after which a task begins a new archive, and bytes read at a time.
ROLL_BYTES, CHUNK = 256 << 20, 1 << 18
RECORDS = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, path string"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, level: int) -> bytes:
    """One gzip member that holds one record. The HTTP head of a revisit tells the full payload's length."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: <urn:page:%s>" % (b"" if page_id is None else str(page_id).encode()),
        b"WARC-Date: " + DATE.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"WARC-Payload-Digest: sha1:" + digest(payload).encode(),
        b"Content-Length: %d" % len(block),
    ]
    if url is not None:
        head.insert(3, b"WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]").encode())
    if revisit:
        head += [b"WARC-Refers-To: <urn:page:%d>" % refers_to, b"WARC-Profile: " + PROFILE.encode()]
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(CRLF.join(head) + CRLF + CRLF + block + CRLF + CRLF) + z.flush()


def write_archives(pages: DataFrame, level: int = 1) -> DataFrame:
    """Writes a record per row (page_id, url, html) and returns the manifest: path, n_records, n_bytes.

    Of rows with equal payloads that with the largest page_id is the response and
    the others revisit it; rows that repeat it exactly, and all rows of a payload
    without any page_id, are responses too. A null html is the empty payload. A
    null url gives a record without target. Extra columns are ignored.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), body.alias("html")).withColumn("gk", F.unhex(F.sha1("html")))
    groups = checkpoint(rows.groupBy("gk").agg(F.max("page_id").alias("resp"), F.count(F.lit(1)).alias("cnt")).where("cnt > 1"))
    placed = with_group_value(rows, groups, "gk", "cnt")
    revisit = F.col("resp").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("resp"))
    placed = placed.select("page_id", "url", "html", F.coalesce(revisit, F.lit(False)).alias("revisit"), "resp")
    folder = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"

    def write(batches):
        store, base = fs.FileSystem.from_uri(folder)
        out, path, n, size = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page_id, url, html, rev, resp in zip(*(batch[c].to_pylist() if c != "html" else batch[c] for c in ("page_id", "url", "html", "revisit", "resp")), strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out, path, n, size = store.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0, 0
                member = record(page_id, url, html.as_py(), resp, rev, level)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= ROLL_BYTES:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        cols = list(zip(*done, strict=True)) if done else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "n_records", "n_bytes"])

    return checkpoint(placed.mapInArrow(write, "path string, n_records long, n_bytes long"))


def members(stream, path: str) -> Iterator[bytes]:
    """The inflated records of an archive, one gzip member at a time; the file is never held as a whole."""
    rest, z, parts = b"", None, []
    while True:
        chunk = rest or stream.read(CHUNK)
        rest = b""
        if not chunk:
            if z is not None:
                raise ValueError(f"{path}: the last gzip member is cut off")
            return
        if z is None:
            z, parts = zlib.decompressobj(31), []
        try:
            parts.append(z.decompress(chunk))
        except zlib.error as e:
            raise ValueError(f"{path}: {e}") from e
        if z.eof:
            yield b"".join(parts)
            rest, z = z.unused_data, None


def _head(data: bytes, path: str) -> tuple[list[bytes], int]:
    end = data.find(CRLF + CRLF)
    if end < 0:
        raise ValueError(f"{path}: a head without end")
    return data[:end].split(CRLF), end + 4


def _number(urn: str) -> int | None:
    own = urn.strip().removeprefix("<urn:page:").removesuffix(">")
    return int(own) if own else None


def parse(data: bytes, path: str) -> dict:
    """A record of an archive; raises ValueError if its framing or its payload digest is wrong."""
    lines, at = _head(data, path)
    if not lines[0].startswith(b"WARC/"):
        raise ValueError(f"{path}: not a WARC record")
    head = {k.strip().lower().decode(): v.strip().decode() for k, _, v in (x.partition(b":") for x in lines[1:])}
    length = int(head["content-length"])
    block = data[at : at + length]
    if len(block) != length or data[at + length :] != CRLF + CRLF:
        raise ValueError(f"{path}: the block isn't framed by its Content-Length")
    http, body = _head(block, path)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in http[1:])}
    payload, full = block[body:], int(fields[b"content-length"])
    kind, said = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != full or digest(payload) != said):
        raise ValueError(f"{path}: the payload doesn't match its digest")
    return {
        "page_id": _number(head["warc-record-id"]),
        "url": head.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _number(head["warc-refers-to"]) if kind == "revisit" else None,
        "payload": payload if kind == "response" else None,
        "payload_bytes": full,
        "payload_digest": said,
        "path": path,
    }


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of the archives in ``path``, one task per archive, each read once from start to end."""

    def read(batches):
        names = [x.split()[0] for x in RECORDS.split(", ")]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types, strict=True)], names=names)

        for batch in batches:
            for uri in batch["path"].to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for data in members(stream, uri):
                        rows.append(parse(data, uri))
                        size += len(data)
                        if size > 4 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(read, RECORDS)
