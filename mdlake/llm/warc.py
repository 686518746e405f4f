"""WARC archives: one gzip member a record, written in parallel and read back sequentially.

Writing: payload digests are grouped (a narrow shuffle) to tell responses from revisits, then every task writes
its own archives to the given shared folder and starts a new one at ARCHIVE_BYTES. The manifest names only the
archives of tasks that succeeded, so a lost executor leaves no half archive in use.
Reading: tasks take whole archives and go through them member by member in small chunks: incremental zlib
decompression, header, block framed by its Content-Length, trailer, then block and payload digests.

Defined cases: null html is an empty payload. Of equal payloads of at least min_bytes the largest page_id is the
response and the others revisit it; rows that repeat that page_id are responses too, and a null page_id comes
last. A null url is written as an empty one. Other columns are ignored; an empty table has no archives.
A damaged archive raises an error that names the file and the record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import IO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 18
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_MANIFEST = "path string, records long, bytes long"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{'none' if refers_to is None else refers_to}>"]
    return "\r\n".join(head).encode() + _END + block + _END


def member(data: bytes, level: int = 6) -> bytes:
    gz = zlib.compressobj(level, zlib.DEFLATED, 31)
    return gz.compress(data) + gz.flush()


class _Members:
    """A stream of gzip members, of which one is open at a time."""

    def __init__(self, stream: IO[bytes]):
        self.stream, self.raw, self.buffer, self.gz = stream, b"", bytearray(), None

    def open(self) -> bool:
        """Go to the next member; False at the end of the stream."""
        self.raw = self.raw or self.stream.read(CHUNK)
        self.gz, self.buffer = zlib.decompressobj(31), bytearray()
        return bool(self.raw)

    def _more(self) -> bool:
        if self.gz.eof:
            return False
        self.raw = self.raw or self.stream.read(CHUNK)
        out = self.gz.decompress(self.raw, CHUNK)
        if not (self.raw or out or self.gz.eof):
            raise ValueError("the archive ends within a member")
        self.buffer += out
        self.raw = self.gz.unused_data if self.gz.eof else self.gz.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        seen = 0
        while (at := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark))
            if not self._more():
                raise ValueError("a header doesn't end")
        out = bytes(self.buffer[:at])
        del self.buffer[: at + len(mark)]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.buffer and not self._more():
                raise ValueError("a block is shorter than its Content-Length")
            part = bytes(self.buffer[:size])
            del self.buffer[: len(part)]
            size -= len(part)
            if part:
                yield part

    def close(self) -> None:
        if b"".join(self.take(len(_END))) != _END or self._drained():
            raise ValueError("a record is longer than its Content-Length")

    def _drained(self) -> bool:
        while not self.buffer and self._more():
            pass
        return bool(self.buffer)


def _fields(head: bytes, first: bytes) -> dict[str, str]:
    line, *rest = head.split(b"\r\n")
    if not line.startswith(first):
        raise ValueError(f"expected {first!r}, found {line[:20]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in rest)}


def _id(text: str) -> int | None:
    inner = text.removeprefix("<urn:page:").removesuffix(">")
    return None if inner == "none" else int(inner)


def read_archive(stream: IO[bytes], name: str = "") -> Iterator[tuple]:
    """The records of an archive in order, as rows of read_archives()."""
    members, n = _Members(stream), 0
    while members.open():
        try:
            warc = _fields(members.until(_END), b"WARC/1.")
            block, payload, http = hashlib.sha1(), hashlib.sha1(), None
            kept, head = [], b""
            for part in members.take(int(warc["content-length"])):
                block.update(part)
                if http is None:
                    head += part
                    if _END not in head:
                        continue
                    top, _, part = head.partition(_END)
                    http = _fields(top, b"HTTP/")
                payload.update(part)
                kept.append(part)
            members.close()
            if http is None:
                raise ValueError("a block has no HTTP header")
            revisit, digest = warc["warc-type"] == "revisit", warc["warc-payload-digest"].removeprefix("sha1:")
            if warc["warc-block-digest"] != "sha1:" + base32(block.digest()):
                raise ValueError("the block digest differs")
            if not revisit and digest != base32(payload.digest()):
                raise ValueError("the payload digest differs")
            body = None if revisit else b"".join(kept)
            if body is not None and len(body) != int(http["content-length"]):
                raise ValueError("the payload length differs")
            yield _id(warc["warc-record-id"]), warc["warc-target-uri"], warc["warc-type"], _id(warc["warc-refers-to"]) if revisit else None, int(http["content-length"]), digest, body
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"{name}, record {n}: {e}") from e
        n += 1


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, level: int = 6) -> DataFrame:
    """Write a record for each row of pages (page_id, url, html) and return the manifest: path, records, bytes.

    folder is a URI that driver and executors share. The archives are written when the manifest is computed.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload")).withColumns({"digest": F.sha1("payload"), "sha256": F.unhex(F.sha2("payload", 256)), "bytes": F.octet_length("payload")})
    same = ["digest", "sha256", "bytes"]  # SHA-1 alone has known collisions
    groups = rows.filter(F.col("bytes") >= min_bytes).groupBy(*same).agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
    marked = rows.join(groups.filter("n > 1").drop("n"), same, "left")
    in_group = (F.col("bytes") >= min_bytes) & F.col("response").isNotNull()
    revisit = F.coalesce(in_group & ~F.col("page_id").eqNullSafe(F.col("response")), F.lit(False))
    marked = marked.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("response")).alias("refers_to"), revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, n, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([size])], names=["path", "records", "bytes"])

        for batch in batches:
            for page_id, url, payload, digest, refers_to, revisit in zip(*batch.columns, strict=True):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    path, n, size = f"{folder}/{name}", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                data = member(record(page_id.as_py(), url.as_py(), payload.as_py(), base32(bytes.fromhex(digest.as_py())), refers_to.as_py(), revisit.as_py()), level)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return marked.mapInArrow(run, _MANIFEST)


def read_archives(manifest: DataFrame) -> DataFrame:
    """The records of all archives of a manifest: page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload."""
    archives = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_stream(name, compression=None) as stream:
                    held, size = [], 0
                    for row in read_archive(stream, path):
                        held.append(row)
                        size += len(row[-1] or b"")
                        if size > (4 << 20) or len(held) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    return manifest.select("path").repartition(archives, "path").mapInArrow(run, _RECORD)
