"""WARC archives compressed record by record with Zstandard and a shared dictionary (.warc.zst).

An archive begins with a skippable frame that holds the dictionary, itself compressed if that is smaller; every record
is a frame of its own. The reader takes the dictionary from there, decodes one frame at a time from a stream, and
checks each record: version line, header syntax, required headers, lengths of block and payload, and payload digest.

Pages with equal payloads are stored once: the largest page_id's record is the response, the others are revisits that
carry the HTTP head alone. Payload counts are summed before the shuffle; only payloads that occur more than once go
into the join.

Archives are written under names of the task's own and listed in a written manifest; readers follow the manifest, so
nothing that a lost or repeated task left behind is read.

Defined results: a null html is an empty payload, and empty payloads are equal to each other; a null url gives no
target header; control characters in urls are percent-encoded; rows with equal page_id and payload are the same page,
each a response if the page is; a null page_id is written as such and is a response only if no equal payload has an id;
an empty table gives no archives; extra columns are ignored. A damaged archive raises ``WarcError``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen, joined_small, materialize, open_store, shared_dir

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
LEVEL = 3
DICTIONARY_BYTES = 32_768
#: Records that a dictionary is trained on, and their bytes at most.
SAMPLES, SAMPLE_BYTES = 200, 1_500_000
#: Uncompressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 128_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
_HEADER = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*(.*)", re.S)
_REQUIRED = (b"warc-type", b"warc-record-id", b"warc-date", b"content-length")


class WarcError(ValueError):
    """An archive or record that breaks the format."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record; a revisit's block ends after the HTTP head, whose Content-Length is the full payload's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head += [f"WARC-Payload-Digest: sha1:{payload_digest(payload)}", "Content-Type: application/http;msgtype=response"]
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]):
    """A dictionary from sample records; where they are too few to train on, their own bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def dictionary_frame(raw: bytes) -> bytes:
    import zstandard

    packed = zstandard.ZstdCompressor(level=19).compress(raw)
    body = packed if len(packed) < len(raw) else raw
    return struct.pack("<II", SKIPPABLE, len(body)) + body


class ArchiveWriter:
    """Writes records to a stream as one archive."""

    def __init__(self, stream):
        self.stream, self.waiting, self.compressor = stream, [], None
        self.records = self.raw_bytes = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        self.raw_bytes += len(record)
        if self.compressor is None:
            self.waiting.append(record)
            if len(self.waiting) >= SAMPLES or self.raw_bytes >= SAMPLE_BYTES:
                self._begin()
        else:
            self.stream.write(self.compressor.compress(record))

    def _begin(self) -> None:
        import zstandard

        dictionary = train(self.waiting)
        self.stream.write(dictionary_frame(dictionary.as_bytes()))
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
        for record in self.waiting:
            self.stream.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> None:
        if self.compressor is None:
            self._begin()
        self.stream.close()


def read_frames(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time."""
    import zstandard

    def take(held: bytes, n: int) -> bytes:
        while len(held) < n:
            more = stream.read(max(chunk, n - len(held)))
            if not more:
                raise WarcError("the archive ends inside a frame")
            held += more
        return held

    held = take(b"", 8)
    magic, size = struct.unpack_from("<II", held)
    if magic != SKIPPABLE:
        raise WarcError("the archive does not begin with a dictionary frame")
    held = take(held, 8 + size)
    raw, held = held[8 : 8 + size], held[8 + size :]
    if raw[:4] == struct.pack("<I", ZSTD_MAGIC):
        raw = zstandard.ZstdDecompressor().decompress(raw)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    while True:
        held = held or stream.read(chunk)
        if not held:
            return
        frame, parts = decompressor.decompressobj(), []
        try:
            while not frame.eof:
                held = held or stream.read(chunk)
                if not held:
                    raise WarcError("the archive ends inside a frame")
                parts.append(frame.decompress(held))
                held = frame.unused_data if frame.eof else b""
        except zstandard.ZstdError as e:
            raise WarcError(f"a frame cannot be decoded: {e}") from e
        yield b"".join(parts)


def _headers(lines: list[bytes]) -> dict[bytes, bytes]:
    out: dict[bytes, bytes] = {}
    for line in lines:
        m = _HEADER.fullmatch(line)
        if not m:
            raise WarcError(f"not a header: {line[:80]!r}")
        out[m[1].lower()] = m[2].strip()
    return out


def _length(headers: dict[bytes, bytes]) -> int:
    value = headers.get(b"content-length", b"")
    if not value.isdigit():
        raise WarcError("Content-Length is missing or not a number")
    return int(value)


def _page(value: bytes) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+|null)>", value)
    if not m:
        raise WarcError(f"not a record id: {value[:80]!r}")
    return None if m[1] == b"null" else int(m[1])


def parse_record(frame: bytes) -> dict:
    """A checked record as a dict of page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload."""
    head, gap, rest = frame.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or lines[0] != VERSION:
        raise WarcError("not a record of the expected version")
    headers = _headers(lines[1:])
    if missing := [h for h in _REQUIRED if h not in headers]:
        raise WarcError(f"missing header {missing[0].decode()}")
    size = _length(headers)
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError("the block's length is not what its header says")
    kind = headers[b"warc-type"]
    if kind not in (b"response", b"revisit"):
        raise WarcError(f"unknown record type {kind[:40]!r}")
    http, gap, payload = rest[:size].partition(b"\r\n\r\n")
    http_lines = http.split(b"\r\n")
    if not gap or not http_lines[0].startswith(b"HTTP/"):
        raise WarcError("the block is not an HTTP response")
    full = _length(_headers(http_lines[1:]))
    digest = headers.get(b"warc-payload-digest", b"")
    if not digest.startswith(b"sha1:"):
        raise WarcError("no payload digest")
    revisit = kind == b"revisit"
    if revisit:
        if payload or b"warc-refers-to" not in headers or b"warc-profile" not in headers:
            raise WarcError("not a revisit of an identical payload")
    elif len(payload) != full or payload_digest(payload).encode() != digest[5:]:
        raise WarcError("the payload is not what its headers say")
    uri = headers.get(b"warc-target-uri")
    return {
        "page_id": _page(headers[b"warc-record-id"]), "url": None if uri is None else uri.decode(), "record_type": kind.decode(),
        "refers_to": _page(headers[b"warc-refers-to"]) if revisit else None, "payload_bytes": full, "payload_digest": digest[5:].decode(), "payload": None if revisit else payload,
    }


def assign_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html and ``first``: the page_id of the response, null for a payload of its own."""
    rows = chosen(pages, "page_id", "url", "html").select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    shared = rows.filter(F.octet_length("html") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = materialize(shared.filter("n > 1 and first is not null").select("sha1", "first"), "shared-payloads")
    out = joined_small(rows, shared, "sha1")
    return out.select("page_id", "url", "html", "first")


def write_archives(pages: DataFrame, out: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Write a record per row of pages (page_id, url, html); the written manifest: folder, path, records, raw_bytes."""
    folder = out or shared_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        writer, path, rows = None, "", []

        def done() -> None:
            writer.close()
            rows.append({"folder": folder, "path": path, "records": writer.records, "raw_bytes": writer.raw_bytes})

        for batch in batches:
            for page_id, url, html, first in zip(*(batch.column(c) for c in ("page_id", "url", "html", "first"))):
                if writer is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(store.open_output_stream(path))
                page, of = page_id.as_py(), first.as_py()
                writer.add(record_bytes(page, url.as_py(), html.as_py().encode(), of, of is not None and of != page))
                if writer.raw_bytes >= ARCHIVE_BYTES:
                    done()
                    writer = None
        if writer is not None:
            done()
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("folder", pa.string()), ("path", pa.string()), ("records", pa.int64()), ("raw_bytes", pa.int64())]))

    written = assign_records(pages, least_bytes).mapInArrow(run, "folder string, path string, records long, raw_bytes long")
    return materialize(written, "warc-manifest")


_FIELDS = [("page_id", pa.int64(), "long"), ("url", pa.string(), "string"), ("record_type", pa.string(), "string"), ("refers_to", pa.int64(), "long"), ("payload_bytes", pa.int64(), "long"), ("payload_digest", pa.string(), "string"), ("payload", pa.binary(), "binary")]


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The checked records of the manifest's archives; without ``payload`` that column stays out."""
    fields = _FIELDS if payload else _FIELDS[:-1]
    schema = pa.schema([(n, t) for n, t, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, _ = open_store(row["folder"])
                held, size, seen = [], 0, 0
                with store.open_input_stream(row["path"]) as stream:
                    for frame in read_frames(stream):
                        record = parse_record(frame)
                        held.append({n: record[n] for n in schema.names})
                        size, seen = size + (len(frame) if payload else 100), seen + 1
                        if size >= 8_000_000 or len(held) >= 4096:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if seen != row["records"]:
                    raise WarcError(f"{row['path']} has {seen} records of {row['records']}")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n, "path").mapInArrow(run, ", ".join(f"{n} {t}" for n, _, t in fields))
