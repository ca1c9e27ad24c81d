"""WARC archives in Zstandard: written one frame a record behind a dictionary, read back and validated.

An archive begins with a skippable frame that holds the dictionary, trained on the first records of its task; every
record is one frame compressed with it, so a reader can start at any frame. Records with equal payloads of at least
`MIN_REVISIT_BYTES` are stored once: that of the largest page id is the response, others revisit it.

Tasks stream records into archives of about `ARCHIVE_BYTES` in a folder that all executors reach, under names of their
own, and return the names. Names of tasks that were lost or run twice are not among them, so what such tasks left
behind is never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from base64 import b32decode, b32encode
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogeval.llm import batches
from dialogeval.operators.joins import fits
from dialogeval.sources import scratch

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 8 << 20
# The dictionary is trained on at most so many bytes of the first payloads of a task.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 16 << 10
DATE = "2000-01-01T00:00:00Z"
# Lists of archives up to this size are broadcast.
MAX_LIST_BYTES = 16 << 20

SKIPPABLE = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

RECORDS = (
    "archive string, number bigint, page_id bigint, url string, record_type string, refers_to bigint,"
    " payload_bytes bigint, payload_digest string, payload binary, error string"
)
_LIST = "archive string, records bigint, bytes bigint"


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC record; a revisit has the HTTP head, with the length of the payload, but no payload."""
    digest = b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=_URI)}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


# All of ASCII that a header line may hold, but not the escape itself.
_URI = "".join(chr(c) for c in range(0x21, 0x7F) if chr(c) != "%")


def decode_record(record: bytes) -> dict:
    """The fields of one record; raises ValueError for anything that is not exactly one valid record."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0].encode() != VERSION:
        raise ValueError("no record header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in headers:
            raise ValueError(f"bad header line {line[:60]!r}")
        headers[name.lower()] = value.strip()
    for name in REQUIRED:
        if not headers.get(name):
            raise ValueError(f"header {name} is missing")
    if not headers["content-length"].isdecimal():
        raise ValueError("the content length is not a number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"content length {length}, but {len(rest) - 4} bytes")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    size = re.search(rb"\r\ncontent-length:\s*(\d+)", http, re.I)
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "")
    if kind not in ("response", "revisit") or not gap or not http.startswith(b"HTTP/") or not size:
        raise ValueError(f"not a response or revisit: {kind}")
    if not re.fullmatch("sha1:[A-Z2-7]{32}", digest):
        raise ValueError(f"no SHA-1 digest: {digest[:60]!r}")
    digest = b32decode(digest[5:]).hex()
    if kind == "response" and (len(payload) != int(size[1]) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload differs from its length or digest")
    if kind == "revisit" and payload:
        raise ValueError("a revisit with a payload")
    url = headers.get("warc-target-uri")
    return {
        "page_id": _page(headers["warc-record-id"]),
        "url": None if url is None else unquote(url),
        "record_type": kind,
        "refers_to": _page(headers.get("warc-refers-to", "")) if kind == "revisit" else None,
        "payload_bytes": int(size[1]),
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+|null)>", name)
    if not found:
        raise ValueError(f"not a page: {name[:60]!r}")
    return None if found[1] == "null" else int(found[1])


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


def frames(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    view, at, decoder = memoryview(archive), 0, zstandard.ZstdDecompressor()
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == SKIPPABLE:
        size = struct.unpack_from("<I", view, 4)[0]
        dictionary, at = bytes(view[8 : 8 + size]), 8 + size
        if len(dictionary) != size:
            raise ValueError("the dictionary is cut off")
        if dictionary[:4] == ZSTD_MAGIC:
            dictionary = decoder.decompress(dictionary)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    while at < len(view):
        # Small bites: what a frame leaves over is copied.
        one, parts, bite = decoder.decompressobj(), [], 4096
        while not one.eof:
            if at >= len(view):
                raise ValueError("the last frame is cut off")
            piece = view[at : at + bite]
            parts.append(one.decompress(piece))
            at += len(piece)
            bite = min(2 * bite, 1 << 20)
        at -= len(one.unused_data)
        yield b"".join(parts)


def _train(samples: list[bytes]) -> bytes:
    """A dictionary, or none if the samples are too few for one."""
    if len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _writer(folder: str, archive_bytes: int):
    def write(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        encoder = dictionary = out = None
        waiting, size, listed = [], 0, []

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                listed.append((name, records, written))
                out = None

        def put(record: bytes) -> None:
            nonlocal out, name, records, written
            if out is None:
                name, records, written = f"{uuid.uuid4().hex}.warc.zst", 0, 0
                out = store.open_output_stream(f"{root}/{name}", compression=None)
                if dictionary:
                    out.write(dictionary_frame(dictionary))
            frame = encoder.compress(record)
            out.write(frame)
            records, written = records + 1, written + len(frame)
            if written >= archive_bytes:
                close()

        def start() -> None:
            nonlocal encoder, dictionary
            dictionary = _train(waiting)
            shared = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
            encoder = zstandard.ZstdCompressor(write_checksum=True, **shared)
            for record in waiting:
                put(record)
            waiting.clear()

        name, records, written = "", 0, 0
        for batch in stream:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "html", "refers_to")]
            for page_id, url, html, refers_to in zip(*columns, strict=True):
                payload = (html.as_py() or "").encode()
                record = encode_record(page_id.as_py(), url.as_py(), payload, refers_to.as_py())
                if encoder is None:
                    waiting.append(record)
                    size += len(record)
                    if size >= SAMPLE_BYTES:
                        start()
                else:
                    put(record)
        if waiting:
            start()
        close()
        yield batches.record_batch(listed, _LIST)

    return write


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row of `pages` (page_id, url, html) to `folder`; returns the list of archives.

    NULL html is an empty payload. NULL page ids are written, never revisited and never revisit; rows that repeat the
    largest page id of a payload are all responses. Empty tables write nothing. Other columns are ignored.
    """
    source = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    keyed = source.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html"))
    large = keyed.where(f"size >= {MIN_REVISIT_BYTES} AND page_id IS NOT NULL")
    # Payloads that occur under several ids only; the plan sends this stored table to all tasks if it is small.
    held = large.groupBy("digest", "size").agg(F.max("page_id").alias("holder"), F.min("page_id").alias("least"))
    held = scratch.through_table(held.where("least < holder").drop("least"), "held")
    planned = keyed.join(held, ["digest", "size"], "left").select(
        "page_id", "url", "html", F.when(F.col("holder") > F.col("page_id"), F.col("holder")).alias("refers_to")
    )
    return scratch.through_table(planned.mapInArrow(_writer(folder, archive_bytes), _LIST), "archives")


def _reader(payloads: bool, strict: bool):
    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = {c: None for c in ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")}
        for batch in stream:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held, found = [], 0, frames(content.as_buffer().to_pybytes())
                number = 0
                while True:
                    fields, error = empty, None
                    try:
                        record = next(found)
                        fields = decode_record(record)
                    except StopIteration:
                        break
                    except (ValueError, zstandard.ZstdError) as problem:
                        error = f"record {number} of {name}: {problem}"
                        if strict:
                            raise ValueError(error) from problem
                    payload = fields["payload"] if payloads else None
                    rows.append((name, number, *list(fields.values())[:-1], payload, error))
                    held += len(payload or b"")
                    number += 1
                    if held >= ARCHIVE_BYTES:
                        yield batches.record_batch(rows, RECORDS)
                        rows, held = [], 0
                yield batches.record_batch(rows, RECORDS)

    return read


def read_archives(
    spark: SparkSession, folder: str, archives: DataFrame | None = None, payloads: bool = True, strict: bool = True
) -> DataFrame:
    """One row per record of the archives in `folder`, or of the listed ones: fields, payload, and what is wrong with it.

    A record that is no valid record raises; without `strict` it is a row with an `error`, and a frame that cannot be
    decoded ends its archive. Archives without a dictionary are read too.
    """
    name = F.regexp_extract("path", "[^/]*$", 0)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").schema(
        "path string, modificationTime timestamp, length bigint, content binary"
    ).load(folder).select(name.alias("archive"), "content")
    if archives is not None:
        names = archives.select("archive")
        small = fits(names, F.octet_length("archive"), MAX_LIST_BYTES)
        files = files.join(F.broadcast(names) if small else names, "archive", "left_semi")
    return files.mapInArrow(_reader(payloads, strict), RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write `pages` to the shared folder, read the archives back and return a row per record, without payloads."""
    spark = pages.sparkSession
    folder = scratch.scratch_path(spark, "warc")
    archives = write_archives(pages, folder)
    if not archives.limit(1).count():
        return spark.createDataFrame([], RECORDS).drop("payload", "error")
    return read_archives(spark, folder, archives, payloads=False).drop("payload", "error")
