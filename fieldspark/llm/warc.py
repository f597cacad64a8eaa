"""WARC archives: write, read, and resolve records with equal payloads as revisits.

A task packs records into archives of about ``archive_bytes`` and hands each to Spark's writer as
one row of one file, so archives land wherever Spark can write, and a reader never holds more than
one. Every record is a gzip member of its own, as the format asks. Spark's text writer ends a file
with a separator: it is the last field, four zero bytes, of an empty member that ends each archive.

To resolve revisits only headers are shuffled, by payload digest. The decisions then go to the
archives they concern, and each archive is rewritten with fresh headers.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import checkpointed, text_bytes

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\x00\x00\x00\x00"
_EMPTY_MEMBER = zlib.compressobj(wbits=31).flush()
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_READ_STEP = 1 << 15
_LEVEL = 3

HEADERS = (
    "archive string, place int, page_id bigint, record_id string, record_type string, target_uri string, "
    "date string, payload_digest string, payload_bytes bigint, refers_to bigint"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@dataclass
class Record:
    """One record: its header fields in order, and its block."""

    fields: dict[str, str]
    block: bytes

    @property
    def payload(self) -> bytes:
        """What follows the HTTP headers."""
        return self.block.partition(b"\r\n\r\n")[2]

    def packed(self) -> bytes:
        lines = "".join(f"{k}: {v}\r\n" for k, v in {**self.fields, "Content-Length": str(len(self.block))}.items())
        data = b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + self.block + b"\r\n\r\n"
        packer = zlib.compressobj(_LEVEL, wbits=31)
        return packer.compress(data) + packer.flush()


def unpacked(archive: bytes) -> Iterator[Record]:
    """The records of an archive, compressed by record or not at all."""
    if archive[:2] != b"\x1f\x8b":
        yield from _parsed(archive)
        return
    view, at = memoryview(archive), 0
    while at < len(view):
        reader, parts = zlib.decompressobj(wbits=31), []
        while not reader.eof and at < len(view):
            parts.append(reader.decompress(view[at : at + _READ_STEP]))
            at = min(len(view), at + _READ_STEP)
        if not reader.eof:
            raise ValueError("an archive ends within a record")
        at -= len(reader.unused_data)
        yield from _parsed(b"".join(parts))


def _parsed(data: bytes) -> Iterator[Record]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields.pop("Content-Length"))
        yield Record(fields, data[end + 4 : end + 4 + size])
        at = end + 4 + size + 4


def _field(value: str) -> str:
    """A header value: line ends and other control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def response(page_id: int | None, uri: str | None, date: str, payload: bytes) -> Record:
    fields = {
        "WARC-Type": "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {uri}')}>",
        "WARC-Date": date,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Payload-Length": str(len(payload)),
    }
    if uri is not None:
        fields["WARC-Target-URI"] = _field(uri)
    if page_id is not None:
        fields["Page-ID"] = str(page_id)
    return Record(fields, _HTTP % len(payload) + payload)


def revisit(record: Record, original: dict) -> Record:
    """The same page as a record without payload that points to the original response."""
    fields = {k: v for k, v in record.fields.items() if not k.startswith(("WARC-Refers-To", "Refers-To"))}
    fields |= {"WARC-Type": "revisit", "WARC-Profile": PROFILE, "WARC-Refers-To": original["record_id"], "WARC-Refers-To-Date": original["date"]}
    if original["target_uri"] is not None:
        fields["WARC-Refers-To-Target-URI"] = original["target_uri"]
    if original["page_id"] is not None:
        fields["Refers-To-Page-ID"] = str(original["page_id"])
    return Record(fields, record.block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n")


def _archives(records: Iterable[Record], archive_bytes: int) -> Iterator[pa.RecordBatch]:
    """Records packed into archives, one row each."""
    held, size = [], 0

    def archive() -> pa.RecordBatch:
        data = b"".join([*held, _EMPTY_MEMBER])
        return pa.record_batch({"archive": pa.array([data[: -len(_END)]], pa.binary())})

    for record in records:
        held.append(record.packed())
        size += len(record.block)
        if size >= archive_bytes:
            yield archive()
            held, size = [], 0
    if held:
        yield archive()


def _written(archives: DataFrame, folder: str) -> None:
    text = archives.select(F.col("archive").cast("string").alias("value"))
    text.write.option("lineSep", _END).option("maxRecordsPerFile", 1).mode("errorifexists").text(folder)


def write_pages(pages: DataFrame, folder: str, *, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 16 << 20) -> None:
    """Write a response record for every row (page_id, url, html) to archives in ``folder``. The payload is
    the html in UTF-8; a null one is empty."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                for page_id, uri, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch.column(2))):
                    yield response(page_id, uri, date, html)

        return _archives(records(), archive_bytes)

    _written(pages.select("page_id", "url", "html").mapInArrow(packed, "archive binary"), folder)


def _header_rows(path: str, archive: bytes) -> Iterator[tuple]:
    for place, record in enumerate(unpacked(archive)):
        f = record.fields
        digest, kind = f["WARC-Payload-Digest"].removeprefix("sha1:"), f["WARC-Type"]
        if kind == "response" and payload_digest(record.payload) != digest:
            raise ValueError(f"payload of record {place} in {path} does not match its digest")
        page, refers = f.get("Page-ID"), f.get("Refers-To-Page-ID")
        yield (
            path, place, None if page is None else int(page), f["WARC-Record-ID"], kind, f.get("WARC-Target-URI"), f["WARC-Date"],
            digest, int(f["Payload-Length"]), None if refers is None else int(refers),
        )


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The header fields of every record in a folder's archives, in the columns of ``HEADERS``.
    Fails if the payload of a response does not match its digest."""
    names = [c.split()[0] for c in HEADERS.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = list(zip(*_header_rows(path, content.as_py())))
                if found:
                    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=names)

    return _files(spark, folder).mapInArrow(rows, HEADERS)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """For each record that is to be a revisit: (archive, place, ``original``: its response's header).

    Of responses with equal payloads of at least ``min_bytes`` the one with the smallest page id is
    the original (nulls last, then by archive and place); other responses, and revisits of the same
    payload, refer to it. Headers combine by digest before they are shuffled.
    """
    order = F.struct(
        F.col("page_id").isNull().alias("unknown"), "page_id", "archive", "place", "record_id", "target_uri", "date"
    )
    large: Column = F.col("payload_bytes") >= min_bytes
    first = F.min(F.when((F.col("record_type") == "response") & large, order)).alias("original")
    groups = headers.groupBy("payload_digest", "payload_bytes").agg(first, F.count(F.lit(1)).alias("n"))
    shared = checkpointed(groups.where("n > 1 AND original IS NOT NULL").drop("n"))
    joined = headers.select("archive", "place", "payload_digest", "payload_bytes").join(shared, ["payload_digest", "payload_bytes"])
    other = (F.col("archive") != F.col("original.archive")) | (F.col("place") != F.col("original.place"))
    return joined.where(other).select("archive", "place", "original")


def write_resolved(
    spark: SparkSession, source: str, revisits: DataFrame, folder: str, *, archive_bytes: int = 16 << 20, broadcast_bytes: int = 8 << 20
) -> None:
    """Write the archives of ``source`` anew, with revisit records in place of the responses named
    in ``revisits``. The decisions are sent to all tasks if they measure up to ``broadcast_bytes``;
    otherwise they and the archives are joined by path."""
    decided = checkpointed(revisits.groupBy("archive").agg(
        F.collect_list(F.struct("place", "original.page_id", "original.record_id", "original.target_uri", "original.date")).alias("revisits")
    ))  # no more than an archive has records
    each = F.aggregate("revisits", F.lit(0), lambda n, r: n + 100 + F.coalesce(F.length(r["target_uri"]), F.lit(0)))
    size = decided.agg(F.sum(each + F.length("archive"))).first()[0] or 0
    decided = F.broadcast(decided) if size <= broadcast_bytes else decided
    joined = _files(spark, source).join(decided, F.col("path") == F.col("archive"), "left").select("content", "revisits")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                for content, revisits in zip(batch.column(0), batch.column(1).to_pylist()):
                    originals = {r["place"]: r for r in revisits or ()}
                    for place, record in enumerate(unpacked(content.as_py())):
                        yield revisit(record, originals[place]) if place in originals else record

        return _archives(records(), archive_bytes)

    _written(joined.mapInArrow(packed, "archive binary"), folder)


def archived(pages: DataFrame, folder: str, *, min_bytes: int = 0, archive_bytes: int = 16 << 20) -> DataFrame:
    """Archive pages, resolve revisits, and give the headers of the rewritten archives.

    ``folder`` gets ``responses`` (a response for each row) and ``resolved`` (with revisits). Repeated
    rows are records of their own: all but one become revisits of it. Null ids and urls leave their
    field out; a null html is an empty payload, equal to other empty ones. An empty table gives no
    archives and an empty result. Other columns are not read.
    """
    spark = pages.sparkSession
    write_pages(pages, f"{folder}/responses", archive_bytes=archive_bytes)
    headers = checkpointed(read_headers(spark, f"{folder}/responses"))
    revisits = resolve(headers, min_bytes)
    write_resolved(spark, f"{folder}/responses", revisits, f"{folder}/resolved", archive_bytes=archive_bytes)
    return read_headers(spark, f"{folder}/resolved")
