"""Legacy web archives (ARC) turned into WARC archives, and both read back."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveysieve.llm.common import open_filesystem, pick, run_folder, slices, texts_of
from surveysieve.operators.skew import join_per_key
from surveysieve.sources.sinks import stage_table

# Fields of a record's header line by version of the format.
ARC_FIELDS = {
    1: ("url", "ip", "date", "content_type", "length"),
    2: ("url", "ip", "date", "content_type", "code", "checksum", "location", "offset", "filename", "length"),
}
ARC_FIELD_LINES = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
IDENTICAL_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Raw bytes after which a new archive is begun.
ARCHIVE_BYTES = 100_000_000
LEVEL = 2
READ_BYTES = 1 << 16


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def http_block(payload: bytes, page_id: int | None) -> bytes:
    """The response that a crawler would have kept. The page's id goes along as a header of its own."""
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    return "\r\n".join([*lines, "", ""]).encode() + payload


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers by lower-case name, the headers' bytes, and the payload."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    headers = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers[name.strip().lower()] = value.strip()
    return headers, head + mark, payload


# Members: each record is compressed by itself, so that an archive can be read from any record on.


def member(data: bytes) -> bytes:
    compressor = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return compressor.compress(data) + compressor.flush()


def members(stream: BinaryIO) -> Iterator[tuple[int, bytes]]:
    """Offset and contents of each member, holding one at a time."""
    pending, offset = stream.read(READ_BYTES), 0
    while pending:
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not pending:
                pending = stream.read(READ_BYTES)
                if not pending:
                    raise ValueError(f"the member at offset {offset} is cut off")
            parts.append(inflate.decompress(pending))
            used += len(pending) - len(inflate.unused_data)
            pending = inflate.unused_data
        yield offset, b"".join(parts)
        offset += used
        if not pending:
            pending = stream.read(READ_BYTES)


# ARC


@dataclass(frozen=True)
class ArcRecord:
    url: str
    ip: str
    date: str
    content_type: str
    block: bytes
    offset: int
    code: str = ""


def _url_field(url: str | None) -> str:
    """A header line's fields are parted by spaces, so an address must not hold any."""
    return quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else "unknown:"


def arc_opening(name: str, version: int, date: str) -> bytes:
    """The record that begins an archive and tells its version."""
    body = f"{version} 0 surveysieve\n".encode() + ARC_FIELD_LINES[version] + b"\n"
    rest = f"text/plain {len(body)}" if version == 1 else f"text/plain 200 - - 0 {name} {len(body)}"
    return f"filedesc://{name} 0.0.0.0 {date} {rest}\n".encode() + body + b"\n"


def arc_record(version: int, name: str, offset: int, url: str | None, date: str, block: bytes) -> bytes:
    common = f"{_url_field(url)} 0.0.0.0 {date} text/html"
    if version == 1:
        line = f"{common} {len(block)}"
    else:
        checksum = hashlib.md5(block, usedforsecurity=False).hexdigest()
        line = f"{common} 200 {checksum} - {offset} {name} {len(block)}"
    return line.encode() + b"\n" + block + b"\n"


def read_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """The records of a compressed archive, by the header lines of its version and their declared lengths."""
    version = 0
    for offset, data in members(stream):
        start = 0
        while start < len(data):
            if data[start : start + 1] in (b"\n", b"\r"):
                start += 1
                continue
            end = data.find(b"\n", start)
            line = data[start : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
            if version == 0:
                fields, block, start = _opening(line, data, end, offset)
                version = int(block.split(b" ", 1)[0])
                if version not in ARC_FIELDS or ARC_FIELD_LINES[version] not in block:
                    raise ValueError(f"unknown version of an archive: {block[:80]!r}")
                continue
            values = line.split(" ")
            names = ARC_FIELDS[version]
            if len(values) != len(names):
                raise ValueError(f"{len(values)} instead of {len(names)} fields at offset {offset}: {line[:200]!r}")
            fields = dict(zip(names, values, strict=True))
            length = int(fields["length"])
            block = data[end + 1 : end + 1 + length]
            if len(block) != length:
                raise ValueError(f"the record at offset {offset} is shorter than the {length} bytes it declares")
            start = end + 1 + length
            yield ArcRecord(fields["url"], fields["ip"], fields["date"], fields["content_type"], block, offset, fields.get("code", ""))


def _opening(line: str, data: bytes, end: int, offset: int) -> tuple[list[str], bytes, int]:
    fields = line.split(" ")
    if not line.startswith("filedesc://"):
        raise ValueError(f"no archive of this kind: {line[:80]!r} at offset {offset}")
    length = int(fields[-1])
    return fields, data[end + 1 : end + 1 + length], end + 1 + length


# WARC


def record_id(archive: str, record: ArcRecord) -> str:
    """An identifier that any conversion of the same record gives again."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}/{record.offset} {record.date} {record.url}')}>"


def warc_date(date: str) -> str:
    """The time of a 14-digit date (12 digits without seconds) in the newer form."""
    return datetime.strptime(date.ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")


@dataclass(frozen=True)
class Original:
    """The response that a revisit refers to."""

    page_id: int
    record_id: str
    url: str
    date: str


def warc_record(archive: str, record: ArcRecord, original: Original | None) -> bytes:
    """The record's newer form; given an original, it keeps its headers only and refers to that.

    What is no HTTP response (names looked up, files of other protocols, any unknown type) becomes a
    resource with the whole block as its payload and the type that the legacy record gives.
    """
    if not record.block.startswith(b"HTTP/"):
        kind, content_type = "resource", record.content_type if "/" in record.content_type else "application/octet-stream"
        block = payload = record.block
        original = None
    else:
        kind, content_type = "response" if original is None else "revisit", "application/http; msgtype=response"
        _, head, payload = split_http(record.block)
        block = record.block if original is None else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(archive, record)}",
        f"WARC-Date: {warc_date(record.date)}",
        f"WARC-Target-URI: {record.url}",
        f"WARC-IP-Address: {record.ip}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"WARC-Block-Digest: sha1:{payload_digest(block)}",
    ]
    if original is not None:
        lines += [
            f"WARC-Profile: {IDENTICAL_PAYLOAD}",
            f"WARC-Refers-To: {original.record_id}",
            f"WARC-Refers-To-Target-URI: {original.url}",
            f"WARC-Refers-To-Date: {original.date}",
            f"X-Refers-To-Page-Id: {original.page_id}",
            f"X-Payload-Length: {len(payload)}",
        ]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def warcinfo(archive: str, date: str) -> bytes:
    body = f"software: surveysieve\r\nformat: WARC File Format 1.1\r\nis-part-of: {archive}\r\n".encode()
    lines = [
        "WARC/1.1",
        "WARC-Type: warcinfo",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, archive)}>",
        f"WARC-Date: {warc_date(date)}",
        "Content-Type: application/warc-fields",
        f"Content-Length: {len(body)}",
        "",
        "",
    ]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers by lower-case name, and the block of the declared length, of each record."""
    for offset, data in members(stream):
        head, mark, rest = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not mark or not re.match(r"WARC/1\.\d", lines[0]):
            raise ValueError(f"no record at offset {offset}")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.lower()] = value.strip()
        length = int(headers["content-length"])
        if rest[length:] != b"\r\n\r\n":
            raise ValueError(f"the record at offset {offset} has not the length it declares")
        yield headers, rest[:length]


# On Spark


def _stored(folder: str, name: str):
    """A stream to a new file of a shared folder; failed attempts leave files of other names."""
    filesystem, path = open_filesystem(folder)
    filesystem.create_dir(path, recursive=True)
    return filesystem.open_output_stream(f"{path}/{name}")


def _opened(folder: str, name: str):
    filesystem, path = open_filesystem(folder)
    return filesystem.open_input_stream(f"{path}/{name}")


_ARC_INDEX = "archive string, number long, page_id long, bytes long, digest string, full_digest string, record_id string, url string, date string"


def write_arc(pages: DataFrame, folder: str, date: str = "20240101000000") -> DataFrame:
    """Writes the sources of ``pages`` (page_id, url, html) as legacy archives; returns their index.

    Each task writes its own archives, by turns of version 1 and 2. The index has
    one row per record: archive, number in it, page_id, payload bytes and digests,
    and the identifier, address and time that its newer form will have.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, part, stream = TaskContext.get(), 0, None
        for batch in slices(batches, 2):
            rows = []
            for page_id, url, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True
            ):
                if stream is None:
                    version = 1 + (context.partitionId() + part) % 2
                    name = f"{context.partitionId():05d}-{part:05d}-{context.taskAttemptId()}.arc.gz"
                    stream, offset, number, raw = _stored(folder, name), 0, 0, 0
                    opening = member(arc_opening(name, version, date))
                    stream.write(opening)
                    offset += len(opening)
                payload = text.encode()
                block = http_block(payload, page_id)
                record = ArcRecord(_url_field(url), "0.0.0.0", date, "text/html", block, offset)
                rows.append(
                    (
                        name,
                        number,
                        page_id,
                        len(payload),
                        payload_digest(payload),
                        hashlib.sha256(payload).hexdigest(),
                        record_id(name, record),
                        record.url,
                        warc_date(date),
                    )
                )
                data = member(arc_record(version, name, offset, url, date, block))
                stream.write(data)
                offset, number, raw = offset + len(data), number + 1, raw + len(block)
                if raw >= ARCHIVE_BYTES:
                    stream.close()
                    stream, part = None, part + 1
            yield _rows(rows, _ARC_INDEX)
        if stream is not None:
            stream.close()

    return pick(pages, "page_id", "url", "html").mapInArrow(run, _ARC_INDEX)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    types = {"string": pa.string(), "long": pa.int64()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    arrays = [pa.array(column, types[kind]) for column, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def originals(index: DataFrame, least_bytes: int = 0) -> DataFrame:
    """For each record of an index, the response it will refer to: original_id, original_record, original_url, original_date.

    Of records with equal payloads (length, SHA-1 and SHA-256) of at least
    ``least_bytes``, the one with the smallest page_id is the response; a null
    page_id is never referred to, unless all are null.
    """
    key = ["bytes", "full_digest"]
    large = index.where(F.col("bytes") >= least_bytes)
    first = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "record_id", "url", "date")
    groups = large.groupBy(*key).agg(F.count("*").alias("n"), F.min(first).alias("first"))
    joined = join_per_key(large, groups, key, "n", F.col("record_id"))
    is_first = F.col("record_id") == F.col("first.record_id")
    found = joined.select(
        *index.columns,
        *(
            F.when(~is_first, F.col(f"first.{name}")).alias(f"original_{alias}")
            for name, alias in (("page_id", "id"), ("record_id", "record"), ("url", "url"), ("date", "date"))
        ),
    )
    small = index.where(F.col("bytes") < least_bytes)
    return found.unionByName(small, allowMissingColumns=True)


_CONVERTED = "archive string, records long"


def convert(index: DataFrame, folder: str, partitions: int) -> DataFrame:
    """Converts the legacy archives of ``folder`` to WARC beside them; returns archive and records of each.

    ``index`` has archive, number and the original of each record. Each archive is
    read in a stream next to its part of the index, one record at a time.
    """
    columns = ["archive", "number", "original_id", "original_record", "original_url", "original_date"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        current, records, stream, name, written = None, None, None, "", 0
        done = []
        for batch in batches:
            for archive, number, *original in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if archive != current:
                    if stream is not None:
                        stream.close()
                        done.append((name, written))
                    current, written = archive, 0
                    records = enumerate(read_arc(_opened(folder, archive)))
                    name = archive.removesuffix(".arc.gz") + f"-{attempt}.warc.gz"
                    stream = _stored(folder, name)
                place, record = next(records)
                if place != number:
                    raise ValueError(f"{archive}: record {place} instead of {number}")
                if not written:
                    stream.write(member(warcinfo(archive, record.date)))
                known = Original(*original) if original[1] is not None else None
                stream.write(member(warc_record(archive, record, known)))
                written += 1
        if stream is not None:
            stream.close()
            done.append((name, written))
        yield _rows(done, _CONVERTED)

    return (
        index.select(*columns)
        .repartition(partitions, "archive")
        .sortWithinPartitions("archive", "number")
        .mapInArrow(run, _CONVERTED)
    )


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_records(archives: DataFrame, folder: str, partitions: int) -> DataFrame:
    """The responses and revisits in the WARC archives of ``folder`` that ``archives`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                yield from _found(read_warc(_opened(folder, name)))

    return archives.select("archive").repartition(partitions, "archive").mapInArrow(run, RECORDS)


def _found(records: Iterable[tuple[dict[str, str], bytes]], most: int = 2_000) -> Iterator[pa.RecordBatch]:
    rows = []
    for headers, block in records:
        kind = headers["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = split_http(block)
        own = payload_digest(payload) if kind == "response" else None
        digest = headers.get("warc-payload-digest", f"sha1:{own}").removeprefix("sha1:")
        if own not in (None, digest):
            raise ValueError(f"record {headers['warc-record-id']} has another payload than its digest tells")
        page_id, refers_to = http.get("x-page-id"), headers.get("x-refers-to-page-id")
        # The length is that of what is there; servers may not tell it.
        length = len(payload) if kind == "response" else int(headers["x-payload-length"])
        rows.append(
            (
                int(page_id) if page_id is not None else None,
                length,
                digest,
                kind,
                int(refers_to) if refers_to not in (None, "None") else None,
            )
        )
        if len(rows) >= most:
            yield _rows(rows, RECORDS)
            rows = []
    if rows:
        yield _rows(rows, RECORDS)


def archive_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Archives ``pages`` (page_id, url, html) and reads the archives back, one row per page.

    The pages are written as legacy archives, these are converted to WARC (one
    response per payload, revisits that refer to it), and the WARC records are
    read: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A null source is an empty payload, a null address is ``unknown:``. A null
    page_id stays null and is no response to others, unless all have none;
    refers_to is then null. Rows that repeat a page_id and a payload are one
    response and revisits to it. No rows give no rows. Other columns are ignored.
    """
    spark: SparkSession = pages.sparkSession
    folder = folder or run_folder(spark, "archives")
    index = stage_table(write_arc(pages, folder), "archive-index")
    n_archives = max(1, index.select("archive").distinct().count())
    converted = stage_table(convert(originals(index, least_bytes), folder, n_archives), "archives-converted")
    return read_records(converted, folder, n_archives)
