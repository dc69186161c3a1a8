"""WARC archives: writing, reading back, and revisit resolution.

Pages become one WARC record each (``response``, with an HTTP header block and the payload digest),
one gzip member per record. Resolution reads the archives' headers, shuffles only those by payload
digest, makes the record with the largest page id of each digest the original, joins the others to
it, and writes new archives in which they are ``revisit`` records with fresh headers and no payload.

Spark writes and reads the files: ``text`` with one gzip member per row, of which the writer's line
separator (a NUL byte) is the last byte. The last byte of a gzip member is the high byte of its
length, 0 below 16 MB; longer members are followed by an empty one. Reading takes ``binaryFile``,
so any store that Spark reaches will do. An archive is as large as the records one task has, at most
``RECORDS_PER_FILE``; a record is held whole, and no task holds more than its files.

A digest that a third of all records share is one partial maximum per task, and the originals are
read from a written table for the join, so adaptive execution can split the hot digest.

Defined cases: null html is an empty payload; a null url has no target URI; a null page id is
smaller than any other and stays null; of rows equal in id and payload one, by file and offset, is
the original; control characters in urls are percent-encoded; an empty table gives an empty archive
and no rows; archives are written below the shared folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import table
from tidegauge.session import materialize, shared_path

RECORDS_PER_FILE = 10_000
LEVEL = 1
#: When the records were written; fixed, so that reruns give equal archives (a fixed value).
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = bytes([0x1F, 0x8B, 8, 0, 0, 0, 0, 0, 0, 255, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0])

HEADERS = ("page_id long, record_id string, record_type string, target_uri string, payload_bytes long, "
           "payload_digest string, refers_to long, file string, offset long")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    member = packer.compress(data) + packer.flush()
    return member if member[-1] == 0 else member + EMPTY_MEMBER


def _clean(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload_bytes: int, digest: str, payload: bytes | None,
           refers_to: tuple[int | None, str, str | None] | None = None) -> bytes:
    """One WARC record; ``refers_to`` (page id, record id, url of the original) makes it a revisit."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
    block += payload or b""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}|{url}|{digest}|{refers_to is not None}")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        other, other_record, other_url = refers_to
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {other_record}", f"WARC-Refers-To-Date: {DATE}"]
        if other_url is not None:
            head.append(f"WARC-Refers-To-Target-URI: {_clean(other_url)}")
        if other is not None:
            head.append(f"X-Refers-To-Page-Id: {other}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(archive: bytes) -> Iterator[tuple[int, bytes, bytes]]:
    """Offset, packed and unpacked bytes of each gzip member that holds something."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        unpacker = zlib.decompressobj(31)
        data, taken = [], at
        while not unpacker.eof:
            piece = view[taken:taken + 65536]
            if not piece:
                raise ValueError(f"the archive ends within the member at {at}")
            data.append(unpacker.decompress(piece))
            taken += len(piece)
        end = taken - len(unpacker.unused_data)
        if any(data):
            yield at, bytes(view[at:end]), b"".join(data)
        at = end


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (lower-cased names), HTTP head and payload of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _payload_length(http: bytes) -> int:
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.lower() == b"content-length":
            return int(value)
    raise ValueError("no payload length")


def _members_out(records: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """Packed records without their last byte, some megabytes a batch."""
    rows, size = [], 0
    for data in records:
        member = _gzip(data)
        rows.append(member[:-1])
        size += len(member)
        if size > 1 << 22:
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["member"])
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["member"])


def _write(packed: DataFrame, path: str, per_file: int) -> None:
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option(
        "maxRecordsPerFile", per_file).text(path)


def write_archives(pages: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """One response record per row of ``page_id, url, html``, into archives below ``path``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for page_id, url, html in zip(*(batch.column(i) for i in range(3)), strict=True):
                    payload = html.as_py() or b""
                    yield record(page_id.as_py(), url.as_py(), len(payload), payload_digest(payload), payload)

        return _members_out(records())

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("binary"))
    _write(rows.mapInArrow(pack, "member binary"), path, per_file)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_headers(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """A row of ``HEADERS`` per record; ``check`` compares payloads with their digests."""
    names = [part.split()[0] for part in HEADERS.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    schema = pa.schema([(part.split()[0], kinds[part.split()[1]]) for part in HEADERS.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for offset, _, data in members(content.as_py()):
                    fields, http, payload = parse(data)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if check and fields["warc-type"] == "response" and payload_digest(payload) != digest:
                        raise ValueError(f"the payload at {offset} of {file} does not have its digest")
                    rows.append((_number(fields.get("x-page-id")), fields["warc-record-id"], fields["warc-type"],
                                 fields.get("warc-target-uri"), _payload_length(http), digest,
                                 _number(fields.get("x-refers-to-page-id")), file.as_py(), offset))
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in rows], schema=schema)

    return _archives(spark, path).mapInArrow(read, HEADERS)


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``file, offset`` of each record that is to be a revisit, with its original's page id, record id and url."""
    large = headers.where(F.col("payload_bytes") >= min_bytes)
    originals = materialize(
        large.groupBy("payload_digest", "payload_bytes").agg(
            F.max(F.struct("page_id", "file", "offset", "record_id", "target_uri")).alias("original"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("payload_digest", "payload_bytes", "original"), "warc-originals")
    joined = large.select("payload_digest", "payload_bytes", "file", "offset").join(originals, ["payload_digest", "payload_bytes"])
    first = F.col("original")
    return joined.where(~((F.col("file") == first["file"]) & (F.col("offset") == first["offset"]))).select(
        "file", "offset", F.lit(True).alias("revisit"), first["page_id"].alias("refers_to"),
        first["record_id"].alias("refers_record"), first["target_uri"].alias("refers_url"))


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, member``: each record still packed, as it lies in its archive."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                found = [(offset, member) for offset, member, _ in members(content.as_py())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.as_py()] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int64()),
                     pa.array([f[1] for f in found], pa.binary())], ["file", "offset", "member"])

    return _archives(spark, path).mapInArrow(read, "file string, offset long, member binary")


def write_resolved(spark: SparkSession, source: str, revisits: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    """Copies the archives at ``source``, with fresh headers and revisits for what ``revisits`` names."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for member, revisit, *other in zip(*(batch.column(i) for i in range(5)), strict=True):
                    fields, http, payload = parse(zlib.decompress(member.as_py(), 31))
                    refers = tuple(x.as_py() for x in other) if revisit.as_py() else None
                    yield record(_number(fields.get("x-page-id")), fields.get("warc-target-uri"), _payload_length(http),
                                 fields["warc-payload-digest"].removeprefix("sha1:"), None if refers else payload, refers)

        return _members_out(records())

    joined = read_members(spark, source).join(revisits, ["file", "offset"], "left")
    packed = joined.select("member", F.coalesce("revisit", F.lit(False)).alias("revisit"), "refers_to", "refers_record", "refers_url")
    _write(packed.mapInArrow(pack, "member binary"), path, per_file)


def deduplicate(pages: DataFrame, min_bytes: int = 0) -> tuple[str, str]:
    """Writes the pages' archives and the deduplicated ones; the paths of both."""
    spark = pages.sparkSession
    first, second = shared_path(spark, "warc"), shared_path(spark, "warc-resolved")
    write_archives(pages, first)
    headers = materialize(read_headers(spark, first), "warc-headers")
    write_resolved(spark, first, materialize(resolve(headers, min_bytes), "warc-revisits"), second)
    return first, second


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, archives = deduplicate(table(spark, sf_dir, "pages"))
    return read_headers(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
