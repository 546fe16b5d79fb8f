"""Legacy ARC archives to WARC, with identical payloads as revisits.

ARC files start with a version block that names the layout of their URL records (version 1: 5 fields, version 2: 10).
The converter walks header line by header line, each of which declares the length of its block, and gives every block
the WARC fields an archive of today needs: identifier, timestamp, type, digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.llm.common import require, shared_root, with_workers, written

# Fixed values of the formats.
FIELDS_V1 = "URL IP-address Archive-date Content-type Archive-length"
FIELDS_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"


def digest(data: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@dataclass(frozen=True)
class ArcRecord:
    version: int
    fields: dict[str, str]
    block: bytes
    offset: int


def arc_records(archive: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, its version block first. Raises ``ValueError`` where header and lengths disagree."""
    at, names, version = 0, FIELDS_V1.split(), 1
    while at < len(archive):
        if archive[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = archive.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header without end at {at}")
        values = archive[at:end].decode("utf-8", "replace").rstrip("\r").split(" ")
        first = values[0].startswith("filedesc:")
        if first:  # the version block's own line has the five fields of version 1, or those of its version
            layout = FIELDS_V1.split() if len(values) == 5 else FIELDS_V2.split()
        else:
            layout = names
        if len(values) != len(layout) or not values[-1].isdigit():
            raise ValueError(f"ARC header at {at} doesn't have the fields of version {version}")
        size = int(values[-1])
        block = archive[end + 1 : end + 1 + size]
        if len(block) != size:
            raise ValueError(f"ARC record at {at} declares {size} bytes, {len(block)} are left")
        if first:
            lines = block.decode("utf-8", "replace").split("\n")
            version = int(lines[0].split(" ")[0])
            names = lines[1].split(" ") if len(lines) > 1 and lines[1] else (FIELDS_V1 if version == 1 else FIELDS_V2).split()
        yield ArcRecord(version, dict(zip(layout, values, strict=True)), block, at)
        at = end + 1 + size


def arc_version_block(version: int, name: str, date: str) -> bytes:
    fields = FIELDS_V1 if version == 1 else FIELDS_V2
    body = f"{version} 0 stopwise\n{fields}\n\n".encode()
    line = ["filedesc://" + name, "0.0.0.0", date, "text/plain"]
    line += [] if version == 1 else ["200", "-", "-", "0", name]
    return " ".join([*line, str(len(body))]).encode() + b"\n" + body


def arc_record(version: int, url: str, date: str, kind: str, block: bytes, name: str, offset: int) -> bytes:
    url = re.sub("^filedesc:", "%66iledesc:", re.sub(r"\s", "%20", url)) or "-"  # that scheme marks version blocks
    line = [url, "0.0.0.0", date, kind]
    line += [] if version == 1 else ["200", digest(block), "-", str(offset), name]
    return " ".join([*line, str(len(block))]).encode() + b"\n" + block + b"\n"


def http_block(payload: bytes, page_id: int | None) -> bytes:
    head = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    head += [] if page_id is None else [f"X-Page-Id: {page_id}"]
    return "\r\n".join(head).encode() + END + payload


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Head, header fields in lower case, payload."""
    head, _, payload = block.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return head, {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def warc_date(arc_date: str) -> str:
    """14 digits (or fewer, as early archives have) as an instant in UTC; without a date the epoch."""
    digits = re.sub(r"\D", "", arc_date)[:14]
    base = "19700101000000"
    digits = digits + base[len(digits) :] if len(digits) >= 4 else base
    try:
        date = datetime.strptime(digits, "%Y%m%d%H%M%S")
    except ValueError:
        date = datetime(int(digits[:4]) or 1970, 1, 1) if digits[:4] != "0000" else datetime(1970, 1, 1) + timedelta(0)
    return date.strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(url: str, date: str, page: str, block_digest: str) -> str:
    """An identifier that every attempt of a task makes alike."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join((url, date, page, block_digest)))}>"


@dataclass(frozen=True)
class Converted:
    """An ARC record with the WARC fields made for it. ``head`` and ``payload`` are the parts of an HTTP block."""

    kind: str
    url: str
    date: str
    id: str
    content_type: str
    head: bytes
    payload: bytes
    page_id: int | None


def convert(record: ArcRecord) -> Converted:
    url, date = record.fields["URL"], warc_date(record.fields["Archive-date"])
    block, content = record.block, record.fields["Content-type"]
    if url.startswith("filedesc:"):
        kind, content, head, payload, page = "warcinfo", "text/plain", b"", block, ""
    elif block.startswith(b"HTTP/"):
        head, fields, payload = http_parts(block)
        kind, content, page = "response", "application/http; msgtype=response", fields.get("x-page-id", "")
    else:  # name look-ups and other blocks without a protocol head
        kind, head, payload, page = "resource", b"", block, ""
        content = "text/dns" if url.startswith("dns:") else content
    return Converted(kind, url, date, record_id(url, date, page, digest(block)), content, head, payload, int(page) if page else None)


def warc_record(made: Converted, revisit_of: int | None = None) -> bytes:
    """A WARC/1.1 record without its final empty lines; as a revisit it keeps the HTTP head and drops the payload."""
    revisit = revisit_of is not None
    block = made.head + END + (b"" if revisit else made.payload) if made.head else made.payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else made.kind}", f"WARC-Record-ID: {made.id}",
        f"WARC-Date: {made.date}", f"WARC-Target-URI: {made.url}", f"Content-Type: {made.content_type}",
        f"WARC-Payload-Digest: sha1:{digest(made.payload)}", f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if made.kind == "warcinfo":
        lines = [x for x in lines if not x.startswith("WARC-Target-URI")]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To-Page: {revisit_of}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + END + block


def warc_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (lower case) and block of each record, by declared lengths."""
    at = 0
    while at < len(archive):
        end = archive.find(END, at)
        if end < 0 or not archive.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at {at}")
        lines = archive[at:end].decode().split("\r\n")[1:]
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        size = int(fields["content-length"])
        start = end + len(END)
        if archive[start + size : start + size + len(END)] != END:
            raise ValueError(f"WARC record at {at} doesn't end after {size} bytes")
        yield fields, archive[start : start + size]
        at = start + size + len(END)


def to_arc(pages: DataFrame, date: str = "20240101000000", per_file: int = 200) -> DataFrame:
    """``archive``: ARC files of at most ``per_file`` pages, by turns of version 1 and 2. Null html is empty."""
    require(pages, "page_id", "url", "html")
    with_workers(pages)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for batch in batches:
            for at in range(0, batch.num_rows, per_file):
                version, name = 1 + made % 2, f"part-{made}.arc"
                out = bytearray(arc_version_block(version, name, date))
                for page, url, html in zip(*(c.slice(at, per_file) for c in batch.columns), strict=True):
                    block = http_block((html.as_py() or "").encode(), page.as_py())
                    out += arc_record(version, url.as_py() or "", date, "text/html", block, name, len(out))
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array([bytes(out)], pa.binary())], ["archive"])

    return pages.select("page_id", "url", "html").mapInArrow(build, "archive binary")


def payload_keys(arcs: DataFrame) -> DataFrame:
    """``page_id``, ``payload_digest`` and ``payload_bytes`` of the HTTP records of ARC files."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                found = [x for x in map(convert, arc_records(archive.as_py())) if x.kind == "response"]
                columns = [[x.page_id for x in found], [digest(x.payload) for x in found], [len(x.payload) for x in found]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()), strict=True)],
                    ["page_id", "payload_digest", "payload_bytes"],
                )

    return arcs.mapInArrow(keys, "page_id long, payload_digest string, payload_bytes long")


def originals(keys: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``payload_digest``, ``payload_bytes``, ``original``: the page kept as response, for payloads of several pages."""
    same = keys.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
    found = same.agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
    return found.where("n > 1 and original is not null").drop("n")


def to_warc(arcs: DataFrame, kept: DataFrame) -> DataFrame:
    """``record``: the bytes of each WARC record without its final empty lines."""
    fields = ("payload", "head", "url", "date", "id", "content_type", "kind")
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), *[pa.string()] * 5]
    names = ["page_id", "payload_digest", "payload_bytes", *fields]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                found = list(map(convert, arc_records(archive.as_py())))
                columns = [[x.page_id for x in found], [digest(x.payload) for x in found], [len(x.payload) for x in found]]
                columns += [[getattr(x, f) for x in found] for f in fields]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def format_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                made = Converted(**{f: row[f] for f in fields}, page_id=row["page_id"])
                other = row["original"] is not None and row["original"] != row["page_id"] and made.kind == "response"
                out.append(warc_record(made, row["original"] if other else None))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    ddl = "page_id long, payload_digest string, payload_bytes long, payload binary, head binary, " + ", ".join(
        f"{f} string" for f in fields[2:]
    )
    records = arcs.mapInArrow(parse, ddl)
    return records.join(kept, ["payload_digest", "payload_bytes"], "left").mapInArrow(format_, "record binary")


def write_warc(records: DataFrame, path: str, per_file: int = 2000) -> None:
    """Gzipped WARC files. The text writer puts the empty lines that end a record between and after the records."""
    raw = records.select(F.col("record").cast("string").alias("value"))  # bytes pass unchanged
    options = {"lineSep": END.decode(), "compression": "gzip", "maxRecordsPerFile": per_file}
    raw.write.options(**options).text(path)


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The HTTP records of WARC files: ``page_id``, full payload's size and digest, type and the page referred to.

    A response's payload is held against its digest and length; a difference raises.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    kind = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for fields, block in warc_records(zlib.decompress(content.as_py(), 31)):
                    if not fields["content-type"].startswith("application/http"):
                        continue
                    _, http, payload = http_parts(block)
                    told, size = fields["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
                    revisit = fields["warc-type"] == "revisit"
                    if not revisit and (digest(payload) != told or len(payload) != size):
                        raise ValueError(f"{fields['warc-record-id']} doesn't hold the payload it declares")
                    page, to = http.get("x-page-id"), fields.get("warc-refers-to-page")
                    out.append((int(page) if page else None, size, told, fields["warc-type"], int(to) if to else None))
                columns = list(zip(*out, strict=True)) or [[] for _ in kind]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    return files.mapInArrow(read, _READ)


def archive_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Pages as ARC, converted to WARC files in ``folder`` and read back; one row for each row of ``pages``.

    Of equal payloads that of the largest ``page_id`` is the response, others revisit it; rows that repeat this id with
    the payload are responses too, as are payloads that only pages without id have. Null html is the empty payload,
    null urls are ``-``. Other columns are ignored, an empty table gives an empty result.
    """
    spark = pages.sparkSession
    folder = folder or shared_root(spark)
    arcs = to_arc(pages)
    kept = written(originals(payload_keys(arcs), least_bytes), folder, "originals")
    write_warc(to_warc(arcs, kept), f"{folder}/warc")
    return read_warc(spark, f"{folder}/warc")
