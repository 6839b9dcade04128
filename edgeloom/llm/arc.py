"""Conversion of legacy ARC archives to WARC.

An ARC file begins with a version block; its first line names the version, its second
the fields of the header line before each document. The converter reads the fields
by those names (five in version 1, ten in version 2), takes as many bytes
as the header declares, and writes an equivalent WARC record: a record id derived
from file and offset, the date in ISO form, the type after the content, and SHA-1
digests of payload and block. The version block becomes ``warcinfo``.

Records of equal payloads (at least ``min_bytes`` long) become one ``response``, that of the
smallest page id (records without one last, then by file and offset), and
``revisit`` records, which keep the HTTP header and leave out the payload. Payloads
are compared by SHA-1 and length. Only those are shuffled, those of a very common payload over stripes; the archives
themselves only meet the list of their own revisits, and a payload is left out only where its digest is that of the list.

All files are written by Spark's text writer, one archive per row and file, in gzip form, and
read as binary files, so they may lie in any store that Spark reads. Every file below the source is
read, whatever its name (but those that begin with ``_`` or ``.``), plain or of any number of gzip
members, and is known by its whole path. Archives are
closed at ``ARC_BYTES``; a longer document has one of its own.

Every document is converted or is a reject. One that a declared length cuts short is marked ``WARC-Truncated``. Header lines
are read from the right end, so blanks may stand in the URL. After one that does not fit, the rest
of that file is a reject, and so is what follows a damaged gzip member. A document without a valid date is a reject
of its own. A file without a version block is one reject; after a version block that names
no fields, the fields are those of the version its first line shows. A null html is an empty
payload; a null url is written as ``-``, blanks in it are percent-encoded. Repeated rows
are records of their own. Extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.operators.skew import hot_limit, hot_rows, split_join
from edgeloom.storage import keep, new_path

ARC_BYTES = 2**23
BROADCAST_ROWS = 2**17
# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
    "Archive-length",
}
WARC_VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http;msgtype=response"
PAGE_FIELD = "X-Page-Id"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- ARC files


def _http(page_id: int | None, payload: bytes) -> bytes:
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    if page_id is not None:
        lines.append(f"{PAGE_FIELD}: {page_id}")
    lines.append(f"Content-Length: {len(payload)}")
    return "\r\n".join([*lines, "", ""]).encode() + payload


def _arc_start(name: str, version: int) -> bytes:
    body = f"{version} 0 edgeloom\n{ARC_FIELDS[version]}\n".encode()
    tail = {1: f"text/plain {len(body)}", 2: f"text/plain 200 - - 0 {name} {len(body)}"}[version]
    return f"filedesc://{name} 0.0.0.0 20080101000000 {tail}\n".encode() + body


def _arc_record(name: str, version: int, offset: int, page_id, url, html) -> bytes:
    block = _http(page_id, (html or "").encode("utf-8", "surrogatepass"))
    url = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "-"
    date = f"2008{1 + (page_id or 0) % 12:02d}01{(page_id or 0) % 86400 // 3600:02d}0000"
    start = f"{url} 127.0.0.1 {date} text/html"
    if version == 2:
        start += f" 200 - - {offset} {name}"
    return f"\n{start} {len(block)}\n".encode() + block


def _pack(batches):
    """Task: pages as whole archives, of version 1 and 2 in turn."""
    number, parts, size, version = 0, [], 0, 1

    def closed():
        return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["value"])

    for batch in batches:
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            name = f"part-{number}.arc"
            if not parts:
                version = 1 + number % 2
                parts, size = [_arc_start(name, version)], 0
            record = _arc_record(name, version, size, page_id, url, html)
            parts.append(record)
            size += len(record)
            if size >= ARC_BYTES:
                yield closed()
                number, parts = number + 1, []
    if parts:
        yield closed()


def _write_archives(archives: DataFrame, path: str) -> str:
    value = archives.select(F.col("value").cast("string"))
    value.write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)
    return path


def write_arc(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html"
) -> str:
    """Write ``pages`` as ARC files below ``path``."""
    rows = pages.select(F.col(key).cast("bigint"), F.col(url), F.col(html))
    return _write_archives(rows.mapInArrow(_pack, "value binary"), path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` of the archives; none if nothing was written."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


@dataclass
class Document:
    """A document of an ARC file."""

    offset: int
    fields: dict[str, str]
    block: bytes
    cut: bool = False
    error: str | None = None

    @property
    def header(self) -> bytes:
        """The HTTP header with its blank line, if there is one."""
        if not self.block.startswith(b"HTTP/"):
            return b""
        end = self.block.find(b"\r\n\r\n")
        return self.block[: end + 4] if end >= 0 else self.block

    @property
    def payload(self) -> bytes:
        return self.block[len(self.header) :]

    @property
    def page_id(self) -> int | None:
        return _page_id(self.header)


def _page_id(header: bytes) -> int | None:
    found = re.search(rb"(?im)^X-Page-Id: (-?\d+)\r?$", header)
    return int(found[1]) if found else None


GZIP = b"\x1f\x8b"
CHUNK = 2**13


def _unpacked(content: bytes) -> tuple[bytes, bool]:
    """The bytes of all gzip members, or the content itself; false if a member is damaged."""
    if content[:2] != GZIP:
        return content, True
    view, at, out = memoryview(content), 0, []
    while content[at : at + 2] == GZIP:
        member = zlib.decompressobj(31)
        try:
            while not member.eof and at < len(view):
                out.append(member.decompress(view[at : at + CHUNK]))
                at += CHUNK
        except zlib.error:
            return b"".join(out), False
        at = min(at, len(view)) - len(member.unused_data)
        if not member.eof:
            return b"".join(out), False
    return b"".join(out), not content[at:].strip(b"\0\r\n")


def read_arc(content: bytes) -> Iterator[Document]:
    """The documents of one ARC file, the version block first; what cannot be read as errors."""
    content, whole = _unpacked(content)
    yield from _documents(content)
    if not whole:
        yield Document(len(content), {}, b"", error="gzip member")


def _documents(content: bytes) -> Iterator[Document]:
    names, at, version = ARC_FIELDS[1].split(), 0, None
    while at < len(content):
        begin = at
        if content[at : at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)].decode("utf-8", "replace").rstrip("\r")
        if version is None:  # the first line's own layout tells its version
            names = ARC_FIELDS[2 if len(line.split(" ")) == 10 else 1].split()
            if not line.startswith("filedesc:"):
                yield Document(begin, {}, content[begin:], error="no version block")
                return
        values = line.rsplit(" ", len(names) - 1)  # the URL comes first and may hold blanks
        if len(values) != len(names) or not values[-1].isdecimal() or end < 0:
            yield Document(begin, {}, content[begin:], error="header line")
            return
        fields = dict(zip(names, values, strict=True))
        length = int(values[-1])
        block = content[end + 1 : end + 1 + length]
        at = end + 1 + length
        if version is not None and not iso_date(fields["Archive-date"]):
            yield Document(begin, fields, block, error="date")
            continue
        yield Document(begin, fields, block, cut=len(block) < length)
        if version is None:
            lines = block.decode("utf-8", "replace").split("\n")
            version = lines[0].split(" ")[0]
            named = lines[1].split() if len(lines) > 1 else []
            if {"URL", "Archive-date", "Archive-length"} <= set(named) and named[-1] == "Archive-length":
                names = named


# --------------------------------------------------------------- WARC files


def iso_date(date: str) -> str | None:
    """An ARC date of 4 to 14 digits in ISO form; None if there is no such date."""
    digits = re.sub(r"\D", "", date)[:14]
    digits = digits[: len(digits) // 2 * 2]
    if len(digits) < 4:
        return None
    try:
        moment = datetime.strptime(digits + "0101000000"[len(digits) - 4 :], "%Y%m%d%H%M%S")
    except ValueError:
        return None
    return moment.strftime(f"{moment.year:04d}-%m-%dT%H:%M:%SZ")


def record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in lines)
    return WARC_VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def convert(document: Document, name: str, refers: dict | None = None) -> bytes:
    """The WARC record of an ARC document; a revisit if ``refers`` names the first one."""
    url = document.fields["URL"]
    fields = [
        ("WARC-Record-ID", record_id(name, document.offset)),
        # Only a version block may come without a valid date.
        ("WARC-Date", iso_date(document.fields["Archive-date"]) or "1970-01-01T00:00:00Z"),
    ]
    if url.startswith("filedesc:"):
        fields += [("WARC-Filename", url[len("filedesc://") :]), ("Content-Type", "application/warc-fields")]
        lines = [*document.block.decode("utf-8", "replace").split("\n"), ""]
        return _record("warcinfo", fields, f"format: ARC {lines[0]}\r\nfields: {lines[1]}\r\n".encode())
    block = document.block
    fields.append(("WARC-Target-URI", url.replace(" ", "%20")))
    if document.fields.get("IP-address", "0.0.0.0") not in ("0.0.0.0", "-"):
        fields.append(("WARC-IP-Address", document.fields["IP-address"]))
    fields.append(("WARC-Payload-Digest", "sha1:" + base32_sha1(document.payload)))
    http = bool(document.header)
    kind = "response" if http else "resource"
    if refers:
        kind, block = "revisit", document.header
        fields += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers["name"], refers["offset"])),
            ("X-Payload-Length", str(len(document.payload))),
        ]
        if refers["page_id"] is not None:
            fields.append(("X-Refers-To-Page", str(refers["page_id"])))
    if document.cut:
        fields.append(("WARC-Truncated", "length"))
    fields.append(("WARC-Block-Digest", "sha1:" + base32_sha1(block)))
    kind_of = document.fields.get("Content-type", "application/octet-stream")
    fields.append(("Content-Type", HTTP if http else kind_of))
    return _record(kind, fields, block)


def _index(batches):
    """Task: file, offset, digest, length and page of each document."""
    names = ["name", "offset", "digest", "length", "page_id", "error"]
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows = [
                (
                    path.as_py(),
                    d.offset,
                    None if d.error else hashlib.sha1(d.payload).digest(),
                    len(d.payload),
                    d.page_id,
                    d.error,
                )
                for d in read_arc(content.as_buffer().to_pybytes())
                if d.error or not d.fields["URL"].startswith("filedesc:")
            ]
            types = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


INDEX = "name string, offset bigint, digest binary, length bigint, page_id bigint, error string"


def _convert(batches):
    """Task: each ARC file as one WARC file."""
    for batch in batches:
        for path, content, revisits in zip(*batch.columns, strict=True):
            listed = {r["offset"]: r for r in revisits.as_py() or []}
            records = []
            for d in read_arc(content.as_buffer().to_pybytes()):
                known = listed.get(d.offset)
                if known and hashlib.sha1(d.payload).digest() != known["digest"]:
                    raise ValueError(f"{path} has changed at {d.offset}")
                if not d.error:
                    records.append(convert(d, path.as_py(), known and known["first"]))
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(records)], pa.binary())], names=["value"])


def arc_to_warc(spark: SparkSession, source: str, path: str, min_bytes: int = 0) -> DataFrame:
    """Convert the ARC files below ``source`` to WARC files below ``path``.

    Returns the rejects ``(name, offset, length, error)``.
    """
    files = _files(spark, source)
    index = keep(files.mapInArrow(_index, INDEX), "arc_index")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "name", "offset")
    long = index.where(F.col("error").isNull() & (F.col("length") >= min_bytes))
    repeated = keep(
        long.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        .where("n > 1"),
        "arc_repeated",
    )
    counts = repeated.select("digest", F.col("n").alias("n_left"), F.lit(1).alias("n_right"))
    hot = hot_rows(counts, "digest", hot_limit(index.count()))
    firsts = repeated.select("digest", "first")
    revisits = (
        split_join(long.select("digest", "name", "offset"), firsts, "digest", ("offset", "digest"), hot)
        .where("name <> first.name OR offset <> first.offset")
        .groupBy("name")
        .agg(F.collect_list(F.struct("offset", "first", "digest")).alias("revisits"))
    )
    revisits = keep(revisits, "arc_revisits")  # an archive's records bound each list
    listed = revisits.agg(F.sum(F.size("revisits"))).first()[0] or 0
    side = F.broadcast(revisits) if listed <= BROADCAST_ROWS else revisits
    named = files.withColumn("name", F.col("path"))
    joined = named.join(side, "name", "left").select("path", "content", "revisits")
    _write_archives(joined.mapInArrow(_convert, "value binary"), path)
    return index.where("error IS NOT NULL").select("name", "offset", "length", "error")


_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r\n")


def read_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one WARC file, of any version.

    What is no whole record is an error.
    """
    content, whole = _unpacked(content)
    at = 0
    while at < len(content):
        if content[at : at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        end = content.find(b"\r\n\r\n", at)
        if not _VERSION_LINE.match(content, at) or end < 0:
            raise ValueError(f"no WARC record at {at}")
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k: v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(fields["Content-Length"])
        at = end + 4 + length
        if at > len(content):
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut short")
        yield fields, content[end + 4 : at]
    if not whole:
        raise ValueError("damaged gzip member")


PAGE_KINDS = ("response", "resource", "revisit")
WARC_ROW = (
    "page_id bigint, url string, date string, record_id string, record_type string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, refers_to_record string, "
    "payload binary"
)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _rows(batches):
    """Task: a row for each page record, digests taken anew from full payloads."""
    types = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in WARC_ROW.split(", ")]
    for batch in batches:
        for content in batch.column(1):
            rows = []
            for fields, block in read_warc(content.as_buffer().to_pybytes()):
                kind = fields["WARC-Type"]
                if kind not in PAGE_KINDS:
                    continue
                head = Document(0, {}, block)
                payload = None if kind == "revisit" else head.payload
                known = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                if payload is not None:
                    if known not in ("", own := base32_sha1(payload)):
                        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
                    known = own
                size = _number(fields.get("X-Payload-Length")) if payload is None else len(payload)
                rows.append(
                    (
                        head.page_id,
                        fields.get("WARC-Target-URI"),
                        fields["WARC-Date"],
                        fields["WARC-Record-ID"],
                        kind,
                        size,
                        known,
                        _number(fields.get("X-Refers-To-Page")),
                        fields.get("WARC-Refers-To"),
                        payload,
                    )
                )
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """The page records of the WARC files below ``path``."""
    return _files(spark, path).mapInArrow(_rows, WARC_ROW)


def pages_through_archives(pages: DataFrame, min_bytes: int = 0, **columns: str) -> DataFrame:
    """``pages`` as ARC files, converted to WARC and read back, a row for each record."""
    spark = pages.sparkSession
    arc = write_arc(pages, new_path(spark, "arc"), **columns)
    warc = new_path(spark, "warc")
    arc_to_warc(spark, arc, warc, min_bytes)
    return warc_records(spark, warc)
