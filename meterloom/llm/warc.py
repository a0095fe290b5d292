"""Legacy archive converter: ARC records become WARC records, written and read as archive files.

ARC files open with a ``filedesc://`` record whose body says the version and names the fields of the
header lines (version 1: five fields; version 2: ten). Each record is a header line, then as many
bytes as its last field declares, then a newline. The converter reads by declared lengths only, so a
payload may hold anything, and synthesises for each record a name-based UUID (from file and offset),
an ISO timestamp, a type, a content type and SHA-1 digests in Base32.

Files go through Spark's own writers and readers, so any store works and lost tasks are redone. A
file is closed after ``per_file`` records, which bounds what one reading task holds; its first record
is the file description (ARC) or a ``warcinfo`` (WARC). Spark's writer compresses a file as one gzip
member at the fastest level, not a member a record as other archives do; readers that go through a file
from its start read both.

An ARC file is parsed twice: once for the narrow columns that decide which records are revisits, once to
write the WARC records. The decisions, at most one a record, are sent to the files; payloads stay where
they are. A WARC file is parsed once, and each of its digests is checked then.

Of records with equal payloads of at least ``least`` bytes the one with the largest page id is a
response (ties: the larger record id); the others become revisits that refer to it and carry the HTTP
head, which declares the payload's length, without the payload.

Defined results: a null html is an empty payload; a null url is ``about:blank``; white space in a url
is percent-encoded; a null page id stays null; repeated rows are records of their own; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm.common import stored, tidy
from meterloom.session import scratch_path

# The header lines of both versions.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EPOCH = datetime(2000, 1, 1, tzinfo=timezone.utc)
_ARC = pa.schema(
    [("record_id", pa.string()), ("page_id", pa.int64()), ("version", pa.int32()), ("url", pa.string()), ("ip", pa.string()),
     ("date", pa.string()), ("mime", pa.string()), ("http", pa.binary()), ("payload", pa.binary()), ("digest", pa.string())]
)
_ARC_DDL = (
    "record_id string, page_id long, version int, url string, ip string, date string, mime string, "
    "http binary, payload binary, digest string"
)
_WARC = pa.schema(
    [("record_id", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()),
     ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
_WARC_DDL = (
    "record_id string, type string, page_id long, url string, date string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary"
)


def _http(payload: bytes, page_id: int | None) -> bytes:
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{page}Content-Length: {len(payload)}\r\n\r\n".encode()


def _url(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def write_arc(pages: DataFrame, path: str, per_file: int = 512) -> None:
    """Pages as ARC files, version 1 and 2 by turns; capture dates follow from page ids."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, version = 0, 1
        for batch in batches:
            out = []
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n % per_file == 0:
                    version = 1 + n // per_file % 2
                    out.append(_arc_description(version, f"pages-{n // per_file}.arc"))
                    n += 1
                out.append(_arc_record(version, page_id, url, (html or "").encode()))
                n += 1
            yield from _batches([(x,) for x in out], _LINE)

    _write(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(lines, "value binary"), path, "\n", per_file)


_LINE = pa.schema([("value", pa.binary())])


def _write(records: DataFrame, path: str, end: str, per_file: int) -> None:
    """Records as they are (the cast keeps every byte), each followed by ``end``."""
    text = records.select(F.col("value").cast("string").alias("value"))
    options = {"lineSep": end, "compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(per_file)}
    text.write.options(**options).text(path)


def _arc_description(version: int, name: str) -> bytes:
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n"
    more = "" if version == 1 else f" 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 20000101000000 text/plain{more} {len(body)}\n{body}".encode()


def _arc_record(version: int, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    block = _http(payload, page_id) + payload
    date = (_EPOCH + timedelta(seconds=(page_id or 0) % 10**9)).strftime("%Y%m%d%H%M%S")
    more = "" if version == 1 else f" 200 {hashlib.md5(block).hexdigest()} - 0 pages.arc"
    return f"{_url(url)} 0.0.0.0 {date} text/html{more} {len(block)}\n".encode() + block


def parse_arc(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, version, header fields, block) of each record after the file description."""
    stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    version, names = 1, ARC_FIELDS[1]
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        if line == b"\n":
            continue
        values = line.decode("utf-8", "replace").rstrip("\r\n").split(" ")
        length = int(values[-1])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"record at {offset} declares {length} bytes, {len(block)} are left")
        if values[0].startswith("filedesc://"):
            said, fields = block.decode().split("\n")[:2]
            version, names = int(said.split(" ")[0]), fields.split(" ")
            continue
        if len(values) != len(names):
            raise ValueError(f"record at {offset} has {len(values)} fields, version {version} has {len(names)}")
        yield offset, version, dict(zip(names, values, strict=True)), block


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all ARC files below a path with the identifiers and digests that WARC needs."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, data in _contents(batches):
            yield from _batches((_converted(name, *r) for r in parse_arc(data)), _ARC)

    return _files(spark, path).mapInArrow(tidy(records), _ARC_DDL)


def list_arc(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, record_id, page_id, payload_bytes and digest of the records of all ARC files below a path."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, data in _contents(batches):
            yield from _batches((_listed(name, offset, block) for offset, _, _, block in parse_arc(data)), _LISTED)

    return _files(spark, path).mapInArrow(
        tidy(records), "file string, offset long, record_id string, page_id long, payload_bytes long, digest string"
    )


def _listed(file: str, offset: int, block: bytes) -> tuple:
    http, payload = _split(block)
    page = _PAGE.search(http)
    return file, offset, _record_id(file, offset), int(page[1]) if page else None, len(payload), hashlib.sha1(payload).hexdigest()


_LISTED = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("page_id", pa.int64()),
     ("payload_bytes", pa.int64()), ("digest", pa.string())]
)


def _record_id(file: str, offset: int) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}')}"


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, one file's content at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def _converted(file: str, offset: int, version: int, fields: dict[str, str], block: bytes) -> tuple:
    http, payload = _split(block)
    page = _PAGE.search(http)
    when = datetime.strptime(fields["Archive-date"].ljust(14, "0")[:14], "%Y%m%d%H%M%S")
    return (
        _record_id(file, offset), int(page[1]) if page else None, version, fields["URL"], fields["IP-address"],
        when.strftime("%Y-%m-%dT%H:%M:%SZ"), fields["Content-type"], http, payload, hashlib.sha1(payload).hexdigest(),
    )


_PAGE = re.compile(rb"\r\nX-Page-Id: (-?[0-9]+)\r\n")
_LENGTH = re.compile(rb"\r\nContent-Length: ([0-9]+)\r\n")


def _split(block: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its empty line, payload; a block of another kind is all payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n") + 4
    return (block[:end], block[end:]) if end >= 4 else (block, b"")


def _files(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    # The last part of the path names the file wherever the store is mounted.
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def _batches(rows: Iterable[tuple], schema: pa.Schema, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes or a thousand rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(x) for x in row if isinstance(x, bytes))
        if size >= most or len(held) == 1000:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def revisits(listed: DataFrame, least: int = 1000) -> DataFrame:
    """record_id and refers_to (a record id) of the records whose payload a newer record has.

    Needs record_id, page_id, payload_bytes and digest.
    """
    large = listed.where(F.col("payload_bytes") >= least)
    newest = F.max(F.struct("page_id", "record_id"))
    # One row for each payload that occurs again; counted before the shuffle, so a hot one is one row a task.
    again = large.groupBy("digest").agg(F.count("*").alias("n"), newest.alias("newest")).where("n > 1")
    again = again.select("digest", F.col("newest.record_id").alias("refers_to"))
    return large.join(again, "digest").where("record_id <> refers_to")


def to_warc(records: DataFrame, least: int = 1000) -> DataFrame:
    """The records of ``read_arc`` with type and refers_to (a record id, for revisits)."""
    listed = records.select("record_id", "page_id", F.octet_length("payload").alias("payload_bytes"), "digest")
    decided = revisits(listed, least).select("record_id", "refers_to")
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")
    return records.join(decided, "record_id", "left").select(*records.columns, kind.alias("type"), "refers_to")


def convert_files(spark: SparkSession, arc: str, warc: str, least: int = 1000, per_file: int = 512) -> None:
    """ARC files as WARC files: decisions from the narrow columns go to the files, which are written record by record."""
    listed = stored(list_arc(spark, arc), "arc-records")
    by_file = revisits(listed, least).groupBy("file").agg(
        F.collect_list(F.struct("offset", "refers_to")).alias("decided")  # of one file's records
    )
    rows = _files(spark, arc).join(by_file, "file", "left")
    rows = rows.select("file", "content", "decided.offset", "decided.refers_to")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[tuple[bytes]]:
            n = 0
            for name, data, offsets, targets in _contents(batches):
                decided = dict(zip(offsets or [], targets or [], strict=True))
                for record in parse_arc(data):
                    row = dict(zip(_ARC.names, _converted(name, *record), strict=True))
                    row["refers_to"] = decided.get(record[0])
                    row["type"] = "response" if row["refers_to"] is None else "revisit"
                    if n % per_file == 0:
                        yield (_warcinfo(row["record_id"]),)
                        n += 1
                    yield (_warc_record(row),)
                    n += 1

        return _batches(made(), _LINE)

    _write(rows.mapInArrow(tidy(lines), "value binary"), warc, "\r\n\r\n", per_file)


def write_warc(records: DataFrame, path: str, per_file: int = 512) -> None:
    """WARC 1.1 files; the first record of each is a ``warcinfo``."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if n % per_file == 0:
                    out.append((_warcinfo(row["record_id"]),))
                    n += 1
                out.append((_warc_record(row),))
                n += 1
            yield from _batches(out, _LINE)

    columns = ["record_id", "type", "date", "url", "ip", "http", "payload", "digest", "refers_to"]
    _write(records.select(*columns).mapInArrow(lines, "value binary"), path, "\r\n\r\n", per_file)


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def _head(fields: dict[str, str | None]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n").encode()


def _warcinfo(first: str) -> bytes:
    block = b"software: archive converter\r\nformat: WARC File Format 1.1\r\n"
    return _head({
        "WARC-Type": "warcinfo",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, first + '#info')}>",
        "WARC-Date": "2000-01-01T00:00:00Z",
        "Content-Type": "application/warc-fields",
        "Content-Length": str(len(block)),
    }) + block


def _warc_record(row: dict) -> bytes:
    revisit = row["type"] == "revisit"
    block = row["http"] if revisit else row["http"] + row["payload"]
    return _head({
        "WARC-Type": row["type"],
        "WARC-Record-ID": f"<{row['record_id']}>",
        "WARC-Date": row["date"],
        "WARC-Target-URI": row["url"],
        "WARC-IP-Address": row["ip"],
        "WARC-Payload-Digest": _base32(bytes.fromhex(row["digest"])),
        "WARC-Block-Digest": _base32(hashlib.sha1(block).digest()),
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Refers-To": f"<{row['refers_to']}>" if revisit else None,
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }) + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, by declared lengths; block digests are checked."""
    stream = io.BytesIO(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data)
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no record at {stream.tell() - len(version)}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.decode().partition(": ")
            fields[key] = value
        block = stream.read(int(fields["Content-Length"]))
        said = fields.get("WARC-Block-Digest")
        if len(block) != int(fields["Content-Length"]) or said and said != _base32(hashlib.sha1(block).digest()):
            raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
        yield fields, block


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Responses and revisits of all WARC files below a path; a revisit has no payload of its own."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (data,) in _contents(batches):
            yield from _batches((_read(f, b, payloads) for f, b in parse_warc(data) if f["WARC-Type"] != "warcinfo"), _WARC)

    return _files(spark, path).select("content").mapInArrow(tidy(records), _WARC_DDL)


def _read(fields: dict[str, str], block: bytes, payloads: bool) -> tuple:
    http, payload = _split(block)
    page, declared, revisit = _PAGE.search(http), _LENGTH.search(http), fields["WARC-Type"] == "revisit"
    digest = fields["WARC-Payload-Digest"]
    if not revisit and digest != _base32(hashlib.sha1(payload).digest()):
        raise ValueError(f"damaged payload {fields['WARC-Record-ID']}")
    return (
        fields["WARC-Record-ID"][1:-1], fields["WARC-Type"], int(page[1]) if page else None, fields.get("WARC-Target-URI"),
        fields["WARC-Date"], fields["WARC-Refers-To"][1:-1] if revisit else None,
        int(declared[1]) if revisit and declared else len(payload),
        base64.b32decode(digest.removeprefix("sha1:")).hex(), payload if payloads and not revisit else None,
    )


def convert(pages: DataFrame) -> str:
    """Pages to ARC files, ARC files to WARC files; returns the WARC folder below the shared folder."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    convert_files(spark, arc, warc)
    return warc


def op8(pages: DataFrame) -> DataFrame:
    read = read_warc(pages.sparkSession, convert(pages), payloads=False)
    columns = ["record_id", "page_id", "payload_bytes", "payload_digest", "type", "refers_to"]
    read = stored(read.select(*columns), "warc-records")
    first = read.where("type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("first_page"))
    revisited = read.where("type = 'revisit'").join(first, "refers_to")
    columns = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    responses = read.where("type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisited.select(*columns, F.col("first_page").alias("refers_to")))


ORACLE_OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT payload_digest, max(page_id) AS first_page FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_page THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first_page THEN first_page END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""
