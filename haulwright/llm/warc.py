"""Converter of legacy ARC archives to WARC, with revisit records for equal payloads.

ARC files (version 1: five header fields, version 2: ten) are parsed by their
own header line and each record's declared length. Every record becomes a WARC
response with a synthesised identifier, timestamp, type and digest; equal
payloads from a minimum size on become revisits of the one with the largest
page. WARC files are ordinary text output of Spark (a record and the empty
lines after it), written and read where Spark writes and reads.

Null html is an empty payload, a null or blank URL becomes `urn:page:<id>`.
Rows that repeat a page with the same html get the same type: all of them are
responses where that page is the largest. Equal means equal SHA-1 and length.
A record that breaks off or declares a wrong length raises an error.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulwright.llm.common import mapped, shared_path, steps, table

# The field names of the two ARC versions.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CAPTURED = "20000101000000"


def clean_url(url: Column, page: Column) -> Column:
    """A URL without white space or control characters, which end fields of header lines."""
    shown = F.regexp_replace(F.btrim(url, F.lit(" \t\r\n")), "[\\x00-\\x20\\x7F]+", "%20")
    return F.coalesce(F.nullif(shown, F.lit("")), F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("none"))))


def arc_bytes(rows: list[tuple[object, str, str | None]], version: int, name: str) -> bytes:
    """One ARC file of captured pages (page, url without spaces, html), each a whole HTTP response."""
    about = f"{version} 0 pages\n{ARC_FIELDS[version]}\n"
    fields = f"filedesc://{name} 0.0.0.0 {CAPTURED} text/plain"
    fields += "" if version == 1 else f" 200 - - 0 {name}"
    out = [f"{fields} {len(about)}\n{about}\n".encode()]
    at = len(out[0])
    for page, url, html in rows:
        body = (html or "").encode()
        known = "" if page is None else f"X-Page-Id: {page}\r\n"
        head = f"HTTP/1.0 200 OK\r\n{known}Content-Type: text/html; charset=utf-8\r\n\r\n".encode()
        line = f"{url} 0.0.0.0 {CAPTURED} text/html"
        line += "" if version == 1 else f" 200 {hashlib.md5(body).hexdigest()} - {at} {name}"
        record = b"%s %d\n%s%s\n" % (line.encode(), len(head) + len(body), head, body)
        out.append(record)
        at += len(record)
    return b"".join(out)


def arc_records(content: bytes) -> Iterator[dict]:
    """Captured records of an ARC file: url, ip, date, mime, offset, head and body."""
    stream = io.BytesIO(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)
    version = None
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        if line == b"\n":
            continue
        fields = line.rstrip(b"\r\n").split(b" ")
        length = int(fields[-1])
        block = stream.read(length)
        if len(block) != length:
            raise ValueError(f"an ARC record at {offset} breaks off")
        if fields[0].startswith(b"filedesc://"):
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version} isn't known")
            continue
        if version is None or len(fields) != len(ARC_FIELDS[version].split(" ")):
            raise ValueError(f"an ARC header line at {offset} doesn't fit version {version}")
        head, body = block, b""
        if block.startswith(b"HTTP/"):
            head, _, body = block.partition(b"\r\n\r\n")
        else:
            head, body = b"", block
        yield {
            "url": fields[0].decode(),
            "ip": fields[1].decode(),
            "date": fields[2].decode(),
            "mime": fields[3].decode(),
            "offset": offset,
            "head": head.decode("latin-1"),
            "body": body,
        }


def _header(head: str, name: str) -> str | None:
    for line in head.split("\r\n")[1:]:
        key, _, value = line.partition(":")
        if key.strip().lower() == name:
            return value.strip()
    return None


def pages_to_arc(pages: DataFrame) -> DataFrame:
    """ARC files (name, content) of a few megabytes each, of both versions in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in enumerate(steps(batches, "html")):
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True))
            name = f"pages-{rows[0][0]}-{number}.arc"
            content = arc_bytes(rows, 1 + number % 2, name)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], ["name", "content"])

    url = clean_url(F.col("url"), F.col("page_id")).alias("url")
    return pages.select("page_id", url, "html").transform(mapped, run, "name string, content binary")


def convert_arc(archives: DataFrame) -> DataFrame:
    """One row per captured record of ARC files (name, content): WARC fields and the payload as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out: list[tuple] = []
                for r in arc_records(content.as_py()):
                    page = _header(r["head"], "x-page-id")
                    date = datetime.strptime(r["date"], "%Y%m%d%H%M%S").replace(tzinfo=UTC)
                    out.append(
                        (
                            None if page is None else int(page),
                            r["url"],
                            r["ip"],
                            date.strftime("%Y-%m-%dT%H:%M:%SZ"),
                            r["head"],
                            r["body"].decode("utf-8", "replace"),
                            len(r["body"]),
                            hashlib.sha1(r["body"]).hexdigest(),
                        )
                    )
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if k else pa.array(c, pa.int64()) for k, c in enumerate(zip(*out, strict=True))], names=names)

    schema = "page_id long, url string, ip string, date string, head string, body string, payload_bytes long, payload_digest string"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    return archives.select("name", "content").transform(mapped, run, schema)


def record_id(page: Column, url: Column) -> Column:
    """A WARC identifier that follows from the page and its URL."""
    h = F.md5(F.concat_ws(" ", page.cast("string"), url).cast("binary"))
    parts = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def largest_copies(records: DataFrame, least: int) -> DataFrame:
    """Of payloads of at least `least` bytes: digest, length and the record with the largest page."""
    return (
        records.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max(F.struct("page_id", "url")).alias("first"))
    )


def warc_records(records: DataFrame, copies: DataFrame) -> DataFrame:
    """Each record as the text of a WARC record: a revisit if another record holds its payload."""
    rows = records.join(copies, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("first.page_id").isNotNull() & ~F.col("first.page_id").eqNullSafe(F.col("page_id"))
    crlf = "\r\n"
    block = F.concat(F.col("head"), F.lit(crlf * 2), F.when(revisit, F.lit("")).otherwise(F.col("body")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(crlf))
    empty = F.lit("")
    page = F.col("page_id").cast("string")
    refers = F.concat(
        line("WARC-Refers-To", record_id(F.col("first.page_id"), F.col("first.url"))),
        line("WARC-Refers-To-Target-URI", F.col("first.url")),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("X-Refers-To-Page-Id", F.col("first.page_id").cast("string")),
    )
    head = F.concat(
        F.lit("WARC/1.1" + crlf),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"))),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(page.isNull(), empty).otherwise(line("X-Page-Id", page)),
        F.when(revisit, refers).otherwise(empty),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(crlf), block).alias("value"))


def write_warc(texts: DataFrame, path: str, records_per_file: int = 1000) -> None:
    """WARC files: each record and two empty lines, compressed file by file."""
    texts.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file
    ).text(path)


def warc_parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record; holds one record at a time."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    stream = io.BufferedReader(stream) if isinstance(stream, gzip.GzipFile) else stream
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        block = stream.read(int(fields["content-length"]))
        if len(block) != int(fields["content-length"]):
            raise ValueError("a WARC record breaks off")
        yield fields, block


def read_warc(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (page) of the records of WARC files.

    Digest and length of a response are taken from its block anew and must be those it declares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out: list[tuple] = []
                for fields, block in warc_parse(content.as_py()):
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    length = int(fields["x-payload-length"])
                    if fields["warc-type"] == "response":
                        body = block.partition(b"\r\n\r\n")[2]
                        if (hashlib.sha1(body).hexdigest(), len(body)) != (digest, length):
                            raise ValueError(f"{fields['warc-record-id']} doesn't hold what it declares")
                    page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page-id")
                    out.append((page and int(page), length, digest, fields["warc-type"], refers and int(refers)))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.transform(mapped, run, schema)


def op8_arc_to_warc(spark, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    records = convert_arc(pages_to_arc(pages))
    payload = F.coalesce(F.col("html"), F.lit(""))
    copies = largest_copies(
        pages.select(
            "page_id",
            clean_url(F.col("url"), F.col("page_id")).alias("url"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
            F.sha1(payload.cast("binary")).alias("payload_digest"),
        ),
        least=1000,
    )
    path = shared_path(spark, "warc")
    write_warc(warc_records(records, copies), path)
    return read_warc(spark, path)


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), m AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS first FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND p.payload_bytes = m.payload_bytes
"""
