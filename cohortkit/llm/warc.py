"""Operator 4: WARC archives and their transactions.

``write`` turns each page into a capture of three WARC/1.1 records - request,
response (or revisit) and metadata - of which the first and the last name the
response in WARC-Concurrent-To. Spark's text writer puts out the archives: a
record is a row and the record's end, two empty lines, is the line separator.
``read`` parses the gzipped archives one by one, by Content-Length, as a
stream. ``captures`` joins request, response and metadata through the
concurrent-to identifiers and gives one nested row per capture.

Of pages with equal payloads of at least ``LEAST`` bytes the one with the
smallest page_id is written as a response, the others as revisits without
payload that refer to it; smaller ones are always responses. The metadata
record keeps the full payload's length, the record's digest header its SHA-256.

Defined results: a null html is an empty payload, a null URL leaves out the
target header, control characters and spaces in a URL are written in percent
form; a null page_id counts as the largest; of repeated rows with the smallest
page_id each is a response; every row is a capture of its own; columns beyond
page_id, url and html are ignored; an empty table gives empty archives.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, join_on, written

LEAST = 100
#: Captures of an archive at most.
CAPTURES = 4000
CRLF = "\r\n"
#: Date of all records: pages carry none, and reruns shall agree.
DATE = "1970-01-01T00:00:00Z"
END = b"\r\n\r\n"


def _record(kind: str, ident: Column, block: Column, content_type: str, *fields: Column) -> Column:
    """A record's text; ``fields`` are header lines with their line ends."""
    head = F.concat(F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind,
                    F.lit(f"{CRLF}WARC-Record-ID: <urn:uuid:"), ident, F.lit(f">{CRLF}WARC-Date: {DATE}{CRLF}"))
    tail = F.concat(F.lit(f"Content-Type: {content_type}{CRLF}Content-Length: "),
                    F.octet_length(block).cast("string"), F.lit(CRLF + CRLF))
    return F.concat(head, *fields, tail, block)


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def decided(pages: DataFrame) -> DataFrame:
    """page_id, url, html with payload length, digest and ``refers_to``: the
    page a revisit refers to. Only narrow rows are grouped; a payload shared by
    many pages meets its group's smallest page in a join that can be split."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("n"),
                        F.sha2(html.cast("binary"), 256).alias("digest"))
    big = rows.where(F.col("n") >= LEAST).select("page_id", "digest")
    firsts = (big.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
              .where("copies > 1").select("digest", "first"))
    rows = rows.join(written(firsts, "warc-firsts"), "digest", "left")
    other = (F.col("n") >= LEAST) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.withColumn("refers_to", F.when(other, F.col("first")))


def records(pages: DataFrame) -> DataFrame:
    """One text row per record."""
    odd = F.transform(F.split(F.col("url"), ""), lambda c: F.when(
        c.rlike(r"[\x00-\x20\x7f]"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c))
    url = F.when(F.col("url").rlike(r"[\x00-\x20\x7f]"), F.array_join(odd, "")).otherwise(F.col("url"))
    ident = F.uuid()
    rows = decided(pages).withColumn("target", url).withColumn(
        "ids", F.array(ident, F.uuid(), F.uuid()))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, "").otherwise(F.col("html"))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                      F.col("n").cast("string"), F.lit(CRLF + CRLF), body)
    path = F.regexp_extract("target", r"^.*?://[^/?#]*([^#]*)", 1)
    host = F.regexp_extract("target", r"^.*?://([^/?#]*)", 1)
    ask = F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)),
                   F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF))
    meta = F.concat(_line("page-id", F.col("page_id").cast("string")), _line("payload-length", F.col("n").cast("string")),
                    _line("refers-to-page", F.col("refers_to").cast("string")))
    main, target = F.col("ids")[0], _line("WARC-Target-URI", F.col("target"))
    with_main = F.concat(F.lit("WARC-Concurrent-To: <urn:uuid:"), main, F.lit(">" + CRLF))
    profile = F.when(revisit, F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}")).otherwise("")
    digest = F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest"), F.lit(CRLF))
    three = F.array(
        _record("request", F.col("ids")[1], F.coalesce(ask, F.lit(CRLF)), "application/http; msgtype=request", target, with_main),
        _record(F.when(revisit, "revisit").otherwise("response"), main, answer, "application/http; msgtype=response", target, profile, digest),
        _record("metadata", F.col("ids")[2], meta, "application/warc-fields", target, with_main))
    return rows.select(F.explode(three).alias("value"))


def write(pages: DataFrame, path: str) -> None:
    """Archives under ``path``, gzipped, of ``CAPTURES`` captures at most each."""
    (records(pages).write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", 3 * CAPTURES).text(path))


class _Stream:
    """Bytes of a gzipped archive, some at a time."""

    def __init__(self, packed: bytes, step: int = 1 << 18):
        self.packed, self.step, self.at = memoryview(packed), step, 0
        self.gz = zlib.decompressobj(31)
        self.have = bytearray()

    def more(self) -> bool:
        while self.at < len(self.packed) or self.gz.unused_data:
            if self.gz.eof:  # the next member
                rest, self.gz = self.gz.unused_data, zlib.decompressobj(31)
                got = self.gz.decompress(rest) if rest else b""
            else:
                got = self.gz.decompress(self.packed[self.at:self.at + self.step])
                self.at += self.step
            if got:
                self.have += got
                return True
        return False

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (i := self.have.find(mark, start)) < 0:
            start = max(0, len(self.have) - len(mark))
            if not self.more():
                return None
        return self.take(i + len(mark))[:-len(mark)]

    def take(self, n: int) -> bytes:
        while len(self.have) < n and self.more():
            pass
        out = bytes(self.have[:n])
        del self.have[:n]
        return out


def parse(packed: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record, by Content-Length."""
    s = _Stream(packed)
    while (head := s.until(END)) is not None:
        lines = head.decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record: " + lines[0][:60])
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = s.take(int(fields["content-length"]))
        if s.take(len(END)) != END:
            raise ValueError("record without its end")
        yield fields, block


_ROW = ("record_id string, record_type string, concurrent_to string, target string, digest string, "
        "payload_bytes long, payload_sha256 string, fields map<string,string>, payload binary")
_FIELDS = re.compile(rb"(?m)^([^:\r\n]+):[ ]*([^\r\n]*)")


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record. ``payload``: keep the bytes, else only their length and SHA-256."""
    kinds = [("record_id", pa.string()), ("record_type", pa.string()), ("concurrent_to", pa.string()), ("target", pa.string()),
             ("digest", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
             ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
    schema = pa.schema(kinds)

    def row(f: dict[str, str], block: bytes) -> dict:
        kind, body, own = f.get("warc-type"), None, None
        if kind in ("response", "request", "revisit"):
            body = block.partition(END)[2] if "application/http" in f.get("content-type", "") else block
        elif "warc-fields" in f.get("content-type", ""):
            own = [(k.decode(), v.decode("utf-8", "replace")) for k, v in _FIELDS.findall(block)]
        else:
            body = block
        return {"record_id": f.get("warc-record-id"), "record_type": kind, "concurrent_to": f.get("warc-concurrent-to"),
                "target": f.get("warc-target-uri"), "digest": f.get("warc-payload-digest"),
                "payload_bytes": None if body is None else len(body),
                "payload_sha256": None if body is None else hashlib.sha256(body).hexdigest(),
                "fields": own, "payload": body if payload else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                out, size = [], 0
                for f, block in parse(b.column(0)[i].as_buffer().to_pybytes()):
                    out.append(row(f, block))
                    size += len(block) if payload else 0
                    if len(out) >= 2000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, _ROW)


def captures(rec: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (or revisit), ``request``, ``metadata``.
    A response without request or metadata keeps nulls there."""
    def of(kind: str, *cols: str) -> DataFrame:
        return rec.where(F.col("record_type") == kind).select(F.col("concurrent_to").alias("capture"), F.struct(*cols).alias(kind))

    main = rec.where(F.col("record_type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture"),
        F.struct("record_type", "target", "digest", "payload_bytes", "payload_sha256", "payload").alias("response"))
    out = join_on(main, of("request", "record_id", "payload_bytes", "payload"), ["capture"], "left")
    return join_on(out, of("metadata", "record_id", "fields"), ["capture"], "left")


def op4(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write(pages.select("page_id", "url", "html"), path)
    cap = captures(read(spark, path, payload=False))
    field = lambda k: F.col("metadata.fields")[k]
    kind = F.col("response.record_type")
    return cap.select(
        field("page-id").cast("long").alias("page_id"),
        F.when(kind == "revisit", field("payload-length").cast("long")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(kind == "revisit", F.regexp_replace("response.digest", "^sha256:", "")).otherwise(F.col("response.payload_sha256")).alias("payload_digest"),
        kind.alias("record_type"), field("refers-to-page").cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, n, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest, n)
SELECT p.page_id, p.n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first IS NOT NULL AND f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first IS NOT NULL AND f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.digest = f.digest AND p.n = f.n
"""
