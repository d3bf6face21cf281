"""WARC archives: write, read, and rewrite with repeated payloads as revisit records.

`write` lets Spark's text writer lay the records out: a record is UTF-8 text and
every record ends with two line breaks, which is the writer's line separator, so
archives land in any store Spark writes to, gzipped and with a bounded number of
records each. `read` takes whole archives as binary files and walks them by
Content-Length (payloads may hold anything), inflating as it goes; it also reads
archives that are gzipped record by record or not at all.

`dedupe` shuffles headers only by payload digest: the record with the smallest
page id is the original, the others revisit it; records are then rewritten with
fresh headers and ids. Payloads under `min_bytes` are never revisits.

Defined results: a null payload is an empty one; a null page id is written as
such and loses against any number; of repeated rows one is the response and the
others revisit it; a null url is written as urn:page:<id>, line breaks in a url as
%0D and %0A; other columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, remove_path

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 4096
#: No page has a date of its own; a parameter of the writer.
DATE = "2024-01-01T00:00:00Z"
HEADER_SCHEMA = "file string, offset long, record_id string, record_type string, page_id long, url string, refers_to_id string, payload_bytes long, payload_digest string"
FLUSH_BYTES = 8 << 20


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record(kind: Column, record_id: Column, page_id: Column, url: Column, payload: Column, digest: Column, n: Column, refers_to: Column, date: str) -> Column:
    """One record; a revisit carries the HTTP headers and no payload."""
    uri = F.coalesce(F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")), F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none"))))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), n.cast("string"), F.lit(CRLF * 2))
    block = F.when(kind == "revisit", http).otherwise(F.concat(http, payload))
    length = F.octet_length(http) + F.when(kind == "revisit", F.lit(0)).otherwise(n)
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"), _line("WARC-Type", kind), _line("WARC-Record-ID", record_id), F.lit(f"WARC-Date: {date}{CRLF}"),
        _line("WARC-Target-URI", uri), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        _line("WARC-Profile", F.when(kind == "revisit", F.lit(PROFILE))), _line("WARC-Refers-To", refers_to), _line("X-Page-ID", page_id.cast("string")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"), _line("Content-Length", length.cast("string")), F.lit(CRLF), block,
    )


def _save(records: DataFrame, path: str, records_per_file: int) -> None:
    records.write.options(lineSep=CRLF * 2, compression="gzip", maxRecordsPerFile=records_per_file, **{"zlib.compress.level": "BEST_SPEED"}).text(path)


def write(df: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Every row as a response record."""
    p = F.coalesce(F.col(payload), F.lit(""))
    row = df.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), p.alias("p"), F.octet_length(p).cast("long").alias("n"), F.sha2(p, 256).alias("digest"))
    record_id = _uuid(F.lit("first"), F.col("page_id").cast("string"), F.col("url"), F.col("digest"))
    _save(row.select(_record(F.lit("response"), record_id, F.col("page_id"), F.col("url"), F.col("p"), F.col("digest"), F.col("n"), F.lit(None).cast("string"), date).alias("value")), path, records_per_file)


class _Stream:
    """Bytes of an archive, inflated as they are asked for."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buffer, self.base, self.pos = raw, 0, bytearray(), 0, 0
        self.gz = raw[:2] == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31) if self.gz else None

    def _more(self) -> bool:
        if self.at >= len(self.raw):
            return False
        chunk = self.raw[self.at : self.at + (1 << 18)]
        self.at += len(chunk)
        if not self.gz:
            self.buffer += chunk
            return True
        while chunk:
            self.buffer += self.inflate.decompress(chunk)
            chunk = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
        return True

    def offset(self) -> int:
        return self.base + self.pos

    def until(self, mark: bytes) -> bytes | None:
        """Bytes before the mark, which is passed over; None at the end."""
        start = self.pos
        while (found := self.buffer.find(mark, start)) < 0:
            start = max(self.pos, len(self.buffer) - len(mark) + 1)
            if not self._more():
                return None
        out, self.pos = bytes(self.buffer[self.pos : found]), found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.pos < n:
            if not self._more():
                raise ValueError("an archive ends inside a record")
        out, self.pos = bytes(self.buffer[self.pos : self.pos + n]), self.pos + n
        if self.pos > 1 << 20:
            del self.buffer[: self.pos]
            self.base, self.pos = self.base + self.pos, 0
        return out


def records(raw: bytes):
    """(offset, headers, block) of every record of an archive."""
    s = _Stream(raw)
    while True:
        offset = s.offset()
        head = s.until(b"\r\n\r\n")
        if head is None:
            return
        if not head.strip():
            continue
        lines = head.decode("utf-8").strip("\r\n").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {offset}")
        headers = {k.strip().lower(): v.strip(" ") for k, v in (x.split(":", 1) for x in lines[1:])}
        block = s.take(int(headers["content-length"]))
        yield offset, headers, block


def _parse(with_payload: bool):
    names = [x.split()[0] for x in HEADER_SCHEMA.split(", ")]
    types = [{"long": pa.int64(), "string": pa.string()}[x.split()[1]] for x in HEADER_SCHEMA.split(", ")]
    schema = pa.schema([*zip(names, types, strict=True), *([("payload", pa.string())] if with_payload else [])])

    def parse(batches):
        rows, held = [], 0
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                file = path.as_py()
                for offset, h, block in records(content.as_py()):
                    payload = block[block.index(b"\r\n\r\n") + 4 :]
                    digest = hashlib.sha256(payload).hexdigest()
                    if h["warc-type"] == "response" and h["warc-payload-digest"] != f"sha256:{digest}":
                        raise ValueError(f"{file} at {offset}: the payload isn't the one that was written")
                    page = h.get("x-page-id")
                    uri = h.get("warc-target-uri")
                    row = [file, offset, h["warc-record-id"], h["warc-type"], None if page is None else int(page), uri, h.get("warc-refers-to"), len(payload), digest]
                    rows.append([*row, payload.decode("utf-8")] if with_payload else row)
                    held += 200 + len(payload) * with_payload
                    if held > FLUSH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return parse


def read(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: where it is, its headers, and its payload's length and SHA-256 as read (a revisit's own payload is empty)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path).select("path", "content")
    return files.mapInArrow(_parse(with_payload), HEADER_SCHEMA + (", payload string" if with_payload else ""))


def resolve(headers: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(file, offset) of every record with its type and, for revisits, where the original lies and its page id.

    The smallest page of each digest is an aggregate with map-side combine; only headers are joined.
    """
    h = headers.select("file", "offset", "page_id", "payload_digest", "payload_bytes")
    long = F.col("payload_bytes") >= min_bytes
    first = h.filter(long).groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("u"), "page_id", "file", "offset")).alias("o"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    j = h.join(first, "payload_digest", "left")
    revisit = F.coalesce(long & ((F.col("o.file") != F.col("file")) | (F.col("o.offset") != F.col("offset"))), F.lit(False))
    return j.select("file", "offset", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("kind"), F.when(revisit, F.col("o.file")).alias("o_file"), F.when(revisit, F.col("o.offset")).alias("o_offset"))


def dedupe(spark: SparkSession, source: str, target: str, min_bytes: int = 100, date: str = DATE, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Rewrite the archives at source into target: repeated payloads become revisit records, all headers are fresh."""
    found = resolve(read(spark, source), min_bytes)
    r = read(spark, source, with_payload=True).join(found, ["file", "offset"])
    fresh = lambda f, o: _uuid(F.lit("deduplicated"), F.col(f), F.col(o).cast("string"))
    refers_to = F.when(F.col("kind") == "revisit", fresh("o_file", "o_offset"))
    url = F.when(~F.col("url").startswith("urn:page:"), F.col("url"))
    value = _record(F.col("kind"), fresh("file", "offset"), F.col("page_id"), url, F.col("payload"), F.col("payload_digest"), F.col("payload_bytes"), refers_to, date)
    _save(r.select(value.alias("value")), target, records_per_file)


def round_trip(df: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 100) -> DataFrame:
    """Write df's pages, deduplicate the archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's length and digest are those of the response that it refers to, as read from the archive.
    """
    spark = df.sparkSession
    first, second = fresh_path(spark, "warc"), fresh_path(spark, "warc-deduplicated")
    write(df, first, page_id, url, payload)
    dedupe(spark, first, second, min_bytes)
    remove_path(spark, first)
    back = read(spark, second)
    own = back.filter("record_type = 'response'").select(F.col("record_id").alias("o_id"), F.col("page_id").alias("o_page"), F.col("payload_bytes").alias("o_bytes"), F.col("payload_digest").alias("o_digest"))
    revisits = back.filter("record_type = 'revisit'").join(own, F.col("refers_to_id") == F.col("o_id"))
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = back.filter("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(revisits.select("page_id", F.col("o_bytes").alias("payload_bytes"), F.col("o_digest").alias("payload_digest"), "record_type", F.col("o_page").alias("refers_to")).select(*out))
