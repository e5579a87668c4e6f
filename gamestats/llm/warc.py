"""Web archives (WARC 1.1): writing captures and assembling them again.

A capture is written as a transaction of three records: the response (or, for
a payload that another page already has, a revisit without payload), the
request and a metadata record, the last two naming the first in
``WARC-Concurrent-To``.  Reading parses the archives record by record, joins
the records of a transaction through those identifiers and gives one nested
row per capture.

Archives are written by Spark's text writer: a record's text ends with two line
ends, which are the writer's line separator.  A file is one gzip stream and
holds at most ``RECORDS_PER_FILE`` records; a reading task decompresses it
piece by piece.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamestats.llm.common import join_keys, materialize, scratch_path, ship_package

VERSION = "WARC/1.1"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
RECORDS_PER_FILE = 3000
LEAST_REVISIT_BYTES = 0
EQUAL_ROWS = 1000     # written by a task at a time
_PIECE = 1 << 20

RECORDS = ("record_id string, record_type string, concurrent_to string, refers_to string, "
           "target_uri string, page_id long, payload_bytes long, payload_digest string, "
           "payload binary")


# --- writing ------------------------------------------------------------------

def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: 5 hexadecimal digits make 4 of base 32."""
    hexed = F.sha1(data)
    digits = F.concat(*[F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0")
                        for i in range(8)])
    return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV",
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(*parts: Column) -> Column:
    """A record identifier that depends on ``parts`` alone."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]),
                    F.lit(">"))


def _record(kind: Column, ident: Column, block: Column, headers: dict[str, Column]) -> Column:
    """The text of a record without its last two line ends; null headers are left out."""
    lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind),
             F.concat(F.lit("WARC-Record-ID: "), ident), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers.items()]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _page_record(kind: str, page_id: Column, key: Column, url: Column, number: Column) -> Column:
    return record_id(F.lit(kind), page_id, key, number, url.isNull(), url)


def _numbered(page: DataFrame, shared: DataFrame) -> DataFrame:
    """``page`` with the ``number`` (from 1) of each row among the rows that are
    equal to it; ``shared`` has the payloads of several rows, and as ``most``
    the largest number of equal rows."""
    one = page.withColumn("number", F.lit(1).cast("long"))
    keys = materialize(shared.where("most > 1").select("key"), "equal-pages")
    if keys.isEmpty():
        return one
    equal = (join_keys(page, keys, ["key"]).groupBy("key", "page_id", "url")
             .agg(F.any_value("html").alias("html"), F.any_value("n").alias("n"),
                  F.count(F.lit(1)).alias("rows"))
             # many equal rows are made in several tasks
             .withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"),
                                                      F.lit(EQUAL_ROWS).cast("long"))))
             .repartition("key", "page_id", "url", "from")
             .withColumn("number", F.explode(F.sequence(
                 "from", F.least(F.col("rows"), F.col("from") + EQUAL_ROWS - 1)))))
    return join_keys(one, keys, ["key"], "leftanti").unionByName(equal.drop("rows", "from"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT_BYTES,
                   records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``pages`` (``page_id``, ``url``, ``html``; other columns are
    ignored) as archives into the folder ``path``.

    Of pages with equal payloads of at least ``least`` bytes the one with the
    smallest ``page_id`` is the response and the others revisit it; a null
    html is the empty payload.  Line ends in a url are percent-encoded; a null
    url gives records without a target.  A null ``page_id`` counts as larger
    than all others.

    Every row is a transaction of its own: identifiers depend on ``page_id``,
    payload, url and the row's number among those equal in all three.  Rows
    that share the smallest ``page_id`` of a payload are all responses, and the
    one with the smallest url is revisited.
    """
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumn("key", F.sha2("html", 256)).withColumn("n", F.octet_length("html"))
    least_page = F.struct(F.col("page_id").isNull().alias("none"), "page_id",
                          F.col("url").isNull().alias("no_url"), "url")
    shared = materialize(
        page.groupBy("key", "page_id", "url")
        .agg(F.count(F.lit(1)).alias("rows"), F.any_value("n").alias("n"))
        .groupBy("key")
        .agg(F.min(least_page).alias("first"), F.sum("rows").alias("pages"),
             F.max("rows").alias("most"), (F.any_value("n") >= least).alias("repeats"))
        .where("pages > 1").drop("pages"), "payloads")
    page = _numbered(page, shared)
    page = join_keys(page, shared.drop("most"), ["key"], "left")
    revisit = F.coalesce("repeats", F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    page = page.withColumn("revisit", revisit)

    digest = F.concat(F.lit("sha1:"), base32_sha1(F.col("html").cast("binary")))

    def ident(kind: str) -> Column:
        return _page_record(kind, F.col("page_id"), F.col("key"), F.col("url"), F.col("number"))

    main = ident("main")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("n").cast("string"), F.lit(END))
    uri = {"WARC-Target-URI": F.col("url")}
    response = _record(
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), main,
        F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("html"))), uri | {
            "WARC-Payload-Digest": digest,
            "WARC-Profile": F.when(F.col("revisit"), F.lit(REVISIT_PROFILE)),
            "WARC-Refers-To": F.when(F.col("revisit"), _page_record(
                "main", F.col("first.page_id"), F.col("key"), F.col("first.url"), F.lit(1))),
            "Content-Type": F.lit("application/http; msgtype=response")})
    request = _record(
        F.lit("request"), ident("request"),
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1" + END)),
        uri | {"WARC-Concurrent-To": main,
               "Content-Type": F.lit("application/http; msgtype=request")})
    metadata = _record(
        F.lit("metadata"), ident("metadata"),
        F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                 F.lit("\r\n")),
        uri | {"WARC-Concurrent-To": main, "Content-Type": F.lit("application/warc-fields")})
    (page.select(F.explode(F.array(response, request, metadata)).alias("value"))
     .write.mode("error").option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


# --- reading ------------------------------------------------------------------

class _Stream:
    """Bytes of an archive, gzip or plain, taken piece by piece."""

    def __init__(self, content: bytes):
        self._in = memoryview(content)
        self._at = 0
        self._packed = zlib.decompressobj(31) if content[:2] == b"\x1f\x8b" else None
        self._have = bytearray()
        self._used = 0

    def _more(self) -> bool:
        if self._used > _PIECE:
            del self._have[:self._used]
            self._used = 0
        if self._packed is None:
            piece = self._in[self._at:self._at + _PIECE]
            self._at += len(piece)
            self._have += piece
            return bool(piece)
        while True:
            if self._packed.eof:                      # the next member, if any
                rest = self._packed.unused_data
                self._at -= len(rest)
                if self._at >= len(self._in):
                    return False
                self._packed = zlib.decompressobj(31)
            data = self._packed.unconsumed_tail
            if not data:
                data = self._in[self._at:self._at + _PIECE]
                self._at += len(data)
            if not data:
                return False
            out = self._packed.decompress(data, _PIECE)
            if out:
                self._have += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to ``mark``, which is skipped; None at the end."""
        look = self._used
        while (found := self._have.find(mark, look)) < 0:
            seen = len(self._have) - self._used
            if not self._more():
                return None
            look = max(self._used, self._used + seen - len(mark))
        out = bytes(self._have[self._used:found])
        self._used = found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self._have) - self._used < n and self._more():
            pass
        out = bytes(self._have[self._used:self._used + n])
        self._used += len(out)
        return out


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record.  Blocks are
    taken by ``Content-Length``, whatever they contain."""
    stream = _Stream(content)
    mark = END.encode()
    while (head := stream.until(mark)) is not None:
        lines = head.decode("utf-8", "replace").split("\r\n")
        headers = {}
        for line in lines[1:]:
            name, _, value = line.partition(": ")
            headers[name.lower()] = value
        block = stream.take(int(headers.get("content-length") or 0))
        stream.take(len(mark))
        yield headers, block


def _parse(with_payload: bool):
    def row(headers: dict[str, str], block: bytes) -> dict:
        kind = headers.get("warc-type")
        out = {"record_id": headers.get("warc-record-id"), "record_type": kind,
               "concurrent_to": headers.get("warc-concurrent-to"),
               "refers_to": headers.get("warc-refers-to"),
               "target_uri": headers.get("warc-target-uri"), "page_id": None,
               "payload_bytes": None, "payload_digest": None, "payload": None}
        if kind == "response":
            payload = block.partition(END.encode())[2]
            out["payload_bytes"] = len(payload)
            out["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out["payload"] = payload if with_payload else None
        elif kind == "revisit":
            for line in block.decode("utf-8", "replace").split("\r\n"):
                if line.lower().startswith("content-length:"):
                    out["payload_bytes"] = int(line.partition(":")[2])
            out["payload_digest"] = headers.get("warc-payload-digest", "").rpartition(":")[2] or None
        elif kind == "metadata":
            for line in block.decode("utf-8", "replace").split("\r\n"):
                name, _, value = line.partition(": ")
                if name == "page_id" and value:
                    out["page_id"] = int(value)
        return out

    schema = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(),
                                        "binary": pa.binary()}[c.split()[1]])
                        for c in RECORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in records(content.as_py()):
                    rows.append(row(headers, block))
                    size += len(block)
                    if size > 4 * _PIECE or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives in a folder."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_parse(with_payload), RECORDS)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture from a written table of records: ``response`` (or
    revisit), its ``request`` and its ``metadata`` as structs, the last two
    null if missing.  Records with the same identifier are one record; of
    several requests or metadata records of a response, the one with the
    smallest identifier counts."""
    record = F.struct(*[F.col(c) for c in found.columns])
    one = found.where(F.col("record_id").isNotNull()).groupBy("record_id").agg(
        F.any_value(record).alias("r"))
    main = one.where(F.col("r.record_type").isin("response", "revisit")).select(
        "record_id", F.col("r").alias("response"))

    def part(kind: str) -> DataFrame:
        return (one.where(F.col("r.record_type") == kind)
                .groupBy(F.col("r.concurrent_to").alias("record_id"))
                .agg(F.min_by("r", "record_id").alias(kind)))

    return main.join(part("request"), "record_id", "left").join(
        part("metadata"), "record_id", "left")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, read them back and give one row per
    capture: ``(page_id, payload_bytes, payload_digest, record_type,
    refers_to, target_uri)``.

    Every row is a capture, also where a ``page_id`` is null or repeated.  An
    empty table gives an empty result.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archives")
    write_archives(pages, path)
    found = materialize(read_records(spark, path, with_payload=False).drop("payload"), "records")
    captures = materialize(assemble(found).select(
        "record_id", F.col("metadata.page_id").alias("page_id"), "response"), "captures")
    responses = captures.where(F.col("response.record_type") == "response").select(
        F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to"))
    return (captures.join(responses, F.col("response.refers_to") == F.col("refers"), "left")
            .select("page_id", "response.payload_bytes", "response.payload_digest",
                    "response.record_type", F.col("refers_to"), "response.target_uri"))
