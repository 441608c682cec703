"""WARC archives in which a payload is written once and revisited afterwards.

Digests and ids, without payloads, are grouped by payload digest; the smallest page_id of each
group is the response that the others refer to. Archives are written by Spark's text writer, gzip
compressed, with the two line breaks that end a WARC record as separator, so they can go to any
file system Spark reaches; they are read back as binary files and parsed by their own lengths.

A null payload is empty. Rows of the same page_id and payload stand at the same place: each is a
response if that id is the smallest. A null page_id never is referred to; its row is a response.
Line breaks in a URL are percent-encoded; a null URL has no target header. Empty tables give no rows.
Archives are bounded by bytes; a payload above the bound has an archive of its own, which must fit a
task. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnloom.session import scratch_path

from .common import saved

#: Shorter payloads are always written as responses.
MIN_BYTES = 0
#: Payload bytes that an archive holds, at most, but for an archive of one larger record; payloads up to
#: SMALL_BYTES are kept apart from larger ones, which would else make all archives short.
ARCHIVE_BYTES, SMALL_BYTES = 1 << 28, 1 << 16
#: Revisits that are sent to every task, at most; beyond, pages are shuffled by id.
BROADCAST_ROWS = 500_000

BREAK = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The digits of base 32 in numbers and in RFC 4648.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: five hexadecimal digits are four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def _payloads(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        base32_sha1(html.cast("binary")).alias("payload_digest"),
    )


def revisits(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, payload_digest and refers_to of each page that another, smaller id has the payload of."""
    heads = _payloads(pages).where(F.col("payload_bytes") >= min_bytes).where("page_id is not null")
    heads = heads.select("payload_digest", "page_id").distinct()
    first = heads.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    first = first.where("last > refers_to").drop("last")
    return heads.join(first, "payload_digest").where("page_id > refers_to").select("page_id", "payload_digest", "refers_to")


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``value``, a record for each page without the two line breaks that end it, and ``payload_bytes``."""
    again = saved(revisits(pages, min_bytes), "revisits")
    if again.count() <= BROADCAST_ROWS:
        again = F.broadcast(again)
    rows = _payloads(pages).join(again, ["page_id", "payload_digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP), "html"))
    header = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Date: "), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block)),
    ]
    return rows.select(F.concat(F.concat_ws(BREAK, *header), F.lit(BREAK * 2), block).alias("value"), "payload_bytes")


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES, small_bytes: int = SMALL_BYTES
) -> None:
    """Archives of at most ``archive_bytes`` of payload, so that each can be read as one value."""
    size = F.coalesce(F.octet_length(F.col("html").cast("string")), F.lit(0))
    largest = pages.agg(F.max(size)).first()[0] or 0
    rows, small = records(pages, min_bytes), F.col("payload_bytes") <= small_bytes
    parts = [(rows, largest)] if largest <= small_bytes else [(rows.where(small), small_bytes), (rows.where(~small), largest)]
    for part, bound in parts:
        writer = part.select("value").write.mode("append").option("lineSep", BREAK * 2).option("compression", "gzip")
        # headers take less than a thousand bytes
        writer.option("maxRecordsPerFile", max(archive_bytes // (bound + 1000), 1)).text(path)


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive given in parts."""
    held = bytearray()

    def fill(enough) -> bool:
        while not enough():
            part = next(chunks, None)
            if part is None:
                return False
            held.extend(part)
        return True

    while fill(lambda: b"\r\n\r\n" in held):
        end = held.index(b"\r\n\r\n")
        lines = held[:end].decode("utf-8").split(BREAK)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = int(headers["Content-Length"])
        if not fill(lambda: len(held) >= end + 4 + size + 4):
            raise ValueError("the archive ends within a record")
        yield headers, bytes(held[end + 4 : end + 4 + size])
        del held[: end + 4 + size + 4]
    if held:
        raise ValueError("the archive ends within a header")


def _unzipped(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """The parts of a gzip file of one or more members."""
    reader = zlib.decompressobj(31)
    for at in range(0, len(content), step):
        part = content[at : at + step]
        while part:
            yield reader.decompress(part)
            part = reader.unused_data
            if part:
                reader = zlib.decompressobj(31)


def _urn_id(urn: str | None) -> int | None:
    number = urn[len("<urn:page:") : -1] if urn else "none"
    return None if number == "none" else int(number)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri and the payload
    itself (null for revisits) of each record of the archives at ``path``.

    Length and digest of each payload that is there are computed anew; where they differ from the
    record's own, the read fails.
    """
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def rows(content: bytes) -> Iterator[tuple]:
        for headers, block in parse(_unzipped(content)):
            kind, payload = headers["WARC-Type"], None
            size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response":
                payload = block.split(b"\r\n\r\n", 1)[1]
                if (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()) != (size, digest):
                    raise ValueError(f"the payload of {headers['WARC-Record-ID']} is not what its header says")
                payload = payload.decode("utf-8")
            referred = _urn_id(headers.get("WARC-Refers-To"))
            yield _urn_id(headers["WARC-Record-ID"]), size, digest, kind, referred, headers.get("WARC-Target-URI"), payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                part = []
                for row in rows(content.as_py()):
                    part.append(row)
                    if len(part) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=names)
                        part = []
                if part:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
        " target_uri string, payload string"
    )
    return files.mapInArrow(read, schema)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """The pages' records, written to the shared scratch folder and read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(spark, path)


SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (
  SELECT page_id, octet_length(body) AS n, sha1(body) AS x FROM p),
g AS (
  SELECT page_id, n, x, translate(array_to_string(list_transform(range(0, 8), lambda i:
      to_base(CAST('0x' || substr(x, CAST(5 * i + 1 AS INT), 5) AS BIGINT), 32, 4)), ''),
    '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS digest,
    min(page_id) OVER (PARTITION BY x) AS first FROM h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM g
"""
