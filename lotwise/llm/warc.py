r"""WARC archives of pages in which repeated payloads are revisit records.

Payload digests group the pages; of equal payloads the smallest page id is the response,
the others are revisits that refer to it. Writing and reading use Spark's text files (one
record a row, gzip, a file per task), so any file system that Spark reaches will do; a
reader task follows Content-Length through its file and holds one record at a time.

Null html is an empty payload. Pages without id are responses, or revisits where an equal
payload has an id. Rows that repeat the smallest id are all responses. Blanks and control
characters in an URL become ``%20``; a null URL has no header. No pages give no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import map_arrow, small_batches
from lotwise.sources.scratch import new_path

# Fixed values of the format.
VERSION = "WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# End of fixed values.

DIGITS_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
RECORD_SEPARATOR = "\r\n\r\n" + VERSION
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, declared_digest string,"
    " payload_digest string, payload_bytes long, payload binary"
)


def base32_sha1(value: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits make four of base 32."""
    digest = F.sha1(value)
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), DIGITS_32, BASE32)


def with_originals(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with ``payload_digest``, ``payload_bytes``, ``record_type``, ``refers_to``.

    Only digests are grouped. A payload of a third of the pages is a row per task there and
    a skewed join key that adaptive execution splits. SHA-256 beside SHA-1 keeps payloads
    with a forged common SHA-1 apart. Payloads below ``min_bytes`` are all responses.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html")).withColumns(
        {
            "payload_digest": base32_sha1(F.col("html")),
            "payload_bytes": F.octet_length("html").cast("long"),
            "sha256": F.unhex(F.sha2("html", 256)),
        }
    )
    keys = ["payload_digest", "sha256"]
    originals = (
        rows.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(*keys)
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    revisit = ~F.col("page_id").eqNullSafe(F.col("original")) & F.col("original").isNotNull()
    return (
        rows.join(originals, keys, "left")
        .withColumn("refers_to", F.when(revisit, F.col("original")))
        .withColumn(
            "record_type",
            F.when(F.col("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit")),
        )
        .drop("original", "sha256")
    )


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record_id(page_id: str) -> Column:
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("none")), F.lit(">")
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per page, revisits without their payload, all headers anew."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    length = F.octet_length("http") + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    now = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id("page_id")),
        _line("WARC-Date", now),
        _line("WARC-Target-URI", url),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            revisit,
            F.concat(
                _line("WARC-Refers-To", _record_id("refers_to")),
                _line("WARC-Profile", F.lit(REVISIT_PROFILE)),
            ),
        ).otherwise(F.lit("")),
        _line("Content-Length", length.cast("string")),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    # The line separator ends the record's last of two line ends.
    record = F.concat(header, F.lit("\r\n"), F.col("http"), body, F.lit("\r\n"))
    with_originals(pages, min_bytes).withColumn("http", http).select(record.alias("value")).write.option(
        "lineSep", "\r\n"
    ).option("compression", "gzip").text(path)


def _page_id(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number not in ("", "none") else None


def _parse(buffer: bytes, at: int) -> tuple[tuple, int] | None:
    """The record that starts at ``at`` and where the next one does, if it is all there."""
    end = buffer.find(b"\r\n\r\n", at)
    if end <= at:  # the end of a file leaves the separator alone
        return None
    lines = buffer[at:end].decode().split("\r\n")
    if lines[0] + "\r\n" != VERSION:
        raise ValueError(f"Not a record: {lines[0][:80]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    start, stop = end + 4, end + 4 + int(head["Content-Length"])
    if len(buffer) < stop + 4:
        return None
    block = buffer[start:stop]
    payload = block[block.index(b"\r\n\r\n") + 4 :] if head["WARC-Type"] == "response" else None
    found = None if payload is None else base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return (
        _page_id(head["WARC-Record-ID"]),
        head.get("WARC-Target-URI"),
        head["WARC-Type"],
        _page_id(head.get("WARC-Refers-To")),
        head["WARC-Payload-Digest"].removeprefix("sha1:"),
        found,
        None if payload is None else len(payload),
        payload,
    ), stop + 4


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives; digest and length are taken from the payload itself."""
    lines = (
        spark.read.option("lineSep", RECORD_SEPARATOR)
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    schema = RECORDS if payloads else RECORDS.rpartition(",")[0]
    names = [part.split()[0] for part in schema.split(",")]
    types = [pa.string() if "string" in p else pa.int64() if "long" in p else pa.binary() for p in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, at, current = b"", 0, None
        for batch in small_batches(batches):
            out = []
            for value, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != current:
                    buffer, at, current = b"", 0, file
                # Adds what the reader took as separator; the parser goes by Content-Length.
                buffer, at = buffer[at:] + (value + RECORD_SEPARATOR).encode(), 0
                while record := _parse(buffer, at):
                    out.append(record[0][: len(names)])
                    at = record[1]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(lines, run, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` in which a revisit carries digest and length of the response it refers to."""
    responses = records.filter("record_type = 'response'")
    originals = responses.select(
        F.col("page_id").alias("refers_to"),
        F.col("declared_digest"),
        F.col("payload_digest").alias("_digest"),
        F.col("payload_bytes").alias("_bytes"),
    ).dropDuplicates(["refers_to", "declared_digest"])
    found = (
        records.filter("record_type = 'revisit'")
        .join(originals, ["refers_to", "declared_digest"], "left")
        .withColumns({"payload_digest": F.col("_digest"), "payload_bytes": F.col("_bytes")})
    )
    return responses.unionByName(found.select(*responses.columns))


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """What the archives of ``pages`` hold once written and read back."""
    spark = pages.sparkSession
    path = new_path(spark)
    write_archives(pages, path, min_bytes)
    return resolve_revisits(read_records(spark, path, payloads=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
