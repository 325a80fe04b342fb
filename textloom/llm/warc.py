"""WARC archives: payloads stored once, repeats written as revisit records.

Headers (an id and a payload digest) are shuffled by digest, the record that
keeps each payload is chosen, and every other record joins to it as a revisit.
Then the archives are written with fresh headers, bodies only where needed:
`write` streams them as gzip text whose record separator is the one of the
format, so any WARC reader can read a file. `read` parses files by content
length, and `resolve` gives revisit records what they refer to.

Defined cases: a null payload is empty; a null id is written as an empty id and
comes back null; records that repeat an id and a payload: one is the response,
the others revisit the same id; an empty table gives no records; payloads are
never cut.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator
from functools import partial
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm.common import forget, written

SEPARATOR = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, url string, record_type string, refers_to string, "
    "payload_digest string, payload_bytes long, body binary"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four of its letters."""
    # conv counts 0-9 then A-V; base32 counts A-Z then 2-7.
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(7)),
        lambda i: F.lpad(F.conv(F.substring(F.sha1(data), i * 5 + 1, F.lit(5)), 16, 32), 4, "0"),
    )
    return F.translate(F.array_join(parts, ""), digits, letters)


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, payload_bytes, payload_digest) of every page."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"\s", "%20").alias("url"),
        payload.alias("payload"),
    )
    raw = F.encode("payload", "UTF-8")
    return rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", base32_sha1(raw)
    )


def keepers(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Per digest of at least `min_bytes` bytes: the largest id, and one row of it."""
    long_enough = headers.filter(F.col("payload_bytes") >= min_bytes)
    best = F.struct("id", "row").alias("best")  # a null id is below every other
    return long_enough.groupBy("payload_digest").agg(F.max(best).alias("best"))


def decide(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(row, record_type, refers_to, has_reference) per header row (row: unique)."""
    kept = keepers(headers, min_bytes)
    kept = kept.select("payload_digest", F.col("best.id").alias("_id"), F.col("best.row").alias("_row"))
    joined = headers.join(kept, "payload_digest", "left")
    revisit = F.coalesce((F.col("payload_bytes") >= min_bytes) & (F.col("row") != F.col("_row")), F.lit(False))
    return joined.select(
        "row",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_id")).alias("refers_to"),
    )


def uri(id_col: str) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(">"))


def as_text(rows: DataFrame, date: str) -> DataFrame:
    """One record per row as text, without the separator that ends it."""
    revisit = F.col("record_type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), uri("id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri("refers_to"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    return rows.select(F.concat(F.concat_ws("\r\n", *lines), F.lit(SEPARATOR), body).alias("value"))


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    file_records: int = 1_000,
) -> None:
    """Deduplicated archives of `pages` under `path`, gzip, at most
    `file_records` records a file. Bodies are read beside their decision by a
    row number, so that no digest gathers bodies in one task."""
    rows = records(pages, id_col, url_col, payload_col).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "warc-rows")
    decisions = decide(rows.select("row", "id", "payload_bytes", "payload_digest"), min_bytes)
    full = rows.join(decisions, "row")
    options = {"lineSep": SEPARATOR, "compression": "gzip", "maxRecordsPerFile": str(file_records)}
    as_text(full, date).write.options(**options).text(path)
    forget(rows)


def read(spark: SparkSession, path: str, bodies: bool = True) -> DataFrame:
    """The records of all archives under `path`, one row each; length and digest
    of a response are those of the body that was read. bodies=False leaves the
    bodies out (null) once they are measured."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(partial(parse, bodies), RECORD)


def parse(bodies: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in RECORD.split(", "))])
    for batch in batches:
        for content in batch.column(0):
            parsed = _records(gzip.decompress(content.as_py()), bodies)
            while rows := list(islice(parsed, 256)):
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


HEADER = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)\r\n")


def _records(data: bytes, bodies: bool) -> Iterator[dict]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.lower(): v.decode() for k, v in HEADER.findall(data, at, end + 2)}
        size = int(fields[b"content-length"])
        kind = fields[b"warc-type"]
        body = data[end + 4 : end + 4 + size]
        digest = fields[b"warc-payload-digest"].removeprefix("sha1:")
        if kind == "response":
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        yield {
            "record_id": _name(fields[b"warc-record-id"]),
            "url": fields.get(b"warc-target-uri"),
            "record_type": kind,
            "refers_to": _name(fields.get(b"warc-refers-to")),
            "payload_digest": digest,
            "payload_bytes": size if kind == "response" else None,
            "body": body if bodies else None,
        }
        at = end + 4 + size + 4


def _name(value: str | None) -> str | None:
    return value.removeprefix("<urn:record:").removesuffix(">") if value is not None else None


def resolve(archive: DataFrame) -> DataFrame:
    """Records as read, revisits with the length of the payload they refer to:
    headers alone are joined, by digest; bodies stay where they are."""
    heads = archive.select("record_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes")
    responses = heads.filter("record_type = 'response'").groupBy("payload_digest")
    sizes = responses.agg(F.max("payload_bytes").alias("_bytes"))
    return heads.join(sizes, "payload_digest", "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "_bytes")
    ).drop("_bytes")
