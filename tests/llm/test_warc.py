import base64
import gzip
import hashlib

from textloom.llm import queries, warc
from textloom.llm.common import folder

DIR = "/root/testdata/sf0.001"


def expected(pages):
    data = [(i, (h or "").encode()) for i, h in pages]
    best = {}
    for i, p in data:
        best[p] = max(best.get(p, -1), -1 if i is None else i)
    out = []
    for i, p in data:
        kept = (-1 if i is None else i) == best[p]
        digest = base64.b32encode(hashlib.sha1(p).digest()).decode()
        out.append((i, len(p), digest, "response" if kept else "revisit", None if kept else best[p]))
    return sorted(out, key=repr)


def found(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_query(spark):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{DIR}/pages.parquet").collect()]
    assert found(queries.op8_warc_revisits(spark, DIR)) == expected(pages)


PAGES = [
    (1, "u 1", "<p>one</p>"),
    (2, "u2", "<p>one</p>"),
    (3, "u3", None),
    (4, None, ""),
    (5, "u5", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
    (6, "u6", "é日" * 10_000),
    (7, "u7", "é日" * 10_000),
    (8, "u8", "\r\n\r\n"),
]


def round_trip(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, row string, id string")
    path = folder(spark, "warc-test")
    warc.write(df, path, **options)
    return path, warc.read(spark, path)


def test_odd_pages_and_bodies(spark, tmp_path):
    path, archive = round_trip(spark, PAGES, file_records=3)
    resolved = warc.resolve(archive).selectExpr(
        "try_cast(record_id as bigint) page_id", "payload_bytes", "payload_digest", "record_type",
        "try_cast(refers_to as bigint) refers_to",
    )
    assert found(resolved) == expected([(i, h) for i, _, h in PAGES])
    bodies = {r["record_id"]: bytes(r["body"]) for r in archive.filter("record_type = 'response'").collect()}
    assert bodies["7"] == ("é日" * 10_000).encode() and bodies["8"] == b"\r\n\r\n"
    assert all(len(r["body"]) == 0 for r in archive.filter("record_type = 'revisit'").collect())
    files = spark.read.format("binaryFile").load(path + "/*.gz").collect()
    first = gzip.decompress(bytes(files[0]["content"]))
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and first.endswith(b"\r\n\r\n")


def test_least_length_repeats_and_empty(spark):
    _, archive = round_trip(spark, [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbb"), (3, "u", "bbbb"), (None, "u", "bbbb")], min_bytes=3)
    got = sorted((r["record_id"], r["record_type"], r["refers_to"]) for r in archive.collect())
    assert got == [("", "revisit", "3"), ("1", "response", None), ("2", "response", None), ("3", "response", None), ("3", "revisit", "3")]
    path, archive = round_trip(spark, [])
    assert archive.count() == 0
