import gzip
import json

import pytest
from pyspark.sql import functions as F

from textloom.sources import documents as sd
from textloom.sources import shards as sh


def test_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        sd.read_raw(spark, str(tmp_path), "avro-like")


@pytest.mark.parametrize("fmt", ["json", "csv", "text"])
def test_ids_do_not_depend_on_how_files_are_split(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    rows = [(f"text {i % 50} " + "x" * (i % 90),) for i in range(3_000)]
    df = spark.createDataFrame(rows, "text string").repartition(2)
    writer = df.write.option("header", "true") if fmt == "csv" else df.write
    writer.format(fmt).save(path)
    found = []
    for size in ("128m", "20k", "3k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        docs = sd.ingest(sd.read_raw(spark, path, fmt), "s")
        found.append({(r.id, r.text, r.ord.place) for r in docs.collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1] == found[2] and len({i for i, _, _ in found[0]}) == 3_000
    by_file = {}
    for r in docs.collect():
        by_file.setdefault(r.ord.file, []).append(r.ord.place)
    assert all(sorted(p) == list(range(len(p))) for p in by_file.values())


def test_csv_header_and_missing_text_column(spark, tmp_path):
    (tmp_path / "a.csv").write_text('content,k\n"one, two",1\nthree,2\n')
    docs = sd.ingest(sd.read_raw(spark, str(tmp_path), "csv"), "s").orderBy("ord").collect()
    assert [(r.text, r.meta["k"]) for r in docs] == [("one, two", "1"), ("three", "2")]
    with pytest.raises(ValueError, match="no text column"):
        sd.ingest(spark.createDataFrame([(1, "x")], "ord int, body string"), "s")


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_order_and_ids_are_the_same_on_every_read(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    rows = [(f"text {i}", i, None if i % 2 else 1.5, [i]) for i in range(40)]
    df = spark.createDataFrame(rows, "content string, k int, score double, nested array<int>")
    df.repartition(3).write.format(fmt).save(path)
    first, second = (
        sd.ingest(sd.read_raw(spark, path, fmt), "src").orderBy("ord").collect() for _ in range(2)
    )
    assert first == second and len({r.id for r in first}) == 40
    row = first[0]
    assert row.source == "src" and row.meta["content"] == row.text and "nested" not in row.meta
    assert ("score" in row.meta) == (int(row.meta["k"]) % 2 == 0)


def test_text_files_are_documents_by_line(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\n  \ntwo\n")
    docs = sd.ingest(sd.read_raw(spark, str(tmp_path), "text"), "lines")
    assert [r.text for r in docs.orderBy("ord").collect()] == ["one", "two"]


def test_cap_keeps_the_first(spark):
    df = spark.createDataFrame([(i, f"t{i}" if i % 3 else " ") for i in range(30)], "ord int, text string")
    kept = sd.ingest(df, "s", max_docs=4).collect()
    assert sorted(r.text for r in kept) == ["t1", "t2", "t4", "t5"]
    assert sd.ingest(df, "s").count() == 20


def test_shards_hold_unescaped_json_lines(spark, tmp_path):
    path = str(tmp_path / "shards")
    df = spark.createDataFrame([(str(i), f"é漢 {i}", "s", {"k": "v"}) for i in range(25)], sh.DOCUMENT)
    sh.write_shards(df.coalesce(1), path, 10)
    files = sorted(tmp_path.glob("shards/*.json.gz"))
    assert len(files) == 3
    lines = [line for f in files for line in gzip.open(f, "rt", encoding="utf-8")]
    assert "é漢 0" in lines[0] and json.loads(lines[0])["meta"] == {"k": "v"}
    back = sh.read_shards(spark, path)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    listed = sh.list_shards(spark, path, counts=True).collect()
    assert len(sh.list_shards(spark, path).collect()) == 3
    assert [r.docs for r in listed] == [10, 10, 5] and listed == sorted(listed)


def test_numbered_shards(spark, tmp_path):
    path = str(tmp_path / "numbered")
    df = spark.range(25).select(
        F.col("id").cast("string").alias("id"), F.col("id").alias("position"), F.floor(F.col("id") / 10).alias("shard")
    )
    sh.write_numbered_shards(df.repartition(4), path)
    counts = {r.shard: r["count"] for r in spark.read.json(path).groupBy("shard").count().collect()}
    assert counts == {0: 10, 1: 10, 2: 5}
    only = spark.read.json(f"{path}/shard=1")
    assert [r.id for r in only.collect()] == [str(i) for i in range(10, 20)]


def test_missing_text_reads_as_blank(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "ord int, text string")
    assert [r.text for r in sd.ingest(df, "s").collect()] == ["x"]
