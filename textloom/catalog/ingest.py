"""Queries over sources, sinks and stage counters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import WS, documents
from textloom.session import scratch_root
from textloom.sources import documents as sd
from textloom.sources import shards as sh

BLANKS = "   "


def text_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which column the text comes from, over every document in five layouts."""
    d = documents(spark, sf_dir)
    null = F.lit(None).cast("string")
    t = F.col("text")
    layouts = {
        "text": (t, null, null),
        "content": (null, t, null),
        "passage": (F.lit(""), null, t),
        "blank": (F.lit(BLANKS), t, null),
        "none": (null, F.lit(""), null),
    }
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("variant"), a.alias("text"), b.alias("content"), c.alias("passage"))
            for n, (a, b, c) in layouts.items()
        ]
    )
    laid = d.select("doc_id", F.explode(rows).alias("r")).select("doc_id", "r.*")
    return laid.select("doc_id", "variant", F.md5(sd.choose_text(laid)).alias("text_md5"))


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "source", "text")
    return sd.ingest(d, F.col("source"), order="doc_id").select("doc_id", "id", "source")


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars").withColumn(
        "lang", F.nullif("lang", F.lit("es"))
    )
    docs = sd.ingest(d, F.col("source"), order="doc_id")
    entries = F.array_sort(F.map_entries("meta"))
    joined = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"])), ";")
    return docs.select("doc_id", joined.alias("meta"))


def cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "source", "text")
    return sd.ingest(d, F.col("source"), order="doc_id", max_docs=300).select("doc_id", F.md5("text").alias("text_md5"))


def shard_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as gzip JSON lines and read back by declared schema."""
    d = documents(spark, sf_dir, "doc_id", "source", "text", "lang")
    path = f"{scratch_root(spark)}/shards-{uuid.uuid4().hex}"
    sh.write_shards(sd.ingest(d, F.col("source"), order="doc_id").drop("doc_id"), path, 1_000)
    back = sh.read_shards(spark, path)
    return back.select("id", F.md5("text").alias("text_md5"), "source", F.col("meta")["lang"].alias("lang"))


QUERIES = {
    "ingest_text_choice": (
        text_choice,
        f"""
        WITH laid AS (
          SELECT doc_id, 'text' AS variant, text, NULL AS content, NULL AS passage FROM documents
          UNION ALL SELECT doc_id, 'content', NULL, text, NULL FROM documents
          UNION ALL SELECT doc_id, 'passage', '', NULL, text FROM documents
          UNION ALL SELECT doc_id, 'blank', '{BLANKS}', text, NULL FROM documents
          UNION ALL SELECT doc_id, 'none', NULL, '', NULL FROM documents)
        SELECT doc_id, variant,
               md5(coalesce(nullif(text, ''), nullif(content, ''), nullif(passage, ''), '')) AS text_md5
        FROM laid""",
    ),
    "ingest_ids": (
        ids,
        f"""SELECT doc_id, sha256(source || ':' || doc_id) AS id, source FROM documents
            WHERE regexp_matches(text, '[^{WS}]')""",
    ),
    "ingest_meta": (
        meta,
        f"""SELECT doc_id, 'doc_id=' || doc_id || coalesce(';lang=' || nullif(lang, 'es'), '')
                   || ';n_chars=' || n_chars || ';source=' || source AS meta
            FROM documents WHERE regexp_matches(text, '[^{WS}]')""",
    ),
    "ingest_cap": (
        cap,
        f"""SELECT doc_id, md5(text) AS text_md5 FROM documents
            WHERE regexp_matches(text, '[^{WS}]') ORDER BY doc_id LIMIT 300""",
    ),
    "shard_roundtrip": (
        shard_roundtrip,
        f"""SELECT sha256(source || ':' || doc_id) AS id, md5(text) AS text_md5, source, lang FROM documents
            WHERE regexp_matches(text, '[^{WS}]')""",
    ),
}
