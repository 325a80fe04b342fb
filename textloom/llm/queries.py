"""The registered queries of this subpackage: name -> (Spark query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from textloom.llm import (
    crossentropy,
    kneser,
    merkle,
    mixing,
    ngram_join,
    oracles,
    packing,
    quantised,
    ranking,
    rules,
    suffix,
    toxicity,
    vantage,
    warc,
)
from textloom.llm.common import folder
from textloom.llm.settings import MIX_WEIGHTS, tokenizer_paths, with_domain


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10, factor=1.5)


def op2_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicate(table(spark, sf_dir, "documents"))


def op3_quantised_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(with_domain(table(spark, sf_dir, "documents")), weights=MIX_WEIGHTS)
    text = F.md5(F.encode("mixed_text", "UTF-8")).alias("text_md5")
    tokens = ("n_tokens", "take_tokens", "stream_start")
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", *tokens, text)


def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select("doc_id", "severity", "severity_grade", "toxic_p", toxicity.rejected().alias("toxic"))


def op6_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).drop("digest")


def op7_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").filter("quality = 1")
    return crossentropy.score(table(spark, sf_dir, "documents"), target)


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    found = warc.resolve(warc.read(spark, path, bodies=False))
    return found.select(
        F.expr("try_cast(record_id as bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("try_cast(refers_to as bigint)").alias("refers_to"),
    )


def op9_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer_paths())


def op10_kneser_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return kneser.classify(table(spark, sf_dir, "documents"), trusted)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op13_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    "op1_vantage_search": (op1_vantage_search, None),
    "op2_suffix_repeats": (op2_suffix_repeats, None),
    "op3_quantised_duplicates": (op3_quantised_duplicates, oracles.COSINE),
    "op4_source_mix": (op4_source_mix, oracles.mix_sql()),
    "op5_ordinal_toxicity": (op5_ordinal_toxicity, None),
    "op6_shingle_join": (op6_shingle_join, oracles.SHINGLES),
    "op7_entropy_difference": (op7_entropy_difference, None),
    "op8_warc_revisits": (op8_warc_revisits, oracles.WARC),
    "op9_mixture_packing": (op9_mixture_packing, None),
    "op10_kneser_quality": (op10_kneser_quality, None),
    "op11_merkle_manifest": (op11_merkle_manifest, oracles.merkle_sql()),
    "op12_rule_ledger": (op12_rule_ledger, oracles.RULES),
    "op13_reversed_search": (op13_reversed_search, oracles.RANKING),
}
