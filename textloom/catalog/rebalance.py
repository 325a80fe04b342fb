"""Queries over quotas, sampling and shuffling."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import documents
from textloom.catalog.language import sql_domain
from textloom.config import Settings
from textloom.operators import domain as dm
from textloom.operators import rebalance as rb

# One language is made to be missing, which puts its documents in "unknown".
MISSING = "es"
TARGETS = (100, 1_000, 50_000)


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir, "doc_id", "lang").withColumnRenamed("doc_id", "id")
    return d.withColumn("lang", F.nullif("lang", F.lit(MISSING)))


def cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.quotas(rb.group_sizes(tagged(spark, sf_dir)))


def log_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For targets below, near and above the corpus size."""
    sizes = rb.group_sizes(tagged(spark, sf_dir))
    parts = [
        rb.quotas(sizes, replace(Settings(), target_docs=t)).withColumn("target", F.lit(t)) for t in TARGETS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tagged(spark, sf_dir)
    return rb.sample(d, rb.quotas(rb.group_sizes(d))).select("id", "lang")


def sample_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tagged(spark, sf_dir)
    s = replace(Settings(), target_docs=TARGETS[0])
    return rb.sample(d, rb.quotas(rb.group_sizes(d), s), s).select("id", "lang")


def shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = replace(Settings(), shard_size=100)
    return rb.shuffled(tagged(spark, sf_dir), s).select("id", "position", "shard")


def rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rb.rebalance(tagged(spark, sf_dir)).select("id", "lang", "position", "shard")


def sample_lang_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced over pairs of language and domain, the domains put in as hints."""
    d = documents(spark, sf_dir, "doc_id", "text", "lang").withColumnRenamed("doc_id", "id")
    hint = F.when(F.col("id") % 6 == 0, "Theorem ").when(F.col("id") % 6 == 1, "Patient ").otherwise("")
    d = d.select("id", F.nullif("lang", F.lit(MISSING)).alias("lang"), dm.domain_of(F.concat(hint, "text")).alias("domain"))
    s = replace(Settings(), max_lang_fraction=0.1)
    return rb.sample(d, rb.quotas(rb.group_sizes(d, "lang", "domain"), s), s).select("id", "lang", "domain")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = tagged(spark, sf_dir)
    sizes = rb.group_sizes(d)
    return rb.balance_report(sizes, rb.sample(d, rb.quotas(sizes)))


TAGGED = f"tagged AS (SELECT doc_id AS id, coalesce(nullif(lang, '{MISSING}'), 'unknown') AS lang FROM documents)"
SIZES = "sizes AS (SELECT lang, count(*) AS docs FROM tagged GROUP BY lang)"
CAP = """quota AS (SELECT lang, docs,
    CAST(least(docs, round_even(CAST((SELECT sum(docs) FROM sizes) AS DOUBLE) * 0.3::DOUBLE, 0)) AS BIGINT) AS quota
    FROM sizes)"""


def _log(target: int) -> str:
    share = "least(ln(docs + 1) / (SELECT sum(ln(docs + 1)) FROM sizes), 0.3::DOUBLE)"
    return f"""SELECT lang, docs, CAST(least(round_even({share} * {target}, 0), docs) AS BIGINT) AS quota,
        {target} AS target FROM sizes"""


def sql_picked(seed: int = 42) -> str:
    return f"""picked AS (SELECT id, lang FROM (
        SELECT id, t.lang, quota, row_number() OVER (PARTITION BY t.lang ORDER BY md5('{seed}:' || id)) AS r
        FROM tagged t JOIN quota q ON t.lang = q.lang) WHERE r <= quota)"""


def sql_positions(source: str, columns: str, shard_size: int) -> str:
    return f"""SELECT {columns}, position, position // {shard_size} AS shard FROM (
        SELECT *, row_number() OVER (ORDER BY md5('43:' || id)) - 1 AS position FROM {source})"""


QUERIES = {
    "quota_cap": (cap, f"WITH {TAGGED}, {SIZES}, {CAP} SELECT lang, docs, quota FROM quota"),
    "quota_log": (log_shares, f"WITH {TAGGED}, {SIZES} " + " UNION ALL ".join(_log(t) for t in TARGETS)),
    "balanced_sample": (sample, f"WITH {TAGGED}, {SIZES}, {CAP}, {sql_picked()} SELECT id, lang FROM picked"),
    "balanced_sample_log": (
        sample_log,
        f"WITH {TAGGED}, {SIZES}, quota AS ({_log(TARGETS[0])}), {sql_picked()} SELECT id, lang FROM picked",
    ),
    "balanced_sample_lang_domain": (
        sample_lang_domain,
        f"""WITH tagged AS (
              SELECT doc_id AS id, coalesce(nullif(lang, '{MISSING}'), 'unknown') AS lang,
                     {sql_domain("lower(CASE doc_id % 6 WHEN 0 THEN 'Theorem ' WHEN 1 THEN 'Patient ' ELSE '' END || text)")}
                     AS domain
              FROM documents),
            sizes AS (SELECT lang, domain, count(*) AS docs FROM tagged GROUP BY ALL),
            quota AS (SELECT lang, domain, CAST(least(docs,
                round_even(CAST((SELECT sum(docs) FROM sizes) AS DOUBLE) * 0.1::DOUBLE, 0)) AS BIGINT) AS quota FROM sizes)
            SELECT id, lang, domain FROM (
              SELECT id, t.lang, t.domain, quota,
                     row_number() OVER (PARTITION BY t.lang, t.domain ORDER BY md5('42:' || id)) AS r
              FROM tagged t JOIN quota q ON t.lang = q.lang AND t.domain = q.domain) WHERE r <= quota""",
    ),
    "shuffled_order": (shuffled, f"WITH {TAGGED} {sql_positions('tagged', 'id', 100)}"),
    "rebalanced": (
        rebalanced,
        f"WITH {TAGGED}, {SIZES}, {CAP}, {sql_picked()} {sql_positions('picked', 'id, lang', 10_000)}",
    ),
    "balance_report": (
        report,
        f"""WITH {TAGGED}, {SIZES}, {CAP}, {sql_picked()}
            SELECT lang, docs, (SELECT count(*) FROM picked p WHERE p.lang = s.lang) AS sampled FROM sizes s""",
    ),
}
