"""The whole chain, from documents with near copies to the balanced corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import documents, sql_tidy
from textloom.catalog.dedup import BUCKETS, COPIED, WALK, copied, sql_signatures
from textloom.catalog.filters import REASON
from textloom.catalog.language import MODEL, fitted, sql_detect, sql_domain
from textloom.catalog.rebalance import CAP, SIZES, sql_picked, sql_positions
from textloom.operators.counters import Counters
from textloom.plans import stages


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = copied(spark, sf_dir).withColumn("id", F.col("ord"))
    balanced = stages.prepare(docs, fitted(spark, sf_dir), order="ord")
    return balanced.select("id", F.md5("text").alias("text_md5"), "lang", "lang_confidence", "domain", "position", "shard")


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in and out of every stage, counted by the jobs that write them."""
    seen = Counters()
    docs = copied(spark, sf_dir).withColumn("id", F.col("ord"))
    stages.prepare(docs, fitted(spark, sf_dir), order="ord", counters=seen)
    return seen.table(spark).withColumn("percent", F.round("percent", 6))


def sources_through(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source tag on the way through the narrow stages."""
    cleaned = stages.clean(documents(spark, sf_dir, "doc_id", "text", "source"))
    return cleaned.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("text")).alias("chars"))


STEPS = f"""{COPIED},
    tidy AS (SELECT ord, {sql_tidy("text")} AS text FROM copied WHERE ({REASON}) IS NULL),
    {MODEL}, {sql_detect("found", "tidy", "ord", "text")},
    confident AS (SELECT ord, text, lang, round(conf, 3) AS lang_confidence,
                         {sql_domain("lower(text)")} AS domain
                  FROM tidy JOIN found USING (ord) WHERE conf >= 0.8),
    {sql_signatures("confident", "ord")}, {BUCKETS}, {WALK},
    tagged AS (SELECT ord AS id, text, lang, lang_confidence, domain
               FROM walk JOIN confident USING (ord) WHERE keep),
    {SIZES}, {CAP}, {sql_picked()}"""


QUERIES = {
    "stage_chain": (
        chain,
        f"""WITH RECURSIVE {STEPS},
            full_rows AS (SELECT t.* FROM tagged t JOIN picked USING (id))
            {sql_positions("full_rows", "id, md5(text) AS text_md5, lang, lang_confidence, domain", 10_000)}""",
    ),
    "chain_counters": (
        counted,
        f"""WITH RECURSIVE {STEPS},
            sized AS (SELECT 0 AS k, 'input' AS stage, count(*) AS docs FROM copied
                      UNION ALL SELECT 1, 'filtered', count(*) FROM tidy
                      UNION ALL SELECT 2, 'extracted', count(*) FROM tidy WHERE text <> ''
                      UNION ALL SELECT 3, 'recovered', count(*) FROM tidy WHERE text <> ''
                      UNION ALL SELECT 4, 'tagged', count(*) FROM confident
                      UNION ALL SELECT 5, 'unique', count(*) FROM tagged
                      UNION ALL SELECT 6, 'balanced', count(*) FROM picked)
            SELECT stage, docs_in, docs AS docs_out, round(100 * docs / greatest(docs_in, 1), 6) AS percent
            FROM (SELECT *, lag(docs) OVER (ORDER BY k) AS docs_in FROM sized) WHERE k > 0""",
    ),
    "clean_sources": (
        sources_through,
        f"""SELECT source, count(*) AS docs, CAST(sum(length({sql_tidy("text")})) AS BIGINT) AS chars
            FROM documents WHERE ({REASON}) IS NULL GROUP BY source""",
    ),
}
