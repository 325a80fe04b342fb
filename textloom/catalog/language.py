"""Queries over language, domain and source tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import documents, sql_variants, sql_words, variants
from textloom.functions import text as tx
from textloom.catalog.filters import REASON
from textloom.operators import domain as dm
from textloom.operators import filters as ft
from textloom.operators import language as lg
from textloom.session import materialize

FAR = 600  # characters put before a hint, beyond the domain window below
LANG_HEAD, DOMAIN_HEAD = 2_000, 500  # characters of the opt-in windows that two queries show


def fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lg.fit(documents(spark, sf_dir, "text", "lang"))


def model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(spark, sf_dir)


def detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the whole text, and by a window at its head."""
    m = materialize(fitted(spark, sf_dir), "model")
    d = documents(spark, sf_dir)
    head = lg.detect_language(d, m, LANG_HEAD).withColumnsRenamed({"lang": "lang_head", "conf": "conf_head"})
    both = lg.detect_language(head, m)
    return both.select(
        "doc_id", "lang_head", F.round("conf_head", 3).alias("conf_head"), "lang", F.round("conf", 3).alias("conf")
    )


def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct word as a text of its own: short texts are the ones that
    leave the detector in doubt."""
    words = documents(spark, sf_dir).select(F.explode(tx.words(F.col("text"))).alias("text")).distinct()
    tagged = lg.confident(lg.detect_language(words, fitted(spark, sf_dir)))
    return tagged.select(F.col("text").alias("word"), "lang", F.round("conf", 3).alias("lang_confidence"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every hint before it, near and far, and in pairs."""
    t = F.col("text")
    named = {"plain": t, "pair": F.concat(F.lit("The patient: Whereas "), t)}
    for domain, hints in dm.HINTS.items():
        for i, hint in enumerate(hints):
            named[f"{domain}{i}"] = F.concat(F.lit(f"So: {hint.upper()} "), t)
        named[f"{domain}_far"] = F.concat(F.lit("-" * FAR + hints[0]), t)
    return variants(documents(spark, sf_dir), named).select(
        "doc_id", "variant", dm.domain_of(t).alias("domain"), dm.domain_of(t, DOMAIN_HEAD).alias("domain_head")
    )


def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = fitted(spark, sf_dir)
    return lg.language_histogram(lg.confident(lg.detect_language(documents(spark, sf_dir), m)))


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source tag and the given language after the content filter."""
    d = documents(spark, sf_dir, "doc_id", "text", "source", "lang")
    tagged = ft.content_filter(d).withColumn("domain", dm.domain_of(F.col("text")))
    return tagged.groupBy("source", "lang", "domain").agg(F.count(F.lit(1)).alias("docs"))


def sql_grams(source: str, key: str, text: str = "text", row: str = "doc_id") -> str:
    """(key, gram): all 1- to 3-grams of a text; `row` tells the texts apart."""
    return f"""
        SELECT {key}, unnest([a, a || b, a || b || c]) AS gram FROM (
          SELECT {key}, ch AS a, lead(ch) OVER w AS b, lead(ch, 2) OVER w AS c
          FROM (SELECT {row} AS r, {key}, unnest(cs) AS ch, generate_subscripts(cs, 1) AS pos
                FROM (SELECT *, string_split({text}, '') AS cs FROM {source}))
          WINDOW w AS (PARTITION BY r ORDER BY pos))"""


MODEL = f"""
    seen AS (SELECT lang, gram, count(*) AS n FROM ({sql_grams("documents", "lang")}) WHERE gram IS NOT NULL GROUP BY ALL),
    model AS (
      SELECT l.lang, g.gram,
             CAST(round(ln((coalesce(s.n, 0) + 1) / (l.total + (SELECT count(DISTINCT gram) FROM seen))) * 1000000)
                  AS BIGINT) AS logp
      FROM (SELECT DISTINCT gram FROM seen) g
      CROSS JOIN (SELECT lang, sum(n) AS total FROM seen GROUP BY lang) l
      LEFT JOIN seen s ON s.lang = l.lang AND s.gram = g.gram)"""


def sql_detect(name: str, source: str, key: str, text: str) -> str:
    """CTEs ending in `name`: (key, lang, conf) for texts with known grams."""
    return f"""
    {name}_counted AS (SELECT {key}, gram, count(*) AS n FROM ({sql_grams(source, key, text, key)})
                        WHERE gram IS NOT NULL GROUP BY ALL),
    {name}_scores AS (SELECT {key}, lang, sum(n * logp) AS score
                      FROM {name}_counted JOIN model USING (gram) GROUP BY ALL),
    {name}_best AS (SELECT {key}, max(score) AS best FROM {name}_scores GROUP BY {key}),
    {name} AS (SELECT {key}, arg_min(lang, (-score, lang)) AS lang,
                      1 / sum(exp((score - best) / 1000000)) AS conf
               FROM {name}_scores JOIN {name}_best USING ({key}) GROUP BY {key})"""


_DOMAIN = {"plain": "text", "pair": "'The patient: Whereas ' || text"}
for _domain, _hints in dm.HINTS.items():
    for _i, _hint in enumerate(_hints):
        _DOMAIN[f"{_domain}{_i}"] = f"'So: {_hint.upper()} ' || text"
    _DOMAIN[f"{_domain}_far"] = f"repeat('-', {FAR}) || '{_hints[0]}' || text"


def sql_domain(text: str) -> str:
    arms = " ".join(
        "WHEN " + " OR ".join(f"contains({text}, '{h}')" for h in hints) + f" THEN '{d}'"
        for d, hints in dm.HINTS.items()
    )
    return f"CASE {arms} ELSE 'web' END"


QUERIES = {
    "lang_model": (model, f"WITH {MODEL} SELECT lang, gram, logp FROM model"),
    "lang_detect": (
        detect,
        f"""WITH {MODEL}, {sql_detect("head", "documents", "doc_id", f"text[1:{LANG_HEAD}]")},
            {sql_detect("whole", "documents", "doc_id", "text")}
            SELECT doc_id, coalesce(h.lang, 'unknown') AS lang_head, round(coalesce(h.conf, 0), 3) AS conf_head,
                   coalesce(w.lang, 'unknown') AS lang, round(coalesce(w.conf, 0), 3) AS conf
            FROM documents LEFT JOIN head h USING (doc_id) LEFT JOIN whole w USING (doc_id)""",
    ),
    "lang_gate": (
        gate,
        f"""WITH {MODEL}, words AS (SELECT DISTINCT unnest({sql_words("text")}) AS word FROM documents),
            {sql_detect("found", "words", "word", "word")}
            SELECT word, lang, round(conf, 3) AS lang_confidence FROM found WHERE conf >= 0.8""",
    ),
    "domain_tag": (
        domains,
        f"""SELECT doc_id, variant, {sql_domain("lower(text)")} AS domain,
                   {sql_domain(f"lower(text[1:{DOMAIN_HEAD}])")} AS domain_head
            FROM ({sql_variants(_DOMAIN)})""",
    ),
    "lang_histogram": (
        histogram,
        f"""WITH {MODEL}, {sql_detect("head", "documents", "doc_id", "text")}
            SELECT lang, count(*) AS docs FROM head WHERE conf >= 0.8
            GROUP BY lang ORDER BY docs DESC, lang LIMIT 15""",
    ),
    "source_counts": (
        source_counts,
        f"""SELECT source, lang, {sql_domain("lower(text)")} AS domain, count(*) AS docs
            FROM documents WHERE ({REASON}) IS NULL GROUP BY ALL""",
    ),
}
