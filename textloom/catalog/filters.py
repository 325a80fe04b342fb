"""Queries over the content predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import (
    CONTROL,
    LINE_BREAK,
    WS,
    documents,
    sql_lines,
    sql_strip,
    sql_variants,
    sql_words,
    variants,
)
from textloom.functions import text as tx
from textloom.operators import boilerplate as bp
from textloom.operators import counters as ct
from textloom.operators import filters as ft

_NONWS = tx.NON_WS


def damaged(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Every document as it is and in forms that break one rule or another."""
    t = F.col("text")
    named = {
        "plain": t,
        "control_first": F.concat(F.lit("\x01"), t),
        "control_last": F.concat(t, F.lit("\x01")),
        "tagged": F.regexp_replace(t, rf"({_NONWS}+)", "<b>$1</b>"),
        "some_tags": F.regexp_replace(t, rf"\b([A-E]{_NONWS}*)", "<i>$1"),
        "narrow": F.replace(t, F.lit(" "), F.lit("\n")),
        "blank": F.regexp_replace(t, _NONWS, " "),
        "paragraphs": F.replace(t, F.lit(". "), F.lit(".\r\n \t\n  ")),
    }
    return variants(documents(spark, sf_dir), {n: named[n] for n in names or named})


_SQL = {
    "plain": "text",
    "control_first": "chr(1) || text",
    "control_last": "text || chr(1)",
    "tagged": rf"regexp_replace(text, '([^{WS}]+)', '<b>\1</b>', 'g')",
    "some_tags": rf"regexp_replace(text, '(^|[^\pL\pN\pM])([A-E][^{WS}]*)', '\1<i>\2', 'g')",
    "narrow": "replace(text, ' ', chr(10))",
    "blank": f"regexp_replace(text, '[^{WS}]', ' ', 'g')",
    "paragraphs": "replace(text, '. ', '.' || chr(13) || chr(10) || ' ' || chr(9) || chr(10) || '  ')",
}


def _damaged_sql(*names: str) -> str:
    return sql_variants({n: _SQL[n] for n in names or _SQL})


BINARY = f"regexp_matches(text, '{CONTROL}')"
HEAD = 2_000  # characters of the opt-in window that one query shows
TAGS = "len(regexp_extract_all(text, '<[^>]{1,100}>'))"
HEAVY = f"(len({sql_words('text')}) > 0 AND {TAGS} / len({sql_words('text')}) > 0.1)"
N_LINES = f"len({sql_lines('text')})"
MEAN = f"(list_sum(list_transform({sql_lines('text')}, lambda l: length(l))) / {N_LINES})"
REASON = f"""CASE WHEN {BINARY} THEN 'binary' WHEN {HEAVY} THEN 'html'
    WHEN length(text) NOT BETWEEN 100 AND 1000000 THEN 'length'
    WHEN {N_LINES} = 0 THEN 'blank' WHEN {MEAN} < 20 THEN 'short_lines' END"""


def binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the whole text, and by a window at its head."""
    d = damaged(spark, sf_dir, "plain", "control_first", "control_last")
    t = F.col("text")
    return d.select(
        "doc_id",
        "variant",
        ft.looks_binary(t).alias("is_binary"),
        ft.looks_binary(t, HEAD).alias("is_binary_head"),
    )


def html_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = damaged(spark, sf_dir, "plain", "tagged", "some_tags", "blank")
    return d.select("doc_id", "variant", ft.tag_heavy(F.col("text")).alias("heavy"))


def length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", ft.length_ok(F.col("text")).alias("length_ok"))


def line_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = damaged(spark, sf_dir, "plain", "narrow", "blank", "paragraphs")
    judged = d.select("doc_id", "variant", ft.line_verdicts(F.col("text")).alias("v"))
    return judged.select(
        "doc_id",
        "variant",
        F.col("v.has_line").alias("has_line"),
        F.round("v.mean_length", 6).alias("mean_length"),
        F.coalesce("v.long_enough", F.lit(False)).alias("long_enough"),
    )


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = damaged(spark, sf_dir)
    return d.select("doc_id", "variant", F.coalesce(ft.reject_reason(F.col("text")), F.lit("kept")).alias("reason"))


def content_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.content_filter(damaged(spark, sf_dir)).select("doc_id", "variant", F.md5("text").alias("text_md5"))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = damaged(spark, sf_dir)
    row = ct.stage_counters(d, ft.reject_reason(F.col("text")).isNull(), "filter")
    return row.withColumn("percent", F.round("percent", 6))


MIN_DOCS = 5


def boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that MIN_DOCS or more documents have."""
    d = documents(spark, sf_dir)
    cleaned = bp.drop_repeated_lines(d, bp.repeated_lines(d, MIN_DOCS), "doc_id")
    return cleaned.select("doc_id", "dropped_lines", F.md5("text").alias("text_md5"))


QUERIES = {
    "boilerplate_lines": (
        boilerplate,
        f"""WITH cut AS (SELECT doc_id, text, string_split_regex(text, '{LINE_BREAK}') AS ls FROM documents),
            places AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM cut),
            full_lines AS (SELECT doc_id, place, line, {sql_strip("line")} AS t FROM places
                           WHERE regexp_matches(line, '[^{WS}]')),
            repeated AS (SELECT t FROM full_lines GROUP BY t HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
            gone AS (SELECT doc_id, place FROM full_lines WHERE t IN (SELECT t FROM repeated)),
            rest AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text FROM places
                     ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
            SELECT doc_id, CAST(coalesce(n, 0) AS INT) AS dropped_lines,
                   md5(CASE WHEN n IS NULL THEN c.text ELSE coalesce(r.text, '') END) AS text_md5
            FROM cut c LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
            LEFT JOIN rest r USING (doc_id)""",
    ),
    "filter_binary": (
        binary,
        f"""SELECT doc_id, variant, {BINARY} AS is_binary, regexp_matches(text[1:{HEAD}], '{CONTROL}') AS is_binary_head
            FROM ({_damaged_sql("plain", "control_first", "control_last")})""",
    ),
    "filter_html_ratio": (
        html_ratio,
        f"SELECT doc_id, variant, {HEAVY} AS heavy FROM ({_damaged_sql('plain', 'tagged', 'some_tags', 'blank')})",
    ),
    "filter_length": (length, "SELECT doc_id, length(text) BETWEEN 100 AND 1000000 AS length_ok FROM documents"),
    "filter_line_len": (
        line_length,
        f"""SELECT doc_id, variant, {N_LINES} > 0 AS has_line,
                   CASE WHEN {N_LINES} > 0 THEN round({MEAN}, 6) END AS mean_length,
                   {N_LINES} > 0 AND coalesce({MEAN} >= 20, false) AS long_enough
            FROM ({_damaged_sql("plain", "narrow", "blank", "paragraphs")})""",
    ),
    "filter_reasons": (
        reasons,
        f"SELECT doc_id, variant, coalesce({REASON}, 'kept') AS reason FROM ({_damaged_sql()})",
    ),
    "content_filter": (
        content_filter,
        f"SELECT doc_id, variant, md5(text) AS text_md5 FROM ({_damaged_sql()}) WHERE ({REASON}) IS NULL",
    ),
    "stage_counters": (
        counters,
        f"""SELECT 'filter' AS stage, count(*) AS docs_in, count(*) FILTER (WHERE r IS NULL) AS docs_out,
                   round(100 * count(*) FILTER (WHERE r IS NULL) / greatest(count(*), 1), 6) AS percent
            FROM (SELECT {REASON} AS r FROM ({_damaged_sql()}))""",
    ),
}
