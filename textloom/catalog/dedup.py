"""Queries over near-duplicate removal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import WS, documents, sql_words
from textloom.config import Settings
from textloom.functions import text as tx
from textloom.operators import counters as ct
from textloom.operators import dedup as dd


def copied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text): every document, followed by copies of it without its last
    word and without its last two words."""
    t = F.col("text")
    one = F.regexp_replace(t, rf"[{tx.WS}]+{tx.NON_WS}+\z", "")
    two = F.regexp_replace(one, rf"[{tx.WS}]+{tx.NON_WS}+\z", "")
    each = documents(spark, sf_dir).select("doc_id", F.posexplode(F.array(t, one, two)).alias("copy", "text"))
    return each.select((F.col("doc_id") * 3 + F.col("copy")).alias("ord"), "text")


def shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.array_sort(dd.shingles(F.col("text")))
    return documents(spark, sf_dir).select(
        "doc_id", F.size(s).alias("n"), F.md5(F.array_join(s, "|")).alias("shingles_md5")
    )


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    signed = documents(spark, sf_dir).select("doc_id", dd.minhash(F.col("text")).alias("s"))
    return signed.select("doc_id", F.md5(F.concat_ws(",", "s")).alias("signature_md5"))


def buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = dd.with_band_keys(copied(spark, sf_dir), "ord")
    return keyed.select("ord", F.posexplode("keys").alias("band", "key")).withColumn("key", F.hex("key"))


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.deduplicate(copied(spark, sf_dir), "ord").select("ord", F.md5("text").alias("text_md5"))


def exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.exact_copies(documents(spark, sf_dir), "doc_id")


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = dd.with_band_keys(copied(spark, sf_dir), "ord")
    lost = dd.dropped_documents(keys, "ord").withColumn("lost", F.lit(True))
    marked = copied(spark, sf_dir).select("ord").join(lost, "ord", "left")
    row = ct.stage_counters(marked, F.col("lost"), "dedup")
    return row.withColumnRenamed("docs_out", "removed").withColumn("percent", F.round("percent", 6))


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.candidate_jaccard(copied(spark, sf_dir), "ord")


def precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over copies and, as candidates of middling likeness, every document's
    first two thirds of words."""
    return dd.lsh_precision(dd.candidate_jaccard(halved(spark, sf_dir), "ord", LOOSE), LOOSE.minhash_threshold)


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dd.deduplicate(halved(spark, sf_dir), "ord", LOOSE, verify=True).select("ord", F.md5("text").alias("text_md5"))


#: Few values a band: many candidates that are not near, for the verified rule.
LOOSE = Settings(minhash_threshold=0.6, minhash_perms=32)


def halved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ord, text): every document, and its first two thirds of words."""
    part = tx.bind(tx.words(F.col("text")), lambda w: F.array_join(F.slice(w, 1, F.ceil(F.size(w) * 2 / 3).cast("int")), " "))
    each = documents(spark, sf_dir).select("doc_id", F.posexplode(F.array(F.col("text"), part)).alias("copy", "text"))
    return each.select((F.col("doc_id") * 2 + F.col("copy")).alias("ord"), "text")


def _cut(text: str) -> str:
    return f"regexp_replace({text}, '[{WS}]+[^{WS}]+$', '')"


COPIED = f"""copied AS (
    SELECT doc_id * 3 AS ord, text FROM documents
    UNION ALL SELECT doc_id * 3 + 1, {_cut("text")} FROM documents
    UNION ALL SELECT doc_id * 3 + 2, {_cut(_cut("text"))} FROM documents)"""


def sql_shingles(source: str, key: str) -> str:
    """(key, s): distinct shingles of five words, shorter only where a text has
    fewer words than that."""
    return f"""SELECT DISTINCT {key}, s FROM (
        SELECT {key}, pos, n, array_to_string([w1, lead(w1) OVER p, lead(w1, 2) OVER p, lead(w1, 3) OVER p,
                                               lead(w1, 4) OVER p], ' ') AS s
        FROM (SELECT {key}, len(w) AS n, unnest(w) AS w1, generate_subscripts(w, 1) AS pos
              FROM (SELECT {key}, {sql_words("text")} AS w FROM {source}))
        WINDOW p AS (PARTITION BY {key} ORDER BY pos))
      WHERE pos <= greatest(1, n - 4)
      UNION ALL SELECT {key}, '' FROM {source} WHERE len({sql_words("text")}) = 0"""


def sql_signatures(source: str, key: str, perms: int = 128) -> str:
    """CTEs ending in `signed`: (key, j, v), the j-th value of each signature.

    The coefficients are 61-bit random draws, stated as values."""
    a, b = dd.coefficients(perms)
    values = ", ".join(f"({j}, {int(x)}::HUGEINT, {int(y)}::HUGEINT)" for j, (x, y) in enumerate(zip(a, b)))
    return f"""
    family(j, a, b) AS (VALUES {values}),
    hashed AS (
      SELECT DISTINCT {key}, ('0x' || h[7:8] || h[5:6] || h[3:4] || h[1:2])::BIGINT::HUGEINT AS h
      FROM (SELECT {key}, sha1(s) AS h FROM ({sql_shingles(source, key)}))),
    signed AS (
      SELECT {key}, j, CAST(min(CAST((a * h + b) & 18446744073709551615::HUGEINT AS UBIGINT)
                                % 2305843009213693951::UBIGINT % 4294967296::UBIGINT) AS BIGINT) AS v
      FROM hashed CROSS JOIN family GROUP BY {key}, j)"""




def sql_buckets(bands: int, rows: int) -> str:
    return f"""buckets AS (
    SELECT ord, j // {rows} AS band, md5((j // {rows}) || ',' || string_agg(v, ',' ORDER BY j)) AS key
    FROM signed WHERE j < {bands * rows} GROUP BY ord, j // {rows})"""


BUCKETS = sql_buckets(8, 16)

HALVED = f"""copied AS (
    SELECT doc_id * 2 AS ord, text FROM documents
    UNION ALL SELECT doc_id * 2 + 1, array_to_string({sql_words("text")}[1:CAST(ceil(len({sql_words("text")}) * 2 / 3) AS INT)], ' ')
    FROM documents)"""


def sql_pairs(which: str) -> str:
    """CTEs ending in `compared`: (head, ord, common, total, jaccard) of the pairs."""
    return f"""
    grams AS ({sql_shingles("copied", "ord")}),
    sizes AS (SELECT ord, count(*) AS size FROM grams GROUP BY ord),
    pairs AS ({which}),
    met AS (SELECT head, p.ord, count(*) AS common FROM pairs p JOIN grams a ON a.ord = head
            JOIN grams b ON b.ord = p.ord AND b.s = a.s GROUP BY ALL),
    compared AS (SELECT p.head, p.ord, coalesce(common, 0) AS common, a.size + b.size - coalesce(common, 0) AS total,
                        coalesce(common, 0)::DOUBLE / (a.size + b.size - coalesce(common, 0)) AS jaccard
                 FROM pairs p JOIN sizes a ON a.ord = head JOIN sizes b ON b.ord = p.ord
                 LEFT JOIN met m ON m.head = p.head AND m.ord = p.ord)"""


FIRSTS = """SELECT DISTINCT head, ord FROM buckets
    JOIN (SELECT key, min(ord) AS head FROM buckets GROUP BY key) USING (key) WHERE ord <> head"""
ALL_PAIRS = """SELECT DISTINCT a.ord AS head, b.ord FROM buckets a JOIN buckets b ON a.key = b.key AND a.ord < b.ord"""
_LOOSE = f"{HALVED}, {sql_signatures('copied', 'ord', LOOSE.minhash_perms)}, " + sql_buckets(
    *dd.banding(LOOSE.minhash_threshold, LOOSE.minhash_perms)
)

VERIFIED_WALK = f"""
    lists AS MATERIALIZED (SELECT i, any_value(n.ord) AS ord, coalesce(list(head) FILTER (WHERE head IS NOT NULL), []::BIGINT[]) AS near
              FROM (SELECT ord, row_number() OVER (ORDER BY ord) AS i FROM copied) n
              LEFT JOIN (SELECT head, ord FROM compared WHERE jaccard >= {LOOSE.minhash_threshold}::DOUBLE) c ON c.ord = n.ord
              GROUP BY i),
    walk(i, ord, keep, kept) AS (
      SELECT 0::BIGINT, -1::BIGINT, false, []::BIGINT[]
      UNION ALL
      SELECT l.i, l.ord, NOT list_has_any(w.kept, l.near),
             CASE WHEN list_has_any(w.kept, l.near) THEN w.kept ELSE list_append(w.kept, l.ord) END
      FROM walk w JOIN lists l ON l.i = w.i + 1)"""

# The walk itself: one document after the other, against the buckets of all
# kept so far. Buckets of a single document decide nothing and stay out.
WALK = """
    numbered AS (SELECT ord, row_number() OVER (ORDER BY ord) AS i FROM (SELECT DISTINCT ord FROM buckets)),
    shared AS (SELECT key, row_number() OVER (ORDER BY key) AS k FROM buckets GROUP BY key HAVING count(*) > 1),
    lists AS (SELECT i, any_value(numbered.ord) AS ord,
                     coalesce(list(k) FILTER (WHERE k IS NOT NULL), []::BIGINT[]) AS ks
              FROM numbered JOIN buckets USING (ord) LEFT JOIN shared USING (key) GROUP BY i),
    walk(i, ord, keep, kept) AS (
      SELECT 0::BIGINT, -1::BIGINT, false, []::BIGINT[]
      UNION ALL
      SELECT l.i, l.ord, NOT list_has_any(w.kept, l.ks),
             CASE WHEN list_has_any(w.kept, l.ks) THEN w.kept ELSE list_concat(w.kept, l.ks) END
      FROM walk w JOIN lists l ON l.i = w.i + 1)"""

QUERIES = {
    "shingles": (
        shingles,
        f"""SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS shingles_md5
            FROM ({sql_shingles("documents", "doc_id")}) GROUP BY doc_id""",
    ),
    "minhash_signatures": (
        signatures,
        f"""WITH {sql_signatures("documents", "doc_id").strip()}
            SELECT doc_id, md5(string_agg(v, ',' ORDER BY j)) AS signature_md5 FROM signed GROUP BY doc_id""",
    ),
    "lsh_buckets": (
        buckets,
        f"""WITH {COPIED}, {sql_signatures("copied", "ord")}, {BUCKETS}
            SELECT ord, band, upper(key) AS key FROM buckets""",
    ),
    "dedup_kept": (
        kept,
        f"""WITH RECURSIVE {COPIED}, {sql_signatures("copied", "ord")}, {BUCKETS}, {WALK}
            SELECT ord, md5(text) AS text_md5 FROM walk JOIN copied USING (ord) WHERE keep""",
    ),
    "dedup_exact": (
        exact,
        """SELECT doc_id, doc_id <> min(doc_id) OVER (PARTITION BY text) AS is_copy FROM documents""",
    ),
    "dedup_counters": (
        counters,
        f"""WITH RECURSIVE {COPIED}, {sql_signatures("copied", "ord")}, {BUCKETS}, {WALK}
            SELECT 'dedup' AS stage, count(*) AS docs_in, count(*) FILTER (WHERE NOT keep) AS removed,
                   round(100 * count(*) FILTER (WHERE NOT keep) / greatest(count(*), 1), 6) AS percent
            FROM walk WHERE i > 0""",
    ),
    "candidate_jaccard": (
        compared,
        f"""WITH {COPIED}, {sql_signatures("copied", "ord")}, {BUCKETS}, {sql_pairs(FIRSTS)}
            SELECT head, ord, common, total, jaccard FROM compared""",
    ),
    "lsh_precision": (
        precision,
        f"""WITH {_LOOSE}, {sql_pairs(FIRSTS)}
            SELECT count(*) AS candidates, count(*) FILTER (WHERE jaccard >= {LOOSE.minhash_threshold}::DOUBLE) AS near,
                   count(*) FILTER (WHERE jaccard >= {LOOSE.minhash_threshold}::DOUBLE)::DOUBLE / nullif(count(*), 0) AS precision
            FROM compared""",
    ),
    "dedup_verified": (
        verified,
        f"""WITH RECURSIVE {_LOOSE}, {sql_pairs(ALL_PAIRS)}, {VERIFIED_WALK}
            SELECT ord, md5(text) AS text_md5 FROM walk JOIN copied USING (ord) WHERE keep""",
    ),
}
