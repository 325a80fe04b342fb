"""Queries over text repair. Damage is put into every document, so the SQL is
mostly a known answer: the text before the damage."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import documents, sql_variants, variants
from textloom.functions import repair as rp
from textloom.operators import counters as ct
from textloom.operators import encoding as en


def _latin1(text: Column) -> Column:
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _cp1252(text: Column) -> Column:
    return F.translate(_latin1(text), rp.C1, rp.CP1252)


def _swapped(text: Column, table: dict[str, str]) -> Column:
    for old, new in table.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


LIGATED = {"ffi": "ﬃ", "ff": "ﬀ", "fi": "ﬁ", "fl": "ﬂ", "st": "ﬆ", "nj": "ǌ"}
NAMED = {"é": "&eacute;", "ü": "&uuml;", "ñ": "&#241;", " and ": " &amp; "}
COMBINED = {c: unicodedata.normalize("NFD", c) for c in "éèêüñç"}
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in LETTERS)


def _md5(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "variant", F.md5("text").alias("text_md5"))


def mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    named = {"plain": t, "latin1": _latin1(t), "cp1252": _cp1252(t), "twice": _latin1(_latin1(t))}
    d = variants(documents(spark, sf_dir), named)
    for _ in range(2):
        d = d.withColumn("text", rp.repair_mojibake(F.col("text")))
    return _md5(d)


GOOD = " — naïve 漢"  # put at the end of every line


def mojibake_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines that also hold good accents and other characters."""
    t = F.col("text")
    named = {"plain": t, "latin1": _latin1(t), "cp1252": _cp1252(t)}
    named = {n: F.concat(F.replace(d, F.lit("\n"), F.lit(f"{GOOD}\n")), F.lit(GOOD)) for n, d in named.items()}
    d = variants(documents(spark, sf_dir), named)
    return _md5(d.withColumn("text", rp.repair_mojibake(F.col("text"))))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a tag in the last line, that line keeps its references."""
    coded = _swapped(F.col("text"), NAMED)
    d = variants(documents(spark, sf_dir), {"no_tag": coded, "tag_last": F.concat(coded, F.lit("\n<b>&eacute;</b>"))})
    return _md5(d.withColumn("text", rp.unescape_plain(F.col("text"))))


def ligatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    d = variants(documents(spark, sf_dir), {"plain": t, "ligated": _swapped(t, LIGATED)})
    return _md5(d.withColumn("text", rp.split_ligatures(F.col("text"))))


def width(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    wide = F.translate(t, LETTERS + " ", WIDE + "\u3000")
    return _md5(variants(documents(spark, sf_dir), {"plain": t, "wide": wide}).withColumn("text", rp.normal_width(t)))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    named = {
        "single": F.replace(t, F.lit(" "), F.lit(" ‘")),
        "low": F.replace(t, F.lit(","), F.lit("‚")),
        "double": F.replace(F.replace(t, F.lit("."), F.lit("”")), F.lit(" "), F.lit(" “")),
    }
    return _md5(variants(documents(spark, sf_dir), named).withColumn("text", rp.straight_quotes(t)))


def newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    breaks = {"crlf": "\r\n", "cr": "\r", "ls": "\u2028", "ps": "\u2029", "nel": "\x85"}
    named = {n: F.replace(t, F.lit("\n"), F.lit(b)) for n, b in breaks.items()}
    return _md5(variants(documents(spark, sf_dir), named).withColumn("text", rp.plain_newlines(t)))


def controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    marks = {"bell": "\x07", "colour": "\x1b[1;31m", "bom": "\ufeff", "delete": "\x7f", "feed": "\x0b\x0e"}
    named = {n: F.replace(t, F.lit(" "), F.lit(" " + m)) for n, m in marks.items()}
    return _md5(variants(documents(spark, sf_dir), named).withColumn("text", rp.drop_controls(t)))


def composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    named = {"plain": t, "apart": _swapped(t, COMBINED), "marked": F.replace(t, F.lit("a"), F.lit("a\u0323\u0302"))}
    return _md5(variants(documents(spark, sf_dir), named).withColumn("text", rp.compose(t)))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All damage at once, in the order opposite to the repairs."""
    t = F.col("text")
    crlf = F.replace(t, F.lit("\n"), F.lit("\r\n"))
    named = {
        "plain": t,
        "mojibake": _cp1252(t),
        "references": _swapped(t, NAMED),
        "all": _swapped(_latin1(F.concat(F.lit("“"), crlf)), {" ": " \x07", "ffi": "ﬃ"}),
        "apart": _swapped(t, COMBINED),
    }
    return variants(documents(spark, sf_dir), named)


def recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = en.recover_encoding(_damaged(spark, sf_dir), flag="changed")
    return fixed.select("doc_id", "variant", F.md5("text").alias("text_md5"), "changed")


def fixed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = en.recover_encoding(_damaged(spark, sf_dir), flag="changed")
    row = ct.stage_counters(fixed.select("changed"), F.col("changed"), "encoding")
    return row.withColumnRenamed("docs_out", "fixed").withColumn("percent", F.round("percent", 6))


def _replaces(table: dict[str, str], text: str = "text") -> str:
    for old, new in table.items():
        text = f"replace({text}, '{old}', '{new}')"
    return text


def _answer(named: dict[str, str]) -> str:
    return f"SELECT doc_id, variant, md5(text) AS text_md5 FROM ({sql_variants(named)})"


_PLAIN_NAMED = "replace(text, ' and ', ' & ')"
_RECOVERED = {
    "plain": ("text", "false"),
    "mojibake": ("text", r"regexp_matches(text, '[^\x{00}-\x{7F}]')"),
    "references": (_PLAIN_NAMED, "regexp_matches(text, '[éüñ]| and ')"),
    "all": ("chr(34) || text", "true"),
    "apart": ("text", "regexp_matches(text, '[éèêüñç]')"),
}
_RECOVERED_SQL = " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS variant, md5({answer}) AS text_md5, {changed} AS changed FROM documents"
    for n, (answer, changed) in _RECOVERED.items()
)

QUERIES = {
    "mojibake_mixed": (
        mojibake_mixed,
        _answer(dict.fromkeys(("plain", "latin1", "cp1252"), f"replace(text, chr(10), '{GOOD}' || chr(10)) || '{GOOD}'")),
    ),
    "mojibake_repair": (mojibake, _answer(dict.fromkeys(("plain", "latin1", "cp1252", "twice"), "text"))),
    "entities": (
        references,
        _answer({"no_tag": _PLAIN_NAMED, "tag_last": f"{_PLAIN_NAMED} || chr(10) || '<b>&eacute;</b>'"}),
    ),
    "ligatures": (ligatures, _answer({"plain": "text", "ligated": "text"})),
    "width": (width, _answer({"plain": "text", "wide": "text"})),
    "quotes": (
        quotes,
        _answer(
            {
                "single": "replace(text, ' ', ' ' || chr(39))",
                "low": "replace(text, ',', chr(39))",
                "double": "replace(replace(text, '.', chr(34)), ' ', ' ' || chr(34))",
            }
        ),
    ),
    "line_breaks": (newlines, _answer(dict.fromkeys(("crlf", "cr", "ls", "ps", "nel"), "text"))),
    "control_chars": (controls, _answer(dict.fromkeys(("bell", "colour", "bom", "delete", "feed"), "text"))),
    "nfc": (
        composed,
        _answer(
            {
                "plain": "nfc_normalize(text)",
                "apart": f"nfc_normalize({_replaces(COMBINED)})",
                "marked": "nfc_normalize(replace(text, 'a', 'a' || chr(803) || chr(770)))",
            }
        ),
    ),
    "encoding_recovery": (recovery, _RECOVERED_SQL),
    "encoding_fixed_counts": (
        fixed_counts,
        f"""SELECT 'encoding' AS stage, count(*) AS docs_in, count(*) FILTER (WHERE changed) AS fixed,
                   round(100 * count(*) FILTER (WHERE changed) / greatest(count(*), 1), 6) AS percent
            FROM ({_RECOVERED_SQL})""",
    ),
}
