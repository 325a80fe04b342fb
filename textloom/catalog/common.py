"""Shared by the registered queries: table loading, derived inputs, SQL pieces.

Where the given tables would leave an operator nothing to do, inputs are derived
from every row of them: each row enters once per named variant of its text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.sources.documents import spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


def variants(df: DataFrame, named: dict[str, Column], column: str = "text") -> DataFrame:
    """Every row once per variant: `variant` names it, `column` is its text."""
    pairs = F.array(*[F.struct(F.lit(n).alias("variant"), c.alias("t")) for n, c in named.items()])
    others = [c for c in df.columns if c != column]
    exploded = df.select(*others, F.explode(pairs).alias("_v"))
    return exploded.select(*others, F.col("_v.variant").alias("variant"), F.col("_v.t").alias(column))


# Fixed values of the SQL side, in the notation of its regular expressions.
WS = r"\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
LINE_BREAK = r"\r\n|[\n-\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
CONTROL = r"[\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}-\x{9F}]"


def sql_variants(named: dict[str, str], source: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    """The same variants as SQL: (key, variant, text)."""
    return " UNION ALL ".join(
        f"SELECT {key}, '{name}' AS variant, {expr} AS text FROM (SELECT {key}, {text} AS text FROM {source})"
        for name, expr in named.items()
    )


def sql_words(text: str) -> str:
    return f"regexp_extract_all({text}, '[^{WS}]+')"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def sql_lines(text: str) -> str:
    """Non-blank lines."""
    return f"list_filter(string_split_regex({text}, '{LINE_BREAK}'), lambda l: regexp_matches(l, '[^{WS}]'))"


def sql_tidy(text: str) -> str:
    return f"array_to_string(list_transform({sql_lines(text)}, lambda l: {sql_strip('l')}), chr(10))"
