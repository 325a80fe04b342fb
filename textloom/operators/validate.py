"""Checks and corpus metrics of a trained vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.config import Settings
from textloom.functions import text as tx
from textloom.operators import bpe_encode as be
from textloom.operators import bpe_train as bt
from textloom.operators import vocab as vb
from textloom.operators.bpe_train import Vocabulary
from textloom.operators.ordering import first_n
from textloom.session import materialize

# The texts every vocabulary is probed with.
PROBES = {
    "english": "The quick brown fox jumps over the lazy dog.",
    "chinese": "人工智能正在改变世界的方方面面。",
    "arabic": "الذكاء الاصطناعي يغير العالم بطرق لا تعد ولا تحصى.",
    "russian": "Искусственный интеллект меняет мир.",
    "code_python": "def fibonacci(n):\n    return n if n <= 1 else fibonacci(n-1) + fibonacci(n-2)",
    "math": "∑_{i=1}^{n} i = n(n+1)/2  and  ∫₀¹ x² dx = 1/3",
    "multilingual": "Hello Bonjour Hola 你好 مرحبا Привет こんにちは",
    "unicode_edge": "Ｈｅｌｌｏ　Ｗｏｒｌｄ！ ← full-width",
}
PROBE_SENTENCE = "Hello world! This is a tokenizer validation test."


def probe_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(PROBES.items()), "label string, text string")


def roundtrip(df: DataFrame, model: Vocabulary, column: str = "text") -> DataFrame:
    """Add `n_tokens` and `ok`: does decoding give the text back, ends trimmed?"""
    encoded = df.withColumn("_ids", be.encode(F.col(column), model))
    same = tx.strip(F.col(column)) == tx.strip(be.decode(F.col("_ids"), model))
    return encoded.withColumns({"n_tokens": F.size("_ids"), "ok": same}).drop("_ids")


def validation_sample(df: DataFrame, order: str, n: int = 0, column: str = "text") -> DataFrame:
    """(order, text) of the first n non-blank documents (0: of all), texts trimmed."""
    trimmed = df.select(order, tx.strip(tx.or_empty(F.col(column))).alias("text"))
    return first_n(trimmed.filter(F.col("text") != ""), order, n)


def probe_tokens(spark: SparkSession, model: Vocabulary, sentence: str = PROBE_SENTENCE) -> DataFrame:
    """(place, id, token) of a sentence, <s> and </s> included."""
    one = spark.createDataFrame([(sentence,)], "text string").select(be.encode(F.col("text"), model).alias("ids"))
    both = one.withColumn("tokens", be.token_strings(F.col("ids"), model))
    return both.select(F.posexplode(F.arrays_zip("ids", "tokens")).alias("place", "t")).select(
        "place", F.col("t.ids").alias("id"), F.col("t.tokens").alias("token")
    )


def train_counted(df: DataFrame, vocab_size: int, *groups: str) -> tuple[Vocabulary, DataFrame, DataFrame]:
    """A vocabulary learnt from df, the texts (groups, text) it was learnt from, and
    their written word counts, for `text_metrics`: one pass over the corpus cuts
    words for both."""
    texts = bt.training_texts(df, groups=groups)
    # Once per text: beside explode() it would be looked up for every word.
    cut = texts.select(*groups, be.spells_special(F.col("text")).alias("_special"), vb.pretokens(F.col("text")).alias("_cut"))
    words = cut.select(*groups, "_special", F.explode("_cut").alias("word"))
    counts = materialize(words.groupBy(*groups, "_special", "word").agg(F.count(F.lit(1)).alias("n")), "words")
    whole = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    return bt.train_from_counts(whole, vocab_size), texts, counts


def text_metrics(
    df: DataFrame, model: Vocabulary, *groups: str, column: str = "text", counts: DataFrame | None = None
) -> DataFrame:
    """Pooled compression (characters per token) and fertility (tokens per
    word): one encoding and one aggregate for both. Tokens include <s> and </s>.
    counts: of `train_counted`, of the same texts and groups. With them each word
    is encoded once, and as texts only those that spell a special token."""
    encoded = F.col(column) if counts is None else F.when(be.spells_special(F.col(column)), F.col(column))
    sized = df.select(
        *groups,
        F.lit(1).alias("docs"),
        F.length(column).alias("chars"),
        tx.word_count(F.col(column)).alias("words"),
        F.size(be.encode(encoded, model)).cast("long").alias("tokens"),
    )
    if counts is not None:
        plain = counts.filter(~F.col("_special"))
        tokens = (be.token_count(F.col("word"), model) * F.col("n")).alias("tokens")
        none = [F.lit(0).alias(c) for c in ("docs", "chars", "words")]
        sized = sized.unionByName(plain.select(*groups, *none, tokens))
    sums = sized.groupBy(*groups).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "chars", "words", "tokens")],
    )
    return sums.withColumns(
        {
            "compression_ratio": F.col("chars") / F.greatest("tokens", F.lit(1)),
            "fertility": F.col("tokens") / F.greatest("words", F.lit(1)),
        }
    )


def special_tokens(vocab: DataFrame) -> DataFrame:
    """Tokens that start with '<' and end with '>'."""
    return vocab.filter(F.startswith("token", F.lit("<")) & F.endswith("token", F.lit(">")))


def validation_results(df: DataFrame, order: str, model: Vocabulary, s: Settings = Settings()) -> DataFrame:
    """One row: vocabulary size, failed probes, metrics (null without a sample),
    documents sampled."""
    spark = df.sparkSession
    failures = roundtrip(probe_texts(spark), model).filter(~F.col("ok")).count()
    metrics = text_metrics(validation_sample(df, order, s.validation_docs), model)
    some = F.col("docs") > 0
    return metrics.select(
        F.lit(len(model.tokens)).alias("vocab_size"),
        F.lit(failures).alias("roundtrip_failures"),
        F.when(some, F.round("compression_ratio", 3)).alias("compression_ratio"),
        F.when(some, F.round("fertility", 3)).alias("fertility"),
        F.col("docs").cast("int").alias("docs_sampled"),
    )
