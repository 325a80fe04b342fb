"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns what it keeps with the
columns of `documents`; the last one returns the packed pieces. Stages are
written as Parquet and read again in between. Operators see a document's id,
text, language and source, and the whole row as one struct, so that no column,
whatever its name, meets a name of theirs.

1. toxicity: documents that are more likely toxic than not go.
2. near duplicates: of every class on word shingles one document stays.
3. repeats: passages of over 50 words that also stand elsewhere are cut, found
   as the shortest such passage is long: REPEAT_BYTES bytes.
4. mixing: a share of all tokens, by target weights of the source tree, each
   document at most once.
5. packing: windows of 2,048 tokens in the proportions of the sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import mixing, ngram_join, packing, suffix, toxicity
from textloom.llm.common import written
from textloom.llm.settings import MIX_WEIGHTS, tokenizer_paths, with_domain


#: Fewest bytes of 51 words: four languages' prose has 4.8 bytes a word and more, blanks included.
REPEAT_BYTES = 240

SEEN = ("doc_id", "text", "lang", "source")


def carried(docs: DataFrame) -> DataFrame:
    """What operators look at, and the whole row as one struct."""
    return docs.select(*[c for c in SEEN if c in docs.columns], F.struct("*").alias("_document"))


def columns_of(docs: DataFrame, changed: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of docs; with a new text also its length, where docs has one."""
    own = {c: F.col(f"_document.`{c}`") for c in docs.columns}
    if text:
        own["text"] = F.col(text)
        if "n_chars" in own:
            own["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return changed.select(*[value.alias(c) for c, value in own.items()])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(carried(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return columns_of(docs, toxicity.score(carried(docs), model).filter(~toxicity.rejected()))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return columns_of(docs, ngram_join.keep_one(carried(docs)))


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return columns_of(docs, suffix.deduplicate(carried(docs), REPEAT_BYTES, texts=True), "kept_text")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(with_domain(carried(docs)), share=(3, 4), epochs=1, weights=MIX_WEIGHTS)
    return columns_of(docs, mixed, "mixed_text")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(carried(docs), *tokenizer_paths())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Training, MinHash and tokenising have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
