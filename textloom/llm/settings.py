"""Production parameters that the registered queries and the pipeline share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k"

#: Integer weights by level: domain, language, source; groups not named weigh 1.
MIX_WEIGHTS = ({"family0": 4, "family1": 3, "family2": 2}, {"en": 3, "de": 2}, {"src0": 2})


def tokenizer_paths() -> tuple[str, str]:
    """The tokenizer file, and the same vocabulary as ranks."""
    import public_tokenizers

    return public_tokenizers.path(f"{TOKENIZER}.json"), public_tokenizers.path(f"{TOKENIZER}.tiktoken")


def with_domain(documents: DataFrame) -> DataFrame:
    """The top of the mixing tree: sources in four families by their number."""
    number = F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint)"), F.lit(0))
    return documents.withColumn("domain", F.concat(F.lit("family"), (number % 4).cast("string")))
