"""The narrow stages over shards as they arrive.

The same operators, unchanged, on a file stream: each run takes the shards that
no earlier run has taken, and a run that was cut off resumes from its log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from textloom.config import Settings
from textloom.operators import language
from textloom.plans.stages import clean
from textloom.sources.shards import DOCUMENT


def tag_new_shards(
    spark: SparkSession,
    shards: str,
    out: str,
    log: str,
    model: DataFrame,
    s: Settings = Settings(),
    shards_per_batch: int = 1_000,
    shard_grams: int = language.SHARD_GRAMS,
) -> StreamingQuery:
    """Filter, extract, repair and tag the new shards, appending to `out`.

    With a language model of more than shard_grams grams, which no task holds
    whole, each batch of shards is a table of its own, `batch=<number>` in `out`;
    a batch that is run again replaces it.
    """
    arriving = spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", shards_per_batch).json(shards)
    ready = language.packed(model)
    if ready.grams <= shard_grams:
        tagged = language.tag_documents(clean(arriving, s), ready, s, shard_grams)
        writer = tagged.writeStream.format("parquet").option("path", out)
    else:

        def tag(docs: DataFrame, number: int) -> None:
            tagged = language.tag_documents(clean(docs, s), ready, s, shard_grams)
            tagged.write.mode("overwrite").parquet(f"{out}/batch={number}")

        writer = arriving.writeStream.foreachBatch(tag)
    return writer.option("checkpointLocation", log).trigger(availableNow=True).start()
