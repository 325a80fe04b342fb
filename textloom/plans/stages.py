"""The stages composed, in their fixed order.

Filtering, extraction, repair and tagging are narrow: together they are one
pass. Removing near-duplicates and rebalancing read their input more than once,
so it is written before each of them: to `save_dir` if the stages are to be
kept, else to the shared scratch folder. Kept stages are taken up again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from textloom.config import Settings
from textloom.operators import bpe_train as bt
from textloom.operators import dedup, encoding, extract, filters, language, rebalance
from textloom.operators import validate as vl
from textloom.operators.counters import Counters
from textloom.plans.saved import Stages, content_key, digest


#: The settings that each stage looks at.
USES = {
    "filtered": ("min_chars", "max_chars", "max_html_ratio", "min_avg_line_len", "binary_window"),
    "extracted": ("sniff_window",),
    "recovered": (),
    "tagged": ("min_lang_confidence", "lang_window", "domain_window"),
    "unique": ("minhash_threshold", "minhash_perms", "shingle_size"),
    "balanced": ("max_lang_fraction", "target_docs", "random_seed", "shard_size"),
}


def clean(docs: DataFrame, s: Settings = Settings(), run: Stages | None = None) -> DataFrame:
    """Filter, extract, repair."""
    run = run or Stages(docs, s)
    kept = run.step("filtered", USES["filtered"], lambda: filters.content_filter(docs, s))
    text = run.step("extracted", USES["extracted"], lambda: extract.extract_text(kept, s))
    return run.step("recovered", USES["recovered"], lambda: encoding.recover_encoding(text))


def prepare(
    docs: DataFrame,
    model: DataFrame,
    s: Settings = Settings(),
    order: str = "ord",
    save_dir: str | None = None,
    input_id: str | None = None,
    counters: Counters | None = None,
) -> DataFrame:
    """Documents (order, id, text, ...) to the balanced corpus, with `position`
    and `shard`. `model` is a fitted language model.

    With `save_dir` every stage is kept there, and a run takes up from the
    stages that an earlier one finished with the same input, model and settings.
    The input is told by its content, in a pass of its own, or by `input_id`, a
    name that the caller changes with it. `counters` get the documents of the
    input and of every stage from the jobs that write the stages.
    """
    key = models = ""
    if save_dir:
        key, models = input_id or content_key(docs), content_key(model)
    run = Stages(docs, s, save_dir, digest(key, order), counters)
    cleaned = clean(run.docs, s, run)
    tagged = run.step("tagged", USES["tagged"], lambda: language.tag_documents(cleaned, model, s), True, models)
    unique = run.step("unique", USES["unique"], lambda: dedup.deduplicate(tagged, order, s), True)
    return run.step("balanced", USES["balanced"], lambda: rebalance.rebalance(unique, s), counters is not None)


@dataclass
class Trained:
    vocabulary: bt.Vocabulary
    stats: DataFrame
    validation: DataFrame


def learn(balanced: DataFrame, s: Settings = Settings(), order: str = "position", path: str | None = None) -> Trained:
    """Train on a corpus, validate on its first documents, save to `path`."""
    spark = balanced.sparkSession
    vocabulary = bt.train(balanced, s.vocab_size, s.min_frequency)
    if path:
        vocabulary.save(spark, path)
    stats = bt.training_stats(spark, vocabulary, s.vocab_size, s.min_frequency, s.run_id)
    return Trained(vocabulary, stats, vl.validation_results(balanced, order, vocabulary, s))
