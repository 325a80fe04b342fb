"""Content predicates and the content filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import Settings
from textloom.functions import text as tx

# Fixed patterns: characters that mark binary data, and what counts as a tag.
CONTROL = r"[\x00-\x08\x0e-\x1f\x7f-\x9f]"
TAG = r"<[^>]{1,100}>"


def looks_binary(text: Column, window: int | None = None) -> Column:
    return tx.head(text, window).rlike(CONTROL)


def tag_heavy(text: Column, max_ratio: float = 0.1) -> Column:
    """More than max_ratio tags per word; a text without words is never heavy.
    A text without '<' has no tag, and its words are not counted."""
    n_tags = F.regexp_count(text, F.lit(TAG))
    heavy = tx.bind(tx.word_count(text), lambda n: F.when(n > 0, n_tags / n > max_ratio).otherwise(False))
    return heavy if max_ratio < 0 else F.when(F.contains(text, F.lit("<")), heavy).otherwise(False)


def length_ok(text: Column, low: int = 100, high: int = 1_000_000) -> Column:
    return F.length(text).between(low, high)


def has_content_line(text: Column) -> Column:
    return F.size(tx.nonblank_lines(text)) > 0


def mean_line_length(text: Column) -> Column:
    """Mean length of the non-blank lines, untrimmed; null without any."""
    return tx.bind(
        tx.nonblank_lines(text),
        lambda kept: F.when(F.size(kept) > 0, F.length(F.array_join(kept, "")) / F.size(kept)),
    )


def lines_long_enough(text: Column, minimum: int = 20) -> Column:
    return F.coalesce(mean_line_length(text) >= minimum, F.lit(False))


def line_verdicts(text: Column, minimum: int = 20) -> Column:
    """has_content_line, mean_line_length and lines_long_enough in one struct,
    with the text cut into lines once. Null for a null text."""
    return F.when(
        text.isNotNull(),
        tx.bind(
            mean_line_length(text),
            lambda mean: F.struct(
                mean.isNotNull().alias("has_line"),
                mean.alias("mean_length"),
                F.coalesce(mean >= minimum, F.lit(False)).alias("long_enough"),
            ),
        ),
    )


def reject_reason(text: Column, s: Settings = Settings()) -> Column:
    """Name of the first rule a text breaks, null when it is kept."""
    t = tx.or_empty(text)
    by_lines = tx.bind(
        mean_line_length(t),
        lambda mean: F.when(mean.isNull(), "blank").when(mean < s.min_avg_line_len, "short_lines"),
    )
    return (
        F.when(looks_binary(t, s.binary_window), "binary")
        .when(tag_heavy(t, s.max_html_ratio), "html")
        .when(~length_ok(t, s.min_chars, s.max_chars), "length")
        .otherwise(by_lines)
    )


def content_filter(df: DataFrame, s: Settings = Settings(), column: str = "text") -> DataFrame:
    """Keep the documents that break no rule. Narrow: one pass, no shuffle.

    The conjuncts run cheapest first, so most rejects never reach the regexes.
    """
    t = tx.or_empty(F.col(column))
    return df.filter(
        length_ok(t, s.min_chars, s.max_chars)
        & ~looks_binary(t, s.binary_window)
        & lines_long_enough(t, s.min_avg_line_len)
        & ~tag_heavy(t, s.max_html_ratio)
    )
