"""Text extraction: HTML pages to plain text, plain text to trimmed lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.config import Settings
from textloom.functions import html as hx
from textloom.functions import repair as rp
from textloom.functions import text as tx


def _tidied(text: str) -> str:
    return "\n".join(filter(None, (line.strip(tx.BLANKS) for line in _BREAK.split(text))))


# Other texts are tidy: no blank at an end of a line, no blank line, no line break but \n.
_BLANK = f"[{tx.BLANKS}]"
_BREAK = re.compile(tx.LINE_BREAK)
TIDY = rp.Repair(rf"\A{_BLANK}|{_BLANK}\z|{_BLANK}\n|\n{_BLANK}|[{tx.RARE_BREAKS}]", _tidied)


def tidy_lines(text: Column) -> Column:
    """Trim every line, drop the blank ones, join by newline."""
    return F.coalesce(rp.changes(text, TIDY), text)


def extract_text(df: DataFrame, s: Settings = Settings(), column: str = "text") -> DataFrame:
    """Replace the text by its extraction and drop documents left empty.

    Only pages go through the markup passes: other rows enter them as null.
    """
    t = tx.or_empty(F.col(column))
    paged = df.withColumn("_page", F.when(hx.looks_like_html(t, s.sniff_window), t))
    read = hx.html_to_text(paged, "_page")
    read = read.withColumn("_tidy", tidy_lines(F.when(F.col("_page").isNull(), t)))
    out = F.coalesce("_page", "_tidy")
    # A filter would be pushed down and compute the text twice; exploding an
    # array of one or no text computes it once.
    left = F.explode(F.filter(F.array(out), lambda x: x != "")).alias(column)
    return read.select(*[left if c == column else c for c in df.columns])
