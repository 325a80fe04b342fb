"""HTML to text with built-in expressions.

Comments, scripts and styles go first, in one leftmost-first pass, because a
script may hold tags and comment marks inside strings. Then one walk over the
tags with a stack of open elements finds what lies inside page furniture, at any
depth: an element ends with its own end tag, or with that of an element around
it if it was never closed. The walk takes time in proportion to the page.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as tx

# What makes a text count as HTML, and which elements are dropped.
SIGNALS = ("<html", "<body", "<div", "<p>", "<span", "<table")
RAW_ELEMENTS = ("script", "style")
FURNITURE = ("nav", "footer", "header", "aside")
#: Elements without an end tag, and those that their next sibling ends.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
IMPLIED = ("p", "li", "dt", "dd", "tr", "td", "th", "option", "thead", "tbody", "tfoot")

_OPEN_END = r"(?=[\s/>])[^>]*(?<!/)>"
_CLOSE_END = r"(?=[\s/>])[^>]*>"
_RAW = "|".join(RAW_ELEMENTS)
RAW_PASS = rf"(?is)<!--.*?(?:-->|\z)|<({_RAW}){_OPEN_END}.*?(?:</\1{_CLOSE_END}|\z)"
# A tag and what follows it, up to the next one; the name of a tag.
_PIECE = re.compile("</?[a-zA-Z]")
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)", re.ASCII)
# A '>' inside a quoted attribute value does not end the tag.
TAG_PASS = (
    r"""(?s)</?[a-zA-Z](?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>"""
    r"""|<[!?][^>]*>|</[^a-zA-Z>][^>]*>"""
)
_TAG = re.compile(TAG_PASS, re.ASCII)


def looks_like_html(text: Column, window: int | None = None) -> Column:
    sample = F.lower(tx.head(text, window))
    found = F.lit(False)
    for signal in SIGNALS:
        found = found | F.contains(sample, F.lit(signal))
    # Every signal has a '<': other texts are not lower-cased.
    return F.contains(tx.head(text, window), F.lit("<")) & found


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


# Python steps are marked so that filters are not pushed below them, which
# would run them a second time.
unescape = _unescape.asNondeterministic()


def unescape_entities(text: Column) -> Column:
    """Named and numeric character references to characters.

    The name table has over two thousand entries and numeric references need a
    function per match, so this is a Python step. Texts without an ampersand go
    in as null and cost nothing.
    """
    return F.coalesce(unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def furniture_spans(page: str) -> list[tuple[int, int]]:
    """Ranges of characters inside furniture, in order; time goes with the
    page's length. `places` has, per name, where in the stack of open elements
    it stands, so that an end tag finds its element without a search, and each
    element leaves the stack once."""
    stack: list[str] = []
    places: dict[str, list[int]] = {}
    spans = []
    depth, since = -1, 0  # of the outermost open furniture
    at = _PIECE.search(page)
    while at:
        begin = at.start()
        after = _PIECE.search(page, at.end())
        end = after.start() if after else len(page)
        at = after
        name = _NAME.match(page, begin, end)[1].lower()
        if name in VOID:
            continue
        if page[begin + 1] == "/":
            left = places.get(name)
            if not left:
                continue
            keep = left[-1]
            while len(stack) > keep:
                places[stack.pop()].pop()
            if depth >= keep:
                spans.append((since, begin))
                depth = -1
            continue
        furniture = name in FURNITURE
        if furniture:
            close = page.find(">", begin, end)
            if close > 0 and page[close - 1] == "/":
                continue
            if depth < 0:
                depth, since = len(stack), begin
        if name in IMPLIED and stack and stack[-1] == name:
            continue
        places.setdefault(name, []).append(len(stack))
        stack.append(name)
    return [*spans, (since, len(page))] if depth >= 0 else spans


def without_furniture(page: str) -> str:
    """The page without furniture elements, each replaced by a blank."""
    shown, last = [], 0
    for since, until in furniture_spans(page):
        shown.append(page[last:since])
        last = until
    return " ".join([*shown, page[last:]])


def _visible(page: str) -> str:
    """A page with furniture to text: furniture, tags, references."""
    shown = without_furniture(page)
    last = shown.rfind(">") + 1
    return html.unescape(_TAG.sub(" ", shown[:last]) + shown[last:])


@F.pandas_udf(T.StringType())
def _read(pages: pd.Series, furnished: pd.Series) -> pd.Series:
    pairs = zip(pages, furnished, strict=True)
    return pd.Series([None if p is None else _visible(p) if f else html.unescape(p) for p, f in pairs], dtype=object)


read = _read.asNondeterministic()


def drop_tags(text: Column) -> Column:
    """Every tag to a blank. No tag ends behind the last '>', so what is left of
    the text there is not searched again from every '<' in it."""
    rest = F.substring_index(text, ">", -1)
    tagged = F.left(text, F.length(text) - F.length(rest))
    return F.concat(F.regexp_replace(tagged, TAG_PASS, " "), rest)


def html_to_text(df: DataFrame, column: str) -> DataFrame:
    """Replace an HTML column by its text. One projection per step, so that no
    step is computed once per use of its result.

    Pages with furniture, and those with references, take one Python step over
    Arrow batches; others go in as null. Furniture needs a stack of open
    elements, which a fold over an array copies at every tag.
    """
    page, own = F.col(column), F.col("_own")
    some = F.rlike(page, F.lit(rf"(?i)<(?:{'|'.join(FURNITURE)})[\s/>]"))
    return (
        df.withColumn(column, F.regexp_replace(page, RAW_PASS, " "))
        .withColumn("_furnished", F.coalesce(some, F.lit(False)))
        .withColumn(column, F.when(F.col("_furnished"), page).otherwise(drop_tags(page)))
        .withColumn("_own", F.when(F.col("_furnished") | F.contains(page, F.lit("&")), page))
        .withColumn("_own", read(own, F.col("_furnished")))
        .withColumn(column, tx.collapse(F.coalesce(own, page)))
        .drop("_own", "_furnished")
    )
