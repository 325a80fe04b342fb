"""Text primitives as Columns: whitespace, words, lines, code-point windows.

Every operator shares the one definition of whitespace and of a line break, so
that counting, trimming and splitting can not drift apart.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace (all separators, the ASCII blanks and the
# control characters 1C-1F and 85), what is not whitespace, and what ends a
# line. Java's own \s is ASCII-only. The printable ASCII range comes first in
# NON_WS because almost every character is decided by it.
WS = r"\s\x1c-\x1f\x85\p{Z}"
NON_WS = rf"[!-~[^{WS}]]"
LINE_BREAK = r"\r\n|[\n-\r\x1c-\x1e\x85\u2028\u2029]"
# The same as characters: whitespace, and what ends a line besides \n.
BLANKS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]))
BLANKS += "\u2028\u2029\u202f\u205f\u3000"
RARE_BREAKS = "\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, however often it is used.
    Spark repeats an expression per use inside conditional branches."""
    return F.transform(F.array(value), use)[0]


def head(text: Column, window: int | None) -> Column:
    """The first `window` code points; the whole text for None."""
    return text if window is None else F.substring(text, 1, window)


def strip(text: Column) -> Column:
    """Only the ends are looked at, not every character."""
    return F.btrim(text, F.lit(BLANKS))


def collapse(text: Column) -> Column:
    """Every whitespace run becomes one space, none at the ends."""
    return strip(F.regexp_replace(text, rf"[{WS}]+", " "))


def is_blank(text: Column) -> Column:
    return ~text.rlike(NON_WS)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({NON_WS}+)"), F.lit(1))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{NON_WS}+"))


def lines(text: Column) -> Column:
    """Searches for the rare line breaks and cutting at one character take far
    less time than a pattern tried at every character."""
    rare = reduce(or_, [F.contains(text, F.lit(c)) for c in RARE_BREAKS])
    return F.split(F.when(rare, F.regexp_replace(text, LINE_BREAK, "\n")).otherwise(text), "\n", -1)


def nonblank_lines(text: Column) -> Column:
    return F.filter(lines(text), lambda line: ~is_blank(line))


def chars(text: Column) -> Column:
    """Code points as an array; empty for an empty text."""
    return F.filter(F.split(text, ""), lambda c: c != "")
