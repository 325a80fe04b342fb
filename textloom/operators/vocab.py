"""Shared pieces of byte-level subword vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The special tokens, whose ids are their places here.
SPECIALS = ("<unk>", "<s>", "</s>", "<pad>", "<mask>")
UNK, BOS, EOS = 0, 1, 2

# Fixed pattern: how text is cut into words before any byte is merged. Blanks
# are the Unicode ones.
_BLANK = r"\s\x85\p{Z}"
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_BLANK}\p{{L}}\p{{N}}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)


def pretokens(text: Column) -> Column:
    """The words of a text, in order; together they are the whole text."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def visible_bytes() -> list[str]:
    """The printable character that stands for each byte value.

    The rule: printable Latin-1 characters stand for themselves, and the other
    bytes take the code points from U+0100 on, in order.
    """
    table, spare = [], 0x100
    for byte in range(256):
        if 0x21 <= byte <= 0x7E or 0xA1 <= byte <= 0xAC or byte >= 0xAE:
            table.append(chr(byte))
        else:
            table.append(chr(spare))
            spare += 1
    return table


def byte_ids(seen: set[int]) -> dict[int, int]:
    """Ids of single bytes: after the specials, ordered by visible character."""
    shown = visible_bytes()
    ordered = sorted(seen, key=lambda byte: shown[byte])
    return {byte: len(SPECIALS) + place for place, byte in enumerate(ordered)}
