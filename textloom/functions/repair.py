"""Repairs for damaged text, one Column function per kind of damage.

Each repair is a function of a string behind a guard, the pattern of what it
repairs. Guards are looked up in whole Arrow batches, slice by slice, and only
texts that match one are repaired.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# What Windows-1252 shows for the bytes 80-9F. The five bytes it
# leaves undefined stand for the control character of the same number.
CP1252 = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))
C1 = "".join(chr(b) for b in range(0x80, 0xA0))

# Letters drawn as one glyph, and the letters they stand for.
LIGATURES = {
    "Ĳ": "IJ",
    "ĳ": "ij",
    "ŉ": "ʼn",
    "Ǆ": "DŽ",
    "ǅ": "Dž",
    "ǆ": "dž",
    "Ǉ": "LJ",
    "ǈ": "Lj",
    "ǉ": "lj",
    "Ǌ": "NJ",
    "ǋ": "Nj",
    "ǌ": "nj",
    "Ǳ": "DZ",
    "ǲ": "Dz",
    "ǳ": "dz",
    "ﬀ": "ff",
    "ﬁ": "fi",
    "ﬂ": "fl",
    "ﬃ": "ffi",
    "ﬄ": "ffl",
    "ﬅ": "ſt",
    "ﬆ": "st",
}
# Quote marks drawn curly, by the straight mark they stand for.
SINGLE_QUOTES = "\u02bc\u2018\u2019\u201a\u201b"
DOUBLE_QUOTES = "\u201c\u201d\u201e\u201f"

# Fixed patterns.
NEWLINES = r"\r\n|[\r\u2028\u2029\x85]"
TERMINAL = r"\x1b\[[0-9;]*[a-zA-Z]"
UNWANTED = r"[\x00-\x08\x0b\x0e-\x1f\x7f\u206a-\u206f\ufeff\ufff9-\ufffc]"
UTF8_PAIR = r"[\xc2-\xf4][\x80-\xbf]"
SUSPECT = rf"[\x80-\x9f]|[\xc2-\xf4][\xa0-\xbf{CP1252}]"


# What the commonest two- and three-byte characters look like after a wrong
# decoding: the marks of C2, C3 and E2, and the bytes that may follow them.
FOLLOWING = rf"[\x80-\xbf{CP1252}]"
DAMAGED_RUN = rf"(?:[\xc2\xc3]{FOLLOWING}|\xe2{FOLLOWING}{{2}})+"

SLICE_BYTES = 1 << 20  # texts repaired together
_RUN = re.compile(DAMAGED_RUN)
_NEWLINES = re.compile(NEWLINES)
_TERMINAL = re.compile(TERMINAL)
_UNWANTED = re.compile(UNWANTED)
_TO_C1 = str.maketrans(CP1252, C1)
_TO_CP1252 = str.maketrans(C1, CP1252)


@lru_cache
def width_table() -> dict[str, str]:
    """Characters whose Unicode width class is full or half, with their
    compatibility form where it is another character."""
    classed = [c for c in map(chr, range(0x10000)) if unicodedata.east_asian_width(c) in ("F", "H")]
    forms = {c: unicodedata.normalize("NFKC", c) for c in classed}
    return {c: form for c, form in forms.items() if form != c}


def _decoded(shown: str) -> str | None:
    """The text whose UTF-8 bytes are shown, None if a character stands for no
    byte or they are not valid."""
    try:
        raw = shown.encode("latin-1")
    except UnicodeEncodeError:
        try:
            raw = shown.translate(_TO_C1).encode("latin-1")
        except UnicodeEncodeError:
            return None
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


def _repair_line(line: str) -> str:
    """Bytes that were UTF-8 but were read as Latin-1 or Windows-1252.

    A line goes back to bytes as a whole if every character has one and they
    are valid UTF-8. A line that also holds good accents or other characters is
    repaired run by run; what is no valid run stays. A line in plain Latin-1
    keeps its text, except that C1 controls become what Windows-1252 shows for
    them.
    """
    if line.isascii():
        return line
    whole = _decoded(line)
    if whole is not None:
        return whole
    return _RUN.sub(lambda run: _or_same(_decoded(run[0]), run[0]), line).translate(_TO_CP1252)


def _or_same(fixed: str | None, text: str) -> str:
    return text if fixed is None else fixed


def _mojibake(text: str) -> str:
    """One wrong decoding undone, line by line. Lines that are all valid are
    valid together."""
    whole = _decoded(text)
    return "\n".join(map(_repair_line, text.split("\n"))) if whole is None else whole


def _references(text: str) -> str:
    first = text.find("<")
    until = len(text) if first < 0 else text.rfind("\n", 0, first) + 1
    return html.unescape(text[:until]) + text[until:]


def _swapped(text: str, table: dict[str, str]) -> str:
    for shown, meant in table.items():
        text = text.replace(shown, meant)
    return text


@lru_cache
def _width() -> dict[int, str]:
    return str.maketrans(width_table())


@dataclass(frozen=True)
class Repair:
    guard: str  # what a text has to hold
    fix: Callable[[str], str]

    @property
    def pattern(self) -> str:
        """The guard in the notation of Arrow's regular expressions."""
        return re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", self.guard)


QUOTES = dict.fromkeys(SINGLE_QUOTES, "'") | dict.fromkeys(DOUBLE_QUOTES, '"')

REFERENCES = Repair("&", _references)
MOJIBAKE = Repair(SUSPECT, _mojibake)
LIGATED = Repair(f"[{''.join(LIGATURES)}]", lambda text: _swapped(text, LIGATURES))
WIDTH = Repair("[　！-￯]", lambda text: text.translate(_width()))
QUOTED = Repair(f"[{''.join(QUOTES)}]", lambda text: _swapped(text, QUOTES))
BROKEN = Repair(r"[\r\u2028\u2029\x85]", lambda text: _NEWLINES.sub("\n", text))
CONTROLS = Repair(UNWANTED, lambda text: _UNWANTED.sub("", _TERMINAL.sub("", text)))
# Nothing below U+0300 can change by composition.
APART = Repair(r"[^\x00-\u02ff]", lambda text: unicodedata.normalize("NFC", text))


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The same texts, at most about SLICE_BYTES together; a longer one alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield texts.slice(a, b - a)


def _matching(texts: pa.Array, pattern: str) -> pa.Array:
    return pc.fill_null(pc.match_substring_regex(texts, pattern), False)


def _repaired(texts: pa.Array, repairs: tuple[Repair, ...]) -> pa.Array:
    """The texts that change, others null."""
    some = _matching(texts, "|".join({r.pattern: None for r in repairs}))
    before = after = texts.filter(some)
    for repair in repairs:
        hit = _matching(after, repair.pattern)
        if pc.any(hit).as_py():
            damaged = after.filter(hit).cast(pa.large_binary()).to_pylist()
            fixed = [repair.fix(t.decode("utf-8", "replace")) for t in damaged]
            after = pc.replace_with_mask(after, hit, pa.array(fixed, pa.large_string()))
    changed = pc.if_else(pc.not_equal(before, after), after, pa.scalar(None, pa.large_string()))
    return pc.replace_with_mask(pa.nulls(len(texts), pa.large_string()), some, changed)


def changes(text: Column, *repairs: Repair) -> Column:
    """The text after the repairs, in their order; null where nothing changes."""

    @F.arrow_udf("string")
    def repaired(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for part in _slices(texts.cast(pa.large_string())):
                yield _repaired(part, repairs).cast(pa.string())

    # Marked so that filters are not pushed below it and run it twice.
    return repaired.asNondeterministic()(text)


def _after(text: Column, *repairs: Repair) -> Column:
    return F.coalesce(changes(text, *repairs), text)


def repair_mojibake(text: Column) -> Column:
    """Undo one wrong decoding, line by line. Texts without the character pairs
    it leaves behind are passed on."""
    return _after(text, MOJIBAKE)


def unescape_plain(text: Column) -> Column:
    """Character references, up to the line that holds the first '<'."""
    return _after(text, REFERENCES)


def split_ligatures(text: Column) -> Column:
    return _after(text, LIGATED)


def normal_width(text: Column) -> Column:
    return _after(text, WIDTH)


def straight_quotes(text: Column) -> Column:
    return _after(text, QUOTED)


def plain_newlines(text: Column) -> Column:
    return _after(text, BROKEN)


def drop_controls(text: Column) -> Column:
    return _after(text, CONTROLS)


def compose(text: Column) -> Column:
    """Canonical composition."""
    return _after(text, APART)
