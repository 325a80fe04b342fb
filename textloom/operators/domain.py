"""Domain tags from hint words; the first domain in the fixed order wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as tx

# Hint words per domain. The order of the domains matters.
HINTS = {
    "code": ("def ", "function ", "import ", "class ", "```", "github.com", "stackoverflow"),
    "math": ("theorem", "proof", "equation", "∑", "∫", "arxiv.org"),
    "legal": ("whereas", "pursuant", "hereinafter", "jurisdiction"),
    "medical": ("patient", "diagnosis", "treatment", "clinical"),
    "news": ("reported", "according to", "press release", "breaking news"),
}
DEFAULT = "web"


def domain_of(text: Column, window: int | None = None) -> Column:
    sample = F.lower(tx.head(tx.or_empty(text), window))
    tag = F.lit(DEFAULT)
    for domain, hints in reversed(HINTS.items()):
        hit = F.lit(False)
        for hint in hints:
            hit = hit | F.contains(sample, F.lit(hint))
        tag = F.when(hit, F.lit(domain)).otherwise(tag)
    return tag
