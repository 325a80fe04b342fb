"""All registered queries: name -> (Spark query, SQL or None)."""

from __future__ import annotations

from textloom.catalog import chain, dedup, encoding, extract, filters, ingest, language, rebalance, vocabulary
from textloom.catalog.common import Query

MODULES = (ingest, filters, extract, encoding, language, dedup, rebalance, vocabulary, chain)


def all_queries() -> dict[str, tuple[Query, str | None]]:
    return {name: pair for module in MODULES for name, pair in module.QUERIES.items()}
