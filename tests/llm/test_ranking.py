import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from textloom.llm import queries, ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(items, docs, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    length = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scored = []
        for doc, c in counts:
            n = sum(c.values())
            score = 0
            for t, times in asked.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * c[t] // (1000 * c[t] + 8 * (100 - 75 + 75 * n * n_docs // length)))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_plain_scores(spark, sf):
    path = f"/root/testdata/sf{sf}"
    items = [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(queries.op13_reversed_search(spark, path)) == plain(items, docs)


ITEMS = [(1, "word1 word8 WORD8 Größe"), (2, None), (3, ""), (4, "nowhere"), (4, "two words x"), (5, "two two two"), (None, "words")]


def test_odd_rows_ties_and_blocks(spark):
    extra = [(i, "Größe größe GRÖSSE one", "de", "z", 1) for i in (30, 12, 12, 25)] + [(i, "two", "en", "z", 1) for i in range(40, 60)]
    docs = odd.documents(spark, odd.ROWS + extra)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("n", F.lit(1))
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain(ITEMS, given)
    assert rows(ranking.search(items, docs.repartition(9))) == want
    assert rows(ranking.search(items, docs.repartition(3), index_most=2)) == want  # a pass per block of items


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranking.search(items, odd.empty(spark)).count() == 0
    assert ranking.search(items.filter("false"), odd.documents(spark)).count() == 0


def test_terms_at_the_edges():
    texts = pa.array(["aB", "c", None, "", "-x9é-", "é"])
    raw, start, end, doc = ranking.terms(texts)
    assert [(bytes(raw[a:b]).decode(), int(d)) for a, b, d in zip(start, end, doc)] == [("ab", 0), ("c", 1), ("x9é", 4), ("é", 5)]


def test_terms_of_one_hash_are_told_apart():
    known = ranking.Vocabulary([b"aa", b"bb", b"cc"])
    known.hashes[:] = known.hashes[0]  # all clash
    raw = np.frombuffer(b"bb cc dd", np.uint8)
    original = ranking.hashed
    try:
        ranking.hashed = lambda raw, start, end: np.full(len(start), known.hashes[0])
        span, place = known.places(raw, np.array([0, 3, 6]), np.array([2, 5, 8]))
    finally:
        ranking.hashed = original
    assert dict(zip(span.tolist(), place.tolist())) == {0: 1, 1: 2}
