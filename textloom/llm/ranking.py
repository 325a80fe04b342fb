"""Ranked lexical search the other way round: the items wait, documents stream by.

The items' terms make a small inverted index (term -> items that hold it, and
how often). Tasks count each document's terms once and keep those that some
item has; sums over them give the corpus numbers. Then every document's counts
stream through the index, and each item keeps a heap of its `k` best documents
in the task. Only the heaps leave a task: they are merged in two rounds, first
among about the square root of all tasks, so neither round grows with them.

Terms are runs of ASCII letters and digits and of all other characters beyond
ASCII, with A to Z in lower case. With N documents that hold a term at all, L
their terms, n a document's terms, tf and df as usual:

    w = floor(1000 ln((2 N + 2) / (2 df + 1))),  m = 25 + 75 n N div L,
    score = sum over an item's terms, repeats included, of
            w * (10^9 tf div (1000 tf + 8 m))

in integers but for the logarithm. Sums are split into two halves below 2^53
each, so adding them up as doubles is exact.

The index is made and broadcast in blocks of at most about INDEX_MOST (term,
item) entries, by a hash of the item: more items mean more passes over the
documents, never a larger broadcast. (A single item is not parted.)

Defined cases: null and empty texts hold no term; items without a term, or
whose terms no document has, get no rows; rows that repeat an item id are
ranked each on their own, rows that repeat a document id are documents of their
own; equal scores go by id, null ids last; words of any length and texts of any
length are counted whole; an empty table gives no rows; only ids and texts are
looked at, whatever other columns are called.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import forget, prefix_hash, sliced, span_hash, utf8, written

K = 10
INDEX_MOST = 1_000_000
HALF = 26  # bits of the lower part of a summand
BATCH_CELLS = 1 << 21  # (document, item) scores held at once

TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case bytes, start, end, text) of every term."""
    raw, bounds = utf8(texts)
    raw = LOWER[raw]
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = TERM[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = bounds[1:-1][bounds[1:-1] < len(raw)]
    first[edges] = inside[edges]
    start = np.flatnonzero(first[:-1])
    last = inside[:-1] & (~inside[1:] | first[1:])
    end = np.flatnonzero(last) + 1
    return raw, start, end, np.searchsorted(bounds, start, "right") - 1


def gathered(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The spans as a binary column."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = raw[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )


def hashed(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(raw), start, end)


def item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, item_id, text) to (item, item_id, term), a row per occurrence."""
    for batch in sliced(batches, "text", 4 << 20):
        raw, start, end, doc = terms(batch.column("text"))
        columns = [batch.column(c).take(pa.array(doc)) for c in ("item", "item_id")]
        yield pa.RecordBatch.from_arrays([*columns, gathered(raw, start, end).cast(pa.binary())], ["item", "item_id", "term"])


class Vocabulary:
    """The index's terms; tells the places of those that occur in a text, exactly."""

    def __init__(self, words: list[bytes]) -> None:
        self.words = pa.array(words, pa.large_binary())
        raw = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
        starts = ends - np.array([len(w) for w in words], np.int64)
        hashes = hashed(raw, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def places(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(span, place of its term) of the spans that are terms of the index."""
        if not len(self.hashes) or not len(start):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = hashed(raw, start, end)
        at = np.searchsorted(self.hashes, hashes)
        spans, found = np.arange(len(start)), []
        # Terms of one hash stand together: nearly always a single round.
        while len(spans):
            inside = at < len(self.hashes)
            spans, at = spans[inside], at[inside]
            same = self.hashes[at] == hashes[spans]
            spans, at = spans[same], at[same]
            place = self.order[at]
            if not len(spans):
                break
            equal = pc.equal(gathered(raw, start[spans], end[spans]), self.words.take(pa.array(place)))
            equal = equal.to_numpy(zero_copy_only=False)
            found.append((spans[equal], place[equal]))
            spans, at = spans[~equal], at[~equal] + 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


COUNTS = "doc_id long, n long, terms array<int>, times array<int>"


def count_terms(vocabulary) -> Callable:
    """(doc_id, text) to COUNTS: a document's terms, and those of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(vocabulary.value)
        for batch in sliced(batches, "text", 4 << 20):
            raw, start, end, doc = terms(batch.column("text"))
            n = np.bincount(doc, minlength=batch.num_rows)
            span, place = known.places(raw, start, end)
            key = doc[span] * len(known.hashes) + place
            key, times = np.unique(key, return_counts=True)
            owner, place = np.divmod(key, max(len(known.hashes), 1))
            bounds = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (place, times)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), *lists], ["doc_id", "n", "terms", "times"])

    return run


HEAPS = "item int, doc_id long, score long"


def stream(index, items: int, documents: int, length: int, k: int) -> Callable:
    """COUNTS to HEAPS, the k best documents of every item in this task.

    index: (weights by term, bounds by term, items, times in the item)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bounds, holders, repeats = index.value
        heap = Heaps(items, k)
        rows = max(1, BATCH_CELLS // max(items, 1))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                each = part.column("terms")
                sizes = np.diff(each.offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), sizes)
                term = each.flatten().to_numpy()
                tf = part.column("times").flatten().to_numpy().astype(np.int64)
                n, which = np.unique(part.column("n").to_numpy(), return_inverse=True)
                m = np.array([25 + 75 * x * documents // length for x in n.tolist()], np.int64)[which]
                value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                # One (document, item) entry for every item that holds the term.
                span = bounds[term + 1] - bounds[term]
                total = np.cumsum(span)
                cuts = np.searchsorted(total, np.arange(0, int(total[-1]) if len(total) else 0, 1 << 22))
                low = np.zeros(part.num_rows * items)
                high = np.zeros(part.num_rows * items)
                for a, b in zip(cuts, [*cuts[1:], len(span)], strict=True):
                    s = span[a:b]
                    where = np.repeat(bounds[term[a:b]] - (np.cumsum(s) - s), s) + np.arange(int(s.sum()))
                    cell = np.repeat(doc[a:b], s) * items + holders[where]
                    much = np.repeat(value[a:b], s) * repeats[where]
                    low += np.bincount(cell, much & ((1 << HALF) - 1), len(low))
                    high += np.bincount(cell, much >> HALF, len(low))
                score = (high.astype(np.int64) << HALF) + low.astype(np.int64)
                heap.offer(part.column("doc_id"), score.reshape(part.num_rows, items))
        yield from heap.rows()

    return run


class Heaps:
    """The k best (score, document) of every item, ties to the smaller id."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.floor = k, np.zeros(items, np.int64)
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)

    def offer(self, ids: pa.Array, score: np.ndarray) -> None:
        row, item = np.nonzero((score > 0) & (score >= self.floor))
        if not len(row):
            return
        null = ids.is_null().to_numpy(zero_copy_only=False)
        doc = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        self.item = np.concatenate([self.item, item])
        self.score = np.concatenate([self.score, score[row, item]])
        self.doc = np.concatenate([self.doc, doc[row]])
        self.null = np.concatenate([self.null, null[row]])
        order = np.lexsort((self.doc, self.null, -self.score, self.item))
        sorted_items = self.item[order]
        rank = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items)
        self.floor[sorted_items[rank == self.k - 1]] = self.score[order][rank == self.k - 1]
        order = order[rank < self.k]
        self.item, self.score, self.doc, self.null = (x[order] for x in (self.item, self.score, self.doc, self.null))

    def rows(self) -> Iterator[pa.RecordBatch]:
        doc = pa.array(self.doc, mask=self.null)
        yield pa.RecordBatch.from_arrays(
            [pa.array(self.item.astype(np.int32)), doc, pa.array(self.score)], ["item", "doc_id", "score"]
        )


def best(rows: DataFrame, keys: list[str], k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)


def search_block(asked: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for the items of one block's (item, item_id, term, times)."""
    spark = asked.sparkSession
    entries = asked.orderBy("term", "item").toArrow()  # at most about INDEX_MOST rows, as columns
    encoded = entries.column("term").cast(pa.large_binary()).combine_chunks().dictionary_encode()
    words = encoded.dictionary.to_pylist()  # in order, as the rows are
    bounds = np.searchsorted(encoded.indices.to_numpy(), np.arange(len(words) + 1))
    items, holders = np.unique(entries.column("item").to_numpy(), return_inverse=True)
    repeats = entries.column("times").to_numpy().astype(np.int64)
    names: list[int | None] = [None] * len(items)
    for i, item_id in zip(holders.tolist(), entries.column("item_id").to_pylist(), strict=True):
        names[i] = item_id

    vocabulary = spark.sparkContext.broadcast(words)
    counts = written(docs.mapInArrow(count_terms(vocabulary), COUNTS).filter("n > 0"), "term-counts")
    total = counts.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    held = counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect()
    df = np.zeros(len(words), np.int64)
    for r in held:  # one row per term of the index
        df[r["t"]] = r["df"]
    n = total["documents"]
    weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    index = spark.sparkContext.broadcast((weights, bounds, holders, repeats))
    heaps = counts.filter(F.size("terms") > 0).mapInArrow(stream(index, len(names), n, total["length"] or 1, k), HEAPS)
    heaps = written(heaps.withColumn("task", F.spark_partition_id()), "heaps")
    forget(counts)
    tasks = (heaps.agg(F.max("task")).first()[0] or 0) + 1
    merged = best(heaps.withColumn("part", F.col("task") % math.isqrt(tasks)), ["item", "part"], k, "_rank")
    merged = best(merged, ["item"], k, "rank")
    id_type = asked.schema["item_id"].dataType
    named = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    named = named.withColumn("item_id", F.col("item_id").cast(id_type))
    return merged.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score")


def search(
    items: DataFrame,
    documents: DataFrame,
    k: int = K,
    item_col: str = "item_id",
    id_col: str = "doc_id",
    text_col: str = "text",
    index_most: int = INDEX_MOST,
) -> DataFrame:
    """item_col, rank (from 1), id_col, score: the k best documents of each item."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    given = items.select(
        F.monotonically_increasing_id().alias("item"),
        F.col(item_col).cast("long").alias("item_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    asked = given.mapInArrow(item_terms, "item long, item_id long, term binary")
    asked = asked.groupBy("item", "item_id", "term").agg(F.count(F.lit(1)).alias("times"))
    asked = written(asked, "item-terms")
    blocks = max(1, -(-asked.count() // index_most))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = [search_block(asked.filter(block == b), docs, k) for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
