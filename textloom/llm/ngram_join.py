"""Jaccard join of documents on word shingles, with Bayesian pruning of candidates.

Distinct texts get MinHash values (16 bits each) of their shingles. Texts that
agree in all values of a band are candidates; their values are compared a few
at a time, and a pair is dropped as soon as the posterior probability that its
similarity reaches the threshold falls below a tolerance (uniform prior, the
likelihood of m equal values among n). What is left is checked exactly, on the
shingles of whole texts.

With 32 bands of 5 values a pair at similarity 0.8 is missed by all bands 3
times in a million, and the tolerance loses as few. Equal texts are one entry
with a count. Bands and candidate groups of any size are dealt into blocks, and
units return link counts and forest edges, never all pairs of a group.

Defined cases: documents without words (null, empty, blanks) link with nothing;
a text of fewer words than a shingle has one shingle of all its words; equal
texts link with each other, repeated rows included; a null id counts as the
smallest; the class of a document is the smallest id that links lead to.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import is_blank
from textloom.llm import groups
from textloom.llm.common import (
    forget,
    group_starts,
    mix,
    shingle_hashes,
    sliced,
    whole_groups,
    written,
)

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 32
ROWS = 5
STEP = 32  # values compared between two looks at the posterior
TOLERANCE = 1e-6


@lru_cache
def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, 2 * n + 1, dtype=np.uint64)).reshape(n, 2) | np.array([1, 0], np.uint64)


def minhash(hashes: np.ndarray, bounds: np.ndarray, values: int) -> np.ndarray:
    """16 bits of the smallest image of each set under `values` hash functions."""
    some = np.flatnonzero(np.diff(bounds) > 0)
    out = np.zeros((len(bounds) - 1, values), np.uint16)
    if len(some):
        starts = bounds[some]
        for v, (a, b) in enumerate(multipliers(values)):
            out[some, v] = (np.minimum.reduceat(hashes * a + b, starts) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def signer(size: int, values: int) -> Callable:
    """(doc_id, text, digest) to (doc_id, digest, shingles, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            hashes, bounds = shingle_hashes(batch.column("text"), size)
            rows = minhash(hashes, bounds, values)
            counts = pa.array(np.diff(bounds).astype(np.int32))
            packed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(2 * values), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))]
            ).cast(pa.binary())
            columns = [batch.column("doc_id"), batch.column("digest"), counts, packed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "shingles", "signature"])

    return run


def signatures(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint16)[bounds[0] // 2 : bounds[-1] // 2].reshape(len(column), -1)


def band_keys(bands: int) -> Callable:
    """(k, signature) to (key, k), a row per band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = signatures(batch.column("signature"))
            parts = rows.reshape(len(rows), bands, -1).astype(np.uint64)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
            for v in range(parts.shape[2]):
                key = mix(key * np.uint64(1 << 17) ^ parts[:, :, v])
            k = np.repeat(batch.column("k").to_numpy(), bands)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(k)], ["key", "k"])

    return run


@lru_cache
def needed(n: int, threshold: float, tolerance: float) -> int:
    """The fewest equal values among n that keep a pair alive.

    With a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed
    after m equal values, and reaches t with the probability that a
    Binomial(n + 1, t) number is at most m.
    """
    below = 0.0
    for m in range(n + 1):
        term = math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m)
        below += math.exp(term + m * math.log(threshold) + (n + 1 - m) * math.log1p(-threshold))
        if below >= tolerance:
            return m
    return n


def survivors(
    rows: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float, tolerance: float
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose posterior stays above the tolerance to the last value."""
    equal = np.zeros(len(i), np.int32)
    for at in range(0, rows.shape[1], STEP):
        part = slice(at, at + STEP)
        equal = equal + (rows[i, part] == rows[j, part]).sum(axis=1)
        alive = equal >= needed(min(at + STEP, rows.shape[1]), threshold, tolerance)
        i, j, equal = i[alive], j[alive], equal[alive]
        if not len(i):
            break
    return i, j


def likely(threshold: float, tolerance: float) -> Callable:
    """Units of (k, signature) to forest edges (u, v) of surviving pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, list(groups.UNIT)):
            k = table.column("k").to_numpy()
            rows = signatures(table.column("signature"))
            u, v = np.zeros(0, np.int64), np.zeros(0, np.int64)
            for i, j in groups.pairs(table, 1 << 18):
                i, j = survivors(rows, i, j, threshold, tolerance)
                u, v = groups.forest(np.concatenate([u, i]), np.concatenate([v, j]), len(k))
            edges = np.unique(np.stack([k[u], k[v]], axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["u", "v"])

    return run


def common_shingles(hashes: np.ndarray, bounds: np.ndarray, cut: int) -> np.ndarray:
    """Shared shingles of each row below `cut` with each from `first` on, where
    first is 0 if cut is the number of rows and else cut: a product of 0/1
    matrices over the shingles that at least two rows have."""
    n = len(bounds) - 1
    first = 0 if cut == n else cut
    row = np.repeat(np.arange(n), np.diff(bounds))
    order = np.argsort(hashes, kind="stable")
    sorted_hashes, row = hashes[order], row[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    column = np.cumsum(fresh) - 1
    many = np.bincount(column) > 1 if len(column) else np.zeros(0, bool)
    live = many[column]
    row, column = row[live], (np.cumsum(many) - 1)[column[live]]
    out = np.zeros((cut, n - first), np.float64)
    width = max(256, (1 << 24) // max(n, 1))
    for at in range(0, int(many.sum()), width):
        here = (column >= at) & (column < at + width)
        ones = np.zeros((n, min(width, int(many.sum()) - at)), np.float32)
        ones[row[here], column[here] - at] = 1
        out += ones[:cut] @ ones[first:].T
    return out


def verified(size: int, threshold: float, tolerance: float) -> Callable:
    """Units of texts to (k, links, up): texts at least `threshold` similar to
    each, counted with their copies, and a smaller one of its class here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, list(groups.UNIT), 512):
            starts = group_starts(table, list(groups.UNIT))
            side = table.column("_side").to_numpy()
            alone = table.column("_a").to_numpy() == table.column("_b").to_numpy()
            k, n = table.column("k").to_numpy(), table.column("n").to_numpy()
            rows = signatures(table.column("signature"))
            links, up = np.zeros(len(k), np.int64), np.arange(len(k))
            for a, b in zip(starts, np.append(starts[1:], len(k)), strict=True):
                unit = table.slice(a, b - a)
                alive = np.zeros((b - a, b - a), bool)
                for i, j in groups.pairs(unit, 1 << 18):
                    i, j = survivors(rows[a:b], i, j, threshold, tolerance)
                    alive[i, j] = True
                if not alive.any():
                    continue
                hashes, bounds = shingle_hashes(unit.column("text").combine_chunks(), size)
                cut = b - a if alone[a] else int(np.searchsorted(side[a:b], 1))
                first = 0 if alone[a] else cut
                common = common_shingles(hashes, bounds, cut)
                sizes = np.diff(bounds)
                union = sizes[:cut, None] + sizes[None, first:] - common
                near = alive[:cut, first:] & (common >= threshold * union - 1e-9)
                i, j = np.nonzero(near)
                j = j + first
                np.add.at(links, a + i, n[a + j])
                np.add.at(links, a + j, n[a + i])
                moved, root = groups.forest(i, j, b - a)
                up[a + moved] = a + root
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(links), pa.array(k[up])], ["k", "links", "up"])

    return run


def join(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id_col, `digest` (MD5 of the text), n_links, class_id, kept: one row per
    document. `kept` holds for the class's smallest id with the text that has
    it, in each of its rows should that very row repeat."""
    docs = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    ).withColumn("digest", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    schema = "doc_id long, digest binary, shingles int, signature binary"
    signed = docs.mapInArrow(signer(size, BANDS * ROWS), schema)
    distinct = signed.filter("shingles > 0").groupBy("digest").agg(
        F.min_by("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.first("signature").alias("signature"),
    )
    distinct = written(distinct.withColumn("k", F.monotonically_increasing_id()), "signatures")

    bands = distinct.select("k", "signature").mapInArrow(band_keys(BANDS), "key long, k long")
    met = groups.sharing(bands, "key").join(distinct.select("k", "signature"), "k")
    near = groups.units(met, "key", "k").mapInArrow(likely(threshold, tolerance), "u long, v long")
    candidates = groups.components(near)

    together = candidates.withColumnsRenamed({"id": "k", "component": "key"})
    sizes = together.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    members = together.join(sizes, "key").join(distinct, "k")
    texts = docs.withColumn("first", F.col("doc_id"))
    null_safe = (texts["digest"] == members["digest"]) & texts["first"].eqNullSafe(members["first"])
    texts = members.join(texts, null_safe).select("k", "key", "_n", "n", "signature", "text").dropDuplicates(["k"])
    checked = groups.units(texts, "key", "k", block=512).mapInArrow(
        verified(size, threshold, tolerance), "k long, links long, up long"
    )
    checked = written(checked, "links")
    classes = groups.components(checked.filter("up < k"), "up", "k")
    forget(candidates)

    links = checked.groupBy("k").agg(F.sum("links").alias("links"))
    named = distinct.select("digest", "k", "first", "n").join(classes.withColumnRenamed("id", "k"), "k", "left")
    named = named.join(links, "k", "left").withColumn("component", F.coalesce("component", "k"))
    lowest = F.min(F.struct("first", "digest")).alias("lowest")
    smallest = named.groupBy("component").agg(lowest)
    named = named.join(smallest, "component").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "lowest"
    )
    found = docs.select("doc_id", "digest").join(named, "digest", "left")
    kept = F.col("doc_id").eqNullSafe(F.col("lowest.first")) & (F.col("digest") == F.col("lowest.digest"))
    return found.select(
        F.col("doc_id").alias(id_col),
        "digest",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("lowest").isNull(), F.col("doc_id")).otherwise(F.col("lowest.first")).alias("class_id"),
        F.when(F.col("lowest").isNull(), True).otherwise(kept).alias("kept"),
    )


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, with all columns, a repeated row once;
    documents without words all stay."""
    found = join(documents, id_col=id_col, text_col=text_col, **options)
    chosen = found.filter("kept").select(F.col(id_col).cast("long").alias("_id"), F.col("digest").alias("_digest"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = documents.withColumn("_digest", F.unhex(F.md5(F.encode(text, "UTF-8"))))
    docs = docs.withColumn("_id", F.col(id_col).cast("long"))
    docs = docs.withColumn("_own", F.when(is_blank(text), F.monotonically_increasing_id()))
    same = (docs["_digest"] == chosen["_digest"]) & docs["_id"].eqNullSafe(chosen["_id"])
    stay = docs.join(chosen, same, "left_semi").dropDuplicates(["_id", "_digest", "_own"])
    return stay.drop("_id", "_digest", "_own")
