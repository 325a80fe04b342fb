"""Near-duplicate embeddings by iterative quantisation and multi-index Hamming tables.

A rotation of the principal directions is learnt that makes the signs of the
rotated vectors balanced bits (alternating between codes and rotation). Two
rotations from different starts give two codes per vector. Codes are cut into
substrings, and two codes meet in a table if one of their substrings differs in
at most one bit: every substring is entered once per bit with that bit left
out. Meeting codes within a Hamming radius are candidates; candidates that hang
together are compared as original vectors, in doubles, block against block.

Equal vectors are one entry with a count from the start. Tables and candidate
groups of any size are dealt into blocks; units return link counts and the
edges of a forest, so a group of m vectors costs m rows, not m squared.

Only the rotations are fitted on a sample (about SAMPLE vectors, drawn by a
hash of their id, a documented bound); every vector is coded and compared. Pairs at
cosine 0.9 differ in 14 % of bits: some substring of the eight is within one
bit for 96 of 100 of them, and nearly all at 0.95.

Defined cases: null or zero vectors, null or non-finite components and null ids
link with nothing (n_links 0, a component of their own); equal vectors link,
repeated ids included; shorter vectors count as padded with zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import groups
from textloom.llm.common import forget, group_starts, matrix, mix, usable, whole_groups, written

SAMPLE = 20_000
SAMPLE_CELLS = 4_000_000  # of the sample's matrix, for very long vectors
BITS = 64
CHUNK = 16
ROTATIONS = 2
RADIUS = 0.27  # of all bits


def unit_rows(points: np.ndarray) -> np.ndarray:
    """Rows of length 1, safe for huge and tiny components."""
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def fit(sample: np.ndarray, bits: int = BITS, rotations: int = ROTATIONS, rounds: int = 50) -> tuple[np.ndarray, list]:
    """The mean, and one projection to `bits` columns per rotation."""
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    low = centred @ axes
    out = []
    for start in range(rotations):
        draw = np.random.default_rng(start).standard_normal((axes.shape[1],) * 2)
        turn = np.linalg.qr(draw)[0]
        for _ in range(rounds if len(sample) else 0):
            u, _, v = np.linalg.svd(np.where(low @ turn >= 0, 1.0, -1.0).T @ low)
            turn = v.T @ u.T
        out.append(axes @ turn)
    return mean, out


def encode(points: np.ndarray, mean: np.ndarray, projections: list[np.ndarray]) -> np.ndarray:
    """One 64-bit code per row and rotation."""
    codes = []
    for projection in projections:
        signs = (points - mean) @ projection >= 0
        bits = np.zeros((len(points), 64), np.uint8)
        bits[:, : signs.shape[1]] = signs
        codes.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel())
    return np.stack(codes, axis=1)


def table_keys(codes: np.ndarray, bits: int, chunk: int = CHUNK) -> np.ndarray:
    """Per code the keys of its substrings with one bit left out each."""
    keys = []
    for r in range(codes.shape[1]):
        for at in range(0, bits, chunk):
            size = min(chunk, bits - at)
            part = (codes[:, r] >> np.uint64(at)) & np.uint64((1 << size) - 1)
            for b in range(size):
                slot = np.uint64(((r * 64 + at) * 64 + b) << 32)
                keys.append(slot | (part & ~np.uint64(1 << b)))
    return np.stack(keys, axis=1)


def coder(width: int, mean: np.ndarray, projections: list[np.ndarray]) -> Callable:
    """(k, vector) to (key, k, c0, c1): a row per table entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                codes = encode(unit_rows(matrix(batch.column("vector"), width)), mean, projections)
                keys = table_keys(codes, projections[0].shape[1])
                each = keys.shape[1]
                columns = [mix(keys.ravel()), np.repeat(batch.column("k").to_numpy(), each)]
                columns += [np.repeat(codes[:, r], each) for r in range(codes.shape[1])]
                arrays = [pa.array(c.astype(np.int64, copy=False).view(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "k", "c0", "c1"])

    return run


def near_codes(limit: int) -> Callable:
    """Units of table entries to forest edges (u, v) of codes within `limit` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, list(groups.UNIT)):
            k = table.column("k").to_numpy()
            c0, c1 = table.column("c0").to_numpy(), table.column("c1").to_numpy()
            found = []
            for i, j in groups.pairs(table):
                apart = np.bitwise_count(c0[i] ^ c0[j]) + np.bitwise_count(c1[i] ^ c1[j])
                near = apart <= limit
                found.append(groups.forest(i[near], j[near], len(k)))
            if found:
                u, v = (np.concatenate(x) for x in zip(*found, strict=True))
                edges = np.unique(np.stack([k[u], k[v]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["u", "v"])

    return run


def linked(width: int, threshold: float) -> Callable:
    """Units of vectors to (k, links, up): vectors linked to each, counted with
    their copies, and a smaller one of its component here (or itself)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, list(groups.UNIT), 4_096):
            starts = group_starts(table, list(groups.UNIT))
            side = table.column("_side").to_numpy()
            alone = table.column("_a").to_numpy() == table.column("_b").to_numpy()
            k, n = table.column("k").to_numpy(), table.column("n").to_numpy()
            points = unit_rows(matrix(table.column("vector"), width))
            links, up = np.zeros(len(k), np.int64), np.arange(len(k))
            for a, b in zip(starts, np.append(starts[1:], len(k)), strict=True):
                cut = b if alone[a] else a + int(np.searchsorted(side[a:b], 1))
                other = a if alone[a] else cut
                near = points[a:cut] @ points[other:b].T >= threshold
                if alone[a]:
                    np.fill_diagonal(near, False)
                    links[a:b] += near @ n[a:b]
                else:
                    links[a:cut] += near @ n[cut:b]
                    links[cut:b] += near.T @ n[a:cut]
                i, j = np.nonzero(near)
                moved, root = groups.forest(i, j + other - a, b - a)
                up[a + moved] = a + root
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(links), pa.array(k[up])], ["k", "links", "up"])

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    radius: float = RADIUS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """id_col, n_links, component_id, kept: one row per row of `vectors`."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("fit", usable("vector") & F.col("id").isNotNull())
    distinct = rows.filter("fit").groupBy("vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = written(distinct.withColumn("k", F.monotonically_increasing_id()), "vectors")

    size = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("w")).first()
    width = size["w"] or 1
    most = min(SAMPLE, max(1, SAMPLE_CELLS // width))
    drawn = F.pmod(F.xxhash64("first", F.lit(11)), F.lit(1 << 30)) < int(min(1.0, most / max(1, size["n"])) * (1 << 30))
    sample = distinct.filter(drawn).select("vector").toArrow()
    points = matrix(sample.column("vector"), width)
    mean, projections = fit(unit_rows(points) if len(points) else points)
    bits = projections[0].shape[1] * len(projections)

    entries = distinct.select("k", "vector").mapInArrow(
        coder(width, mean, projections), "key long, k long, c0 long, c1 long"
    )
    work = groups.units(groups.sharing(entries, "key"), "key", "k")
    near = work.mapInArrow(near_codes(int(radius * bits)), "u long, v long")
    candidates = groups.components(near)

    together = candidates.withColumnsRenamed({"id": "k", "component": "key"})
    sizes = together.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    members = together.join(sizes, "key").join(groups.by_shuffle(distinct.select("k", "n", "vector")), "k")
    checked = groups.units(members, "key", "k", block=1_024).mapInArrow(
        linked(width, threshold), "k long, links long, up long"
    )
    checked = written(checked, "links")
    classes = groups.components(checked.filter("up < k"), "up", "k")
    forget(candidates)
    return per_row(rows, distinct, checked, classes, id_col)


def per_row(rows: DataFrame, distinct: DataFrame, checked: DataFrame, classes: DataFrame, id_col: str) -> DataFrame:
    """Counts and classes of distinct vectors back to the rows that hold them."""
    links = checked.groupBy("k").agg(F.sum("links").alias("links"))
    named = distinct.select("vector", "k", "first", "n").join(classes.withColumnRenamed("id", "k"), "k", "left")
    named = named.join(groups.by_shuffle(links), "k", "left").withColumn("component", F.coalesce("component", "k"))
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    named = named.join(smallest, "component").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "smallest"
    )
    fit = rows.filter("fit").join(groups.by_shuffle(named), "vector").select("id", "n_links", "smallest")
    rest = rows.filter("not fit").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("smallest"))
    out = fit.unionByName(rest)
    return out.select(
        F.col("id").alias(id_col),
        "n_links",
        F.col("smallest").alias("component_id"),
        F.coalesce(F.col("id") == F.col("smallest"), F.lit(False)).alias("kept"),
    )
