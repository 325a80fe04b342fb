"""Helpers of this subpackage: written intermediates, texts and words as numpy arrays.

Work inside tasks runs on whole Arrow batches: a column of texts is one byte
buffer with offsets, and words, shingles and their hashes are found by array
operations on it, never text by text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.session import discard as forget  # noqa: F401  used through this module
from textloom.session import scratch_root


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: lineage ends there."""
    path = folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: While a step is written: Arrow batches of rows that are megabytes each stay small,
#: on both sides of the pipe, and the shuffle files of the step go at its end, as what
#: they led to stands in the written table.
STEP = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def step_settings(spark: SparkSession) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in STEP}
    for key, value in STEP.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stepped(df: DataFrame, name: str) -> DataFrame:
    """`written` for steps that hand on parcels: bounded batches, no shuffle files left."""
    with step_settings(df.sparkSession):
        return written(df, name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: So many ids go to every task at most; beyond, rows are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def flagged(rows: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """`rows` with a boolean: whether `ids` (written, one row per id) has the key.
    Read again and again either way, so a joined table is written once."""
    marks = ids.select(key, F.lit(True).alias("_mark"))
    small = ids.count() <= BROADCAST_IDS
    joined = rows.join(F.broadcast(marks) if small else marks, key, "left")
    joined = joined.withColumn(flag, F.coalesce("_mark", F.lit(False))).drop("_mark")
    return joined if small else written(joined, "flagged")


# ---------------------------------------------------------------- hashing

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (wraps on purpose)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of the base and of its inverse, as long as asked for."""

    _up = np.ones(1, np.uint64)
    _down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._up) < n:
            size = -(-n // (1 << 20)) << 20
            for name, base in (("_up", BASE), ("_down", BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls._up[:n], cls._down[:n]


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Running polynomial sums; `span_hash` turns them into hashes of spans."""
    up, _ = Powers.get(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    terms = sums[1:]
    terms += symbols.astype(np.uint64, copy=False)
    terms += np.uint64(1)
    terms *= up[: len(symbols)]
    np.cumsum(terms, out=terms)
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash per span [start, end): equal for equal contents."""
    _, down = Powers.get(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def all_spans(sums: np.ndarray, size: int) -> np.ndarray:
    """`span_hash` of every span of `size` symbols, in order."""
    _, down = Powers.get(len(sums))
    return mix((sums[size:] - sums[:-size]) * down[: len(sums) - size] + np.uint64(size))


# ---------------------------------------------------------------- texts

BLANK = np.zeros(256, bool)
BLANK[[*range(9, 14), *range(28, 33)]] = True
# Blanks outside ASCII, as they count for words elsewhere in the library.
WIDE_BLANK = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


#: Also apart at ASCII punctuation, for operators on bare words.
APART = BLANK.copy()
APART[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_spans(texts: pa.Array, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words between blanks: (bytes, start, end, first word of each text + total)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if pc.any(pc.match_substring_regex(texts, WIDE_BLANK)).as_py():
        texts = pc.replace_substring_regex(texts, WIDE_BLANK, " ")
    raw, bounds = utf8(texts)
    inside = np.zeros(len(raw) + 1, bool)
    inside[:-1] = ~blank[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_here = bounds[:-1][bounds[:-1] < len(raw)]
    first[starts_here] = inside[starts_here]
    start = np.flatnonzero(first)
    last = inside[:-1].copy()
    last[:-1] &= ~inside[1:-1] | first[1:-1]
    end = np.flatnonzero(last) + 1
    return raw, start, end, np.searchsorted(start, bounds)


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def word_hashes(texts: pa.Array, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word, and the first word of each text + total."""
    raw, start, end, bounds = word_spans(texts, blank)
    return span_hash(prefix_hash(raw), start, end), bounds


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `size` words in a row, sorted within each text, and
    their bounds. A text of fewer words has one of all its words, an empty none."""
    words, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    grams = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    doc = np.repeat(np.arange(len(counts)), grams)
    begin = bounds[:-1][doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(grams) - grams, grams))
    stop = np.minimum(begin + size, bounds[1:][doc])
    hashes = span_hash(prefix_hash(words), begin, stop)
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[fresh], np.searchsorted(doc[fresh], np.arange(len(counts) + 1))


# ---------------------------------------------------------------- batches


def sliced(batches: Iterator[pa.RecordBatch], column: str, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about `limit` bytes of `column`; a
    longer text comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 20_000) -> Iterator[pa.Table]:
    """Batches sorted by `keys` as tables of about `rows` rows that never split a
    group."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.Table.from_batches(held)
        cuts = _cuts(group_starts(table, keys), rows)
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)
        held = table.slice(cuts[-1]).to_batches()
        n = table.num_rows - cuts[-1]
    if held:
        table = pa.Table.from_batches(held)
        cuts = [*_cuts(group_starts(table, keys), rows), table.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield table.slice(a, b - a)


def _cuts(starts: np.ndarray, rows: int) -> list[int]:
    """Starts about `rows` apart, the first and the last one included."""
    part = starts // rows
    first = np.append(True, part[1:] != part[:-1])
    first[-1] = True
    return starts[first].tolist()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where a new group begins."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for key in keys:
        column = table.column(key).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def usable(vector: str) -> Column:
    """Not null, not all zero, no null or non-finite component."""
    v = F.col(vector)
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")).cast("float"))
    )
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out
