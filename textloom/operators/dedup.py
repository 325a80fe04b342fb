"""Near-duplicate removal: MinHash signatures, banding, first copy kept.

The rule is sequential: walking the documents in order, one is dropped when an
earlier *kept* one shares a band with it. In graph terms that is the
lexicographically first maximal independent set, which rounds of aggregates
find without ever listing pairs:

* a document that is the first undecided one in every band it has is kept;
* an undecided document that shares a band with a kept one is dropped.

Rounds alone would take one for two documents of a chain, so documents are
first split into connected components, which decide themselves: all but very
large ones are walked in order, each in one task.

A chain A~B~C keeps A and C, exactly as the walk does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.config import Settings
from textloom.functions import text as tx
from textloom.operators.components import components
from textloom.session import discard, materialize

# Fixed values of the hash family: a Mersenne prime modulus, 32-bit results,
# and the seed the coefficients are drawn with.
PRIME = (1 << 61) - 1
MASK = (1 << 32) - 1
FAMILY_SEED = 1

SALTS = 64  # tasks that share one hot band
WALK_MOST = 200_000  # band rows of a component that one task walks
HOT_FLOOR = 100_000  # rows one task takes without any help


def shingles(text: Column, size: int = 5) -> Column:
    """Distinct word shingles. Fewer words than `size` give one shingle of all
    of them; a text without words gives the empty one."""

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - size, F.lit(0)) + 1)
        return F.transform(starts, lambda i: F.array_join(F.slice(w, i, size), " "))

    return F.array_distinct(tx.bind(tx.words(text), cut))


@lru_cache
def coefficients(perms: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the `perms` hash functions, drawn in turn."""
    draw = np.random.RandomState(FAMILY_SEED)
    pairs = [
        (draw.randint(1, PRIME, dtype=np.uint64), draw.randint(0, PRIME, dtype=np.uint64)) for _ in range(perms)
    ]
    a, b = np.array(pairs, dtype=np.uint64).T
    return a, b


# Blanks beyond ASCII, and ASCII ones, as they part words everywhere in the library.
WIDE_BLANK = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
BLANK = np.zeros(256, bool)
BLANK[[*range(9, 14), *range(28, 33)]] = True
SLICE_BYTES = 1 << 20  # texts hashed together


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The same texts, at most about SLICE_BYTES together; a longer one alone."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield texts.slice(a, b - a)


def shingle_digests(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 8 bytes of the SHA-1 of every shingle, and the bounds of each
    text in them, repeats included. All texts are cut in a few array steps:
    one blank after each word, so that a shingle is a span of the result."""
    none, blank = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    texts = pc.binary_join_element_wise(texts.cast(pa.large_string()), none, blank)  # a blank ends every text
    if pc.any(pc.match_substring_regex(texts, WIDE_BLANK)).as_py():
        texts = pc.replace_substring_regex(texts, WIDE_BLANK, " ")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    inside = ~BLANK[raw]
    after = ~inside
    after[1:] &= inside[:-1]
    after[:1] = False
    keep = inside | after
    plain = raw[keep]
    ends = np.flatnonzero(after[keep])
    plain[ends] = 32
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    first = np.searchsorted(np.flatnonzero(after), bounds - bounds[0])
    words = np.diff(first)
    grams = np.maximum(words - size + 1, 1)
    total = np.concatenate([[0], np.cumsum(grams)])
    doc = np.repeat(np.arange(len(words)), grams)
    begin = first[:-1][doc] + np.arange(total[-1]) - total[:-1][doc]
    stop = np.minimum(begin + size, first[1:][doc])
    some = stop > begin  # else the one empty shingle of a text without words
    a, b = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    a[some], b[some] = starts[begin[some]], ends[stop[some] - 1]
    text, heads = plain.tobytes(), _Heads()
    joined = b"".join([heads[text[x:y]] for x, y in zip(a.tolist(), b.tolist(), strict=True)])
    return np.frombuffer(joined, np.uint64), total


class _Heads(dict):
    """The first 8 bytes of the SHA-1 of a shingle. Copies of a text often stand
    together, so each distinct shingle of a slice is hashed once."""

    def __missing__(self, shingle: bytes) -> bytes:
        self[shingle] = head = hashlib.sha1(shingle).digest()[:8]
        return head


def _signatures(texts: pa.Array, size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One row of minima per text, over the shingles of all texts at once."""
    digests, bounds = shingle_digests(texts, size)
    base = digests & np.uint64(MASK)
    best = np.full((len(texts), len(a)), MASK, dtype=np.uint64)
    prime, low = np.uint64(PRIME), np.uint64(61)
    step = 512  # stays inside the processor cache
    for start in range(0, len(base), step):
        stop = min(start + step, len(base))
        x = a[:, None] * base[None, start:stop]
        x += b[:, None]
        # x modulo the Mersenne prime: fold the high bits, then take the prime off if it is left.
        y = x >> low
        x &= prime
        x += y
        np.subtract(x, prime, out=y)
        np.minimum(x, y, out=x)
        x &= np.uint64(MASK)
        docs = np.arange(np.searchsorted(bounds, start, "right") - 1, np.searchsorted(bounds, stop, "left"))
        heads = np.maximum(bounds[docs] - start, 0)
        best[docs] = np.minimum(best[docs], np.minimum.reduceat(x, heads, axis=1).T)
    return best.astype(np.int64)


def minhash(text: Column, perms: int = 128, size: int = 5) -> Column:
    """The signature: per hash function, the smallest value over the shingles.

    128 hash functions per shingle would be 128 interpreted lambdas per shingle
    in SQL; as array arithmetic over an Arrow batch they are a few operations.
    """

    @F.arrow_udf("array<bigint>")
    def signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        a, b = coefficients(perms)
        for texts in batches:
            for part in _slices(texts.cast(pa.large_string())):
                bounds = pa.array(np.arange(0, (len(part) + 1) * perms, perms, dtype=np.int32))
                yield pa.ListArray.from_arrays(bounds, pa.array(_signatures(part, size, a, b).reshape(-1)))

    return signature.asNondeterministic()(tx.or_empty(text))


@lru_cache
def banding(threshold: float = 0.85, perms: int = 128) -> tuple[int, int]:
    """(bands, rows) for which false positives below the threshold and false
    negatives above it weigh least together, both counted alike."""
    step = 0.001
    s = np.arange(step / 2, 1, step)
    best, shape = None, (1, 1)
    for bands in range(1, perms + 1):
        for rows in range(1, perms // bands + 1):
            hit = 1 - (1 - s**rows) ** bands
            loss = step * (hit[s < threshold].sum() + (1 - hit[s >= threshold]).sum())
            if best is None or loss < best:
                best, shape = loss, (bands, rows)
    return shape


def band_keys(signature: Column, bands: int, rows: int) -> Column:
    """One key per band: 128 bits over the band number and its values."""
    return F.array(
        *[
            F.unhex(F.md5(F.concat_ws(",", F.lit(str(b)), F.slice(signature, b * rows + 1, rows))))
            for b in range(bands)
        ]
    )


def with_band_keys(df: DataFrame, order: str, s: Settings = Settings(), column: str = "text") -> DataFrame:
    """(order, keys): everything later steps need, a few hundred bytes a document."""
    bands, rows = banding(s.minhash_threshold, s.minhash_perms)
    signed = df.select(order, minhash(F.col(column), s.minhash_perms, s.shingle_size).alias("signature"))
    return signed.select(order, band_keys(F.col("signature"), bands, rows).alias("keys"))


def first_copies(df: DataFrame, order: str, key: Column) -> DataFrame:
    """The smallest order value per key; partial minima combine map-side, so a
    key that holds a third of the rows costs one row per task."""
    return df.groupBy(key.alias("_key")).agg(F.min(order).alias(order)).select(order)


def exact_copies(df: DataFrame, order: str, column: str = "text") -> DataFrame:
    """(order, is_copy): whether an earlier document has the very same text."""
    hashed = df.select(order, F.unhex(F.sha2(F.col(column), 256)).alias("_hash"))
    kept = first_copies(hashed, order, F.col("_hash")).withColumn("_first", F.lit(True))
    return hashed.select(order).join(kept, order, "left").select(order, F.col("_first").isNull().alias("is_copy"))


def _band_rows(df: DataFrame, order: str) -> DataFrame:
    return df.select(order, F.explode("keys").alias("key"))


def _in_bands(rows: DataFrame, bands: DataFrame, order: str, total: int) -> DataFrame:
    """The rows whose key is one of `bands` (key, _n, ...), with its columns.

    A band may hold a third of all documents. Bands with more than a 10,000th
    of them, at most 10,000 for each of a document's few bands, are known by
    their counts: their rows are dealt out over SALTS tasks, and only they are.
    """
    hot_from = max(HOT_FLOOR, total // 10_000)
    if total <= hot_from:  # no band can have more
        return rows.join(bands, "key")
    bands = materialize(bands, "bands")
    hot = bands.filter(F.col("_n") > hot_from)
    if hot.isEmpty():
        return rows.join(bands, "key")
    marked = rows.join(F.broadcast(hot.select("key", F.lit(True).alias("_hot"))), "key", "left")
    pick = F.pmod(F.xxhash64(order), F.lit(SALTS)).cast("int")
    salted = marked.withColumn("_salt", F.when(F.col("_hot"), pick).otherwise(0)).drop("_hot")
    every = F.when(F.col("_n") > hot_from, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(bands.withColumn("_salt", F.explode(every)), ["key", "_salt"]).drop("_salt")


def dropped_documents(keys: DataFrame, order: str) -> DataFrame:
    """The order values of the documents the first-kept rule drops.

    `keys` is (order, keys). Documents equal in every band collapse to the
    first of them; of the rest, only bands that hold two or more documents go
    into the rounds, which for most corpora is a small part.
    """
    keys = materialize(keys, "signed")
    total = keys.count()
    size = F.count(F.lit(1)).alias("_n")
    distinct = materialize(keys.groupBy("keys").agg(F.min(order).alias(order)), "distinct")
    dropped = keys.select(order).join(distinct.select(order), order, "left_anti")

    rows = _band_rows(distinct, order)
    shared = rows.groupBy("key").agg(size).filter("_n > 1")
    undecided = materialize(_in_bands(rows, shared, order, total).select(order, "key"), "round")
    walked, undecided = _walk_components(undecided, order)
    dropped = dropped.union(walked)
    while not undecided.isEmpty():
        heads = undecided.groupBy("key").agg(F.min(order).alias("_head"), size)
        # Kept: the first one in every one of its remaining bands.
        led = heads.groupBy(F.col("_head").alias(order)).agg(F.count(F.lit(1)).alias("_led"))
        has = undecided.groupBy(order).agg(F.count(F.lit(1)).alias("_has"))
        kept = has.join(led, order).filter("_led = _has").select(F.col(order).alias("_head"))
        closed = heads.join(kept, "_head", "left_semi")
        # In a closed band the head is kept and all others are lost.
        met = _in_bands(undecided, closed, order, total)
        decided = met.groupBy(order).agg(F.max(F.col(order) == F.col("_head")).alias("_kept"))
        decided = materialize(decided, "decided")
        dropped = dropped.union(decided.filter(~F.col("_kept")).select(order))
        left = materialize(undecided.join(decided, order, "left_anti"), "round")
        discard(undecided)
        undecided = left
    out = materialize(dropped, "dropped")
    discard(keys, distinct, undecided)
    return out


def _walk_components(undecided: DataFrame, order: str, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(order of dropped documents, what is left for the rounds).

    Documents that share bands, directly or by way of others, form components
    that decide themselves. Components are dealt out over tasks and walked in
    order there, so a chain of any length within one costs one pass; those with
    more than `most` rows, which one task should not take, stay in the rounds.
    """
    most = WALK_MOST if most is None else most
    heads = undecided.groupBy("key").agg(F.min(order).alias("_head"))
    links = undecided.join(heads, "key").select(F.col("_head").alias("u"), F.col(order).alias("v"))
    found = components(links).withColumnsRenamed({"id": order, "component": "_component"})
    # A document whose bands' other holders are none links with nothing: kept.
    placed = materialize(undecided.join(found, order), "placed")
    sizes = placed.groupBy("_component").agg(F.count(F.lit(1)).alias("_rows"))
    kind = undecided.schema[order].dataType.simpleString()
    small = placed.join(sizes.filter(F.col("_rows") <= most), "_component").groupBy("_component", order)
    small = small.agg(F.collect_list("key").alias("keys"))
    dealt = small.repartition("_component").sortWithinPartitions("_component", order).select("_component", order, "keys")
    walked = materialize(dealt.mapInArrow(_walk, f"`{order}` {kind}"), "walked")
    large = sizes.filter(F.col("_rows") > most).select("_component")
    rest = materialize(placed.join(large, "_component", "left_semi").select(order, "key"), "round")
    discard(placed, undecided)
    return walked, rest


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(component, order, keys) sorted by the first two to the dropped orders."""
    taken: set[bytes] = set()
    component = None
    for batch in batches:
        lost = []
        rows = zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
        for i, (here, keys) in enumerate(rows):
            if here != component:
                component, taken = here, set()
            if taken.isdisjoint(keys):
                taken.update(keys)
            else:
                lost.append(i)
        name = batch.schema.names[1]
        yield pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(lost, pa.int64()))], [name])


# ------------------------------------------------------------- true similarity

PART_MEMBERS = 1_024  # documents one task compares with one representative
WALK_SHINGLES = 4_000_000  # shingles of a component that one task walks


def packed_shingles(df: DataFrame, order: str, size: int = 5, column: str = "text") -> DataFrame:
    """(order, set, size): the distinct shingles of each text as sorted 64-bit
    hashes in one binary value."""
    field = df.schema[order]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _slices(batch.column(1).cast(pa.large_string())):
                digests, bounds = shingle_digests(texts, size)
                sets = [np.unique(digests[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [batch.column(0).slice(at, len(texts)), pa.array([s.tobytes() for s in sets], pa.binary())]
                columns.append(pa.array([len(s) for s in sets], pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, [field.name, "set", "size"])
                at += len(texts)

    schema = T.StructType([field]).add("set", "binary").add("size", "integer")
    return df.select(order, tx.or_empty(F.col(column)).alias("_text")).mapInArrow(pack, schema)


def candidate_pairs(keys: DataFrame, order: str) -> DataFrame:
    """(head, order): every document with the first of each bucket it is in.

    A bucket stands for its first document and lists its members, never their
    pairs, so there are at most as many rows as documents times bands. `keys`
    is (order, keys), written.
    """
    rows = _band_rows(keys, order)
    heads = rows.groupBy("key").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    met = _in_bands(rows, heads, order, keys.count())
    return met.filter(F.col(order) != F.col("head")).select("head", order).distinct()


def jaccard(pairs: DataFrame, packed: DataFrame, order: str) -> DataFrame:
    """(head, order, common, total, jaccard) of (head, order) pairs: shingles in
    both texts and in either, and their quotient.

    A representative's set goes once to each task that holds a part of its
    members, however many there are; a task holds one such set at a time.
    """
    dealt = _dealt(materialize(pairs, "pairs"), order)
    return _compared(dealt.join(packed.select(order, "set"), order), "set", order, _unpacked)


def _dealt(pairs: DataFrame, order: str) -> DataFrame:
    """(order, head, _part, _side): who goes to which task. Members have side 1;
    a representative, side 0, goes to every part of its members."""
    parts = pairs.groupBy("head").agg(F.ceil(F.count(F.lit(1)) / PART_MEMBERS).cast("int").alias("_parts"))
    part = F.pmod(F.xxhash64(order), F.col("_parts")).cast("int")
    members = pairs.join(parts, "head").select(order, "head", part.alias("_part"), F.lit(1).alias("_side"))
    each = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part")
    return members.unionByName(parts.select(F.col("head").alias(order), "head", each, F.lit(0).alias("_side")))


def _unpacked(sets: pa.Array) -> Iterator[np.ndarray]:
    return (np.frombuffer(s.as_buffer(), np.uint64) for s in sets)


def _shingled(size: int) -> Callable[[pa.Array], Iterator[np.ndarray]]:
    """Texts to the sorted hashes of their distinct shingles, one after the other."""

    def sets(texts: pa.Array) -> Iterator[np.ndarray]:
        for part in _slices(texts.cast(pa.large_string())):
            digests, bounds = shingle_digests(part, size)
            yield from (np.unique(digests[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True))

    return sets


def _compared(work: DataFrame, column: str, order: str, sets: Callable) -> DataFrame:
    """The rows of `_dealt` with a `column` that `sets` makes sets of, to (head,
    order, common, total, jaccard)."""
    field = work.schema[order]
    work = work.select("head", "_part", "_side", order, column).repartition("head", "_part")
    work = work.sortWithinPartitions("head", "_part", "_side", order)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.zeros(0, np.uint64)
        for batch in batches:
            at, common, total = [], [], []
            for i, (side, other) in enumerate(zip(batch.column(2).to_pylist(), sets(batch.column(4)), strict=True)):
                if side == 0:
                    mine = other.copy()
                    continue
                both = _common(mine, other)
                at.append(i)
                common.append(both)
                total.append(len(mine) + len(other) - both)
            columns = [batch.column(c).take(pa.array(at, pa.int64())) for c in (0, 3)]
            columns += [pa.array(x, pa.int64()) for x in (common, total)]
            yield pa.RecordBatch.from_arrays(columns, ["head", field.name, "common", "total"])

    schema = T.StructType([T.StructField("head", field.dataType), field]).add("common", "long").add("total", "long")
    return work.mapInArrow(compare, schema).withColumn("jaccard", F.col("common") / F.col("total"))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(a) < len(b):
        a, b = b, a
    place = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[place] == b).sum())


def candidate_jaccard(df: DataFrame, order: str, s: Settings = Settings(), column: str = "text") -> DataFrame:
    """(head, order, common, total, jaccard) of every document with the first of
    each bucket it is in: how near candidates are in truth.

    Texts are moved, not their sets, which are larger and do not compress: once
    to their places, once to the tasks that compare them."""
    keys = materialize(with_band_keys(df, order, s, column), "signed")
    pairs = materialize(candidate_pairs(keys, order), "candidates")
    texts = df.select(order, tx.or_empty(F.col(column)).alias("_text"))
    return _compared(_dealt(pairs, order).join(texts, order), "_text", order, _shingled(s.shingle_size))


def lsh_precision(compared: DataFrame, threshold: float) -> DataFrame:
    """One row: candidate pairs, those at or above the threshold, and their share."""
    near = F.count(F.when(F.col("jaccard") >= threshold, 1))
    row = compared.agg(F.count(F.lit(1)).alias("candidates"), near.alias("near"))
    return row.withColumn("precision", F.col("near") / F.nullif("candidates", F.lit(0)))


def dropped_verified(df: DataFrame, order: str, s: Settings = Settings(), column: str = "text") -> DataFrame:
    """The order values that the verified rule drops: an earlier kept document
    shares a band *and* is at least as near as the threshold in truth.

    Copies of a text share its fate or are dropped for it, so they go first.
    Of the rest, components are walked in order against the kept members of
    their buckets; components of more than WALK_SHINGLES shingles take rounds,
    in which every first one of its buckets is compared with their members.
    """
    text = tx.or_empty(F.col(column))
    same = df.select(order, F.unhex(F.sha2(text, 256)).alias("_hash"), text.alias("_text"))
    first = materialize(first_copies(same, order, F.col("_hash")), "firsts")
    lost = same.select(order).join(first, order, "left_anti")
    single = same.join(first, order, "left_semi")
    keys = materialize(with_band_keys(single, order, s, "_text"), "signed")
    rows = _band_rows(keys, order)
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    undecided = materialize(_in_bands(rows, shared, order, keys.count()).select(order, "key"), "round")
    asked = undecided.select(order).distinct()
    packed = packed_shingles(single.join(asked, order, "left_semi"), order, s.shingle_size, "_text")
    packed = materialize(packed, "shingle-sets")

    heads = undecided.groupBy("key").agg(F.min(order).alias("_head"))
    links = undecided.join(heads, "key").select(F.col("_head").alias("u"), F.col(order).alias("v"))
    found = components(links).withColumnsRenamed({"id": order, "component": "_component"})
    placed = materialize(found.join(packed.select(order, "size"), order), "placed")
    sizes = placed.groupBy("_component").agg(F.sum("size").alias("_shingles"))
    small = sizes.filter(F.col("_shingles") <= WALK_SHINGLES).select("_component")
    lists = undecided.groupBy(order).agg(F.collect_list("key").alias("keys"))
    walk = placed.join(small, "_component").join(lists, order).join(packed.select(order, "set"), order)
    walk = walk.select("_component", order, "keys", "set")
    walk = walk.repartition("_component").sortWithinPartitions("_component", order)
    kind = T.StructType([df.schema[order]])
    lost = lost.union(materialize(walk.mapInArrow(_walk_verified(s.minhash_threshold), kind), "walked"))

    rest = placed.join(small, "_component", "left_anti").select(order)
    left = materialize(undecided.join(rest, order, "left_semi"), "round")
    while not left.isEmpty():
        heads = left.groupBy("key").agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("_n"))
        led = heads.groupBy(F.col("head").alias(order)).agg(F.count(F.lit(1)).alias("_led"))
        has = left.groupBy(order).agg(F.count(F.lit(1)).alias("_has"))
        kept = materialize(has.join(led, order).filter("_led = _has").select(F.col(order).alias("head")), "kept")
        pairs = _in_bands(left, heads.join(kept, "head", "left_semi"), order, keys.count())
        pairs = pairs.filter(F.col(order) != F.col("head")).select("head", order).distinct()
        near = jaccard(pairs, packed, order).filter(F.col("jaccard") >= s.minhash_threshold)
        near = materialize(near.select(order).distinct(), "near")
        lost = lost.union(near)
        decided = near.union(kept.select(F.col("head").alias(order)))
        left = materialize(left.join(decided, order, "left_anti"), "round")
    return materialize(lost, "dropped")


def _walk_verified(threshold: float):
    """(component, order, keys, set) sorted by the first two to the dropped orders."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets: dict[bytes, list[int]] = {}
        kept: list[np.ndarray] = []
        component = None
        for batch in batches:
            lost = []
            for i, (here, keys) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if here != component:
                    component, buckets, kept = here, {}, []
                mine = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint64)
                earlier = {k for key in keys for k in buckets.get(key, ())}
                both = [(_common(mine, kept[k]), len(kept[k])) for k in sorted(earlier)]
                if any(c / (len(mine) + n - c) >= threshold for c, n in both):
                    lost.append(i)
                    continue
                for key in keys:
                    buckets.setdefault(key, []).append(len(kept))
                kept.append(mine.copy())
            column = batch.column(1).take(pa.array(lost, pa.int64()))
            yield pa.RecordBatch.from_arrays([column], [batch.schema.names[1]])

    return walk


def deduplicate(
    df: DataFrame, order: str, s: Settings = Settings(), column: str = "text", verify: bool = False
) -> DataFrame:
    """The documents the first-kept rule keeps. Texts move at most once, in the
    last anti-join, and not at all when the dropped ids fit a broadcast.

    verify=True drops a document only where its true Jaccard similarity to a
    kept one of its buckets reaches the threshold."""
    if verify:
        lost = dropped_verified(df, order, s, column)
    else:
        lost = dropped_documents(with_band_keys(df, order, s, column), order)
    return df.join(lost, order, "left_anti")
