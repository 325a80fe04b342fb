"""Exact repeats of at least `length` bytes, by threshold-bounded interval
expansion on Burrows-Wheeler transforms.

Of every text, the bytes are removed that some string of `length` bytes covers
which also starts anywhere else. Equal strings have to meet in one task:

* Every window of `length` bytes has an anchor, the smallest hash among its
  GRAM-byte substrings (the leftmost of equals). Equal windows have equal
  anchors at equal places, so only windows of one anchor hash can be equal.
* Anchor hashes that occur once are done. For the others the stretch of text
  that their windows cover (a context) goes to the task of its hash; equal
  contexts go once, with their number.
* A task sorts the suffixes of its contexts, takes the Burrows-Wheeler
  transform, and expands intervals backward, breadth first: level by level a
  queue of intervals yields all places where the common prefix of neighbours is
  exactly that long. It stops at `length`; suffixes that are still together
  share that many bytes. An interval of two or more occurrences is a repeat.

An anchor that very many contexts share is dealt over several tasks; each
reports the hashes of the intervals it has, packed by shards of the hash, and
intervals that two tasks have are repeats too. So nothing grows with one passage's number of copies.

Defined cases: null and empty texts have 0 bytes and keep the hash of the empty
string; texts shorter than `length` are never touched; rows that repeat an id
are texts of their own (equal texts repeat each other); texts of any length are
read whole, in overlapping slices; strings are compared as UTF-8 bytes, and the
remaining text leaves out a character that is cut in two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import (
    BROADCAST_IDS,
    all_spans,
    forget,
    mix,
    prefix_hash,
    shuffle_partitions,
    sliced,
    span_hash,
    stepped,
    utf8,
    whole_groups,
    written,
)

LENGTH = 400
GRAM = 32
SLICE = 1 << 20  # bytes looked at together
PLACE = 24  # bits of a place within a slice
SHARED_MOST = 2_048  # contexts of one anchor that one task takes
POOL = 1_500  # contexts indexed together

ANCHORS = "tkey binary, place long, first long, last long, anchor long"
CONTEXTS = "anchor long, cid binary, context binary, tkey binary, first long, starts long"
FOUND = "cid binary, since long, until long, shard int, strings binary"


# ------------------------------------------------------------- anchors


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, from running minima of blocks."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, place, first, last, hash) of all anchors: windows that start from
    `first` to `last` of a text have their anchor at `place`."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, none
    hashes = all_spans(prefix_hash(raw), min(GRAM, length))
    ranked = hashes >> np.uint64(PLACE) << np.uint64(PLACE)
    ranked |= np.arange(len(hashes), dtype=np.uint64)
    lowest = sliding_min(ranked, length - min(GRAM, length) + 1)
    fits = np.flatnonzero(np.diff(bounds) >= length)
    edge = np.zeros(len(lowest) + 1, np.int8)  # windows lie in a text from its 1 to its -1
    edge[bounds[fits]] = 1
    edge[bounds[fits + 1] - length + 1] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    new = np.ones(len(lowest) + 1, bool)
    new[1:-1] = (lowest[1:] != lowest[:-1]) | (edge[1:-1] != 0)
    head = np.flatnonzero(new[:-1] & inside)
    if not len(head):
        return none, none, none, none, none
    tail = np.flatnonzero(new[1:] & inside)
    where = (lowest[head] & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    doc = np.searchsorted(bounds, head, "right") - 1
    base = bounds[doc]
    return doc, where - base, head - base, tail - base, hashes[where].view(np.int64)


def slices(
    raw: np.ndarray, bounds: np.ndarray, length: int, size: int | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, bounds, first text, offset in it): whole texts together up to
    `size` (SLICE) bytes; a longer one in parts that overlap by length - 1 bytes."""
    size = size or SLICE
    at, n = 0, len(bounds) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        part = raw[bounds[at] : bounds[to]]
        if to == at + 1 and len(part) > size:
            for cut in range(0, len(part) - length + 1, size):
                piece = part[cut : cut + size + length - 1]
                yield piece, np.array([0, len(piece)]), at, cut
        else:
            yield part, bounds[at : to + 1] - bounds[at], at, 0
        at = to


def find_anchors(length: int, size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            raw, bounds = utf8(batch.column("text"))
            keys = batch.column("tkey")
            for piece, cuts, first, offset in slices(raw, bounds, length, size):
                doc, *numbers, hashes = anchors(piece, cuts, length)
                columns = [keys.take(pa.array(doc + first)), *(pa.array(x + offset) for x in numbers), pa.array(hashes)]
                yield pa.RecordBatch.from_arrays(columns, ["tkey", "place", "first", "last", "anchor"])

    return run


def cut_contexts(length: int) -> Callable:
    """(tkey, text, spots) to CONTEXTS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 2 << 20):
            raw, bounds = utf8(batch.column("text"))
            data = raw.tobytes()
            spots = batch.column("spots")
            each = np.diff(spots.offsets.to_numpy())
            flat = spots.flatten()
            doc = np.repeat(np.arange(batch.num_rows), each)
            first, last = flat.field("first").to_numpy(), flat.field("last").to_numpy()
            begin, end = bounds[doc] + first, bounds[doc] + last + length
            texts = [data[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            names = [hashlib.md5(t, usedforsecurity=False).digest() for t in texts]
            columns = [flat.field("anchor"), pa.array(names, pa.binary()), pa.array(texts, pa.binary())]
            columns += [batch.column("tkey").take(pa.array(doc)), pa.array(first), pa.array(last - first + 1)]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CONTEXTS.split(", ")])

    return run


# ------------------------------------------------------------- the index


def place_type(n: int) -> type:
    """The narrower of two integers that numbers n places."""
    return np.int32 if n < 1 << 30 else np.int64


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first `depth` symbols (below 512): a round
    puts as many ranks side by side as 63 bits hold, so two or more times the
    symbols are known; only suffixes that still tie take part in it."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(8, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = key << 9 | padded[i : i + n]
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    bits = (n + 1).bit_length()
    side = 63 // bits
    rank = np.zeros(n + side * depth, place_type(n))  # from 1; 0 past the end
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(1, n + 1), 0))
    known = 7
    while known < depth:
        single = new & np.append(new[1:], True)
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            break
        rows = order[open_at]
        key = rank[rows].astype(np.int64)
        for i in range(1, side):
            key = key << bits | rank[rows + i * known]
        moved = np.argsort(key)
        rows, key = rows[moved], key[moved]
        order[open_at] = rows
        fresh = np.ones(len(rows), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[open_at] = fresh
        rank[rows] = np.maximum.accumulate(np.where(fresh, open_at + 1, 0))
        known *= side
    return order


def expand(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """True where the common prefix with the suffix before is shorter than
    `length`, for every suffix in order.

    Level d holds the intervals of the transform whose left ends are the places
    with a common prefix of exactly d symbols. Prepending a symbol to one maps
    the symbol's first and last occurrence in it to the ends of an interval of
    level d + 1; it is new unless its left end is known from a lower level.
    """
    n = len(order)
    whole = place_type(n)
    transform = symbols[order - 1]  # the symbol before each suffix, cyclic
    by_symbol = np.argsort(transform, kind="stable").astype(whole)
    step = np.empty(n, whole)  # where a suffix goes when its symbol is prepended
    step[by_symbol] = np.arange(n, dtype=whole)
    sorted_symbols = transform[by_symbol]
    same = np.zeros(n + 1, bool)
    same[1:n] = sorted_symbols[1:] == sorted_symbols[:-1]
    earlier = np.full(n, -1, whole)  # the same symbol's last occurrence before
    later = np.full(n, n, whole)
    inner = np.flatnonzero(same)
    earlier[by_symbol[inner]] = by_symbol[inner - 1]
    later[by_symbol[inner - 1]] = by_symbol[inner]

    apart = np.zeros(n, bool)
    left = np.flatnonzero(~same[:n]).astype(whole)
    right = np.append(left[1:], whole(n))
    apart[left] = True
    for _ in range(1, length):
        if not len(left):
            break
        size = right - left
        ends = np.cumsum(size, dtype=whole)
        at = np.repeat(left - (ends - size), size) + np.arange(ends[-1], dtype=whole)
        opens = at[earlier[at] < np.repeat(left, size)]
        closes = at[later[at] >= np.repeat(right, size)]
        begin = np.sort(step[opens])
        end = np.sort(step[closes]) + whole(1)
        new = ~apart[begin]
        left, right = begin[new], end[new]
        apart[left] = True
    return apart


def repeats(contexts: list[bytes], weights: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(context, offset, interval, weight) of every start of a whole string of
    `length` bytes: equal strings share an interval, weight counts them all."""
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    symbols = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int16) + 1
    symbols[ends - 1] = 0
    order = suffix_order(symbols, length)
    apart = expand(symbols, order, length)
    interval = np.cumsum(apart) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)[order]
    offset = order - begins[owner]
    whole = offset + length <= sizes[owner]
    owner, offset, interval = owner[whole], offset[whole], interval[whole]
    total = np.bincount(interval, weights=weights[owner], minlength=1).astype(np.int64)
    return owner, offset, interval, total[interval]


def runs(owner: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring offsets of one context as (context, since, until)."""
    if not len(owner):
        return owner, offset, offset
    by = np.lexsort((offset, owner))
    owner, offset = owner[by], offset[by]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(owner)) - 1
    return owner[head], offset[head], offset[tail] + 1


#: A string of an anchor that is dealt over several tasks: its hash, a context
#: and an offset that have it, and whether it is known to repeat.
STRING = np.dtype([("h1", "<u8"), ("h2", "<u8"), ("cid", "S16"), ("since", "<i8"), ("again", "?")])


def string_hashes(contexts: list[bytes], owner: np.ndarray, offset: np.ndarray, length: int) -> list[np.ndarray]:
    """Two independent 64-bit hashes of the strings at (owner, offset)."""
    raw = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])[owner] + offset
    salted = (prefix_hash(mix(raw.astype(np.uint64) + np.uint64(salt))) for salt in (1_000, 2_000))
    return [span_hash(sums, begin, begin + length) for sums in salted]


def index(length: int, shards: int) -> Callable:
    """(anchor, part, parts, cid, context, n) sorted by anchor and part to FOUND:
    runs of repeated starts of each context (shard null); and for anchors dealt
    over several tasks their distinct strings, packed by shards of the hash."""
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["anchor", "part"], POOL):
            contexts = table.column("context").to_pylist()
            cids = table.column("cid").combine_chunks()
            weights = table.column("n").to_numpy()
            parts = table.column("parts").to_numpy()
            owner, offset, interval, total = repeats(contexts, weights, length)
            again = total > 1
            who, since, until = runs(owner[again], offset[again])
            none = [pa.nulls(len(who), pa.int32()), pa.nulls(len(who), pa.binary())]
            yield pa.RecordBatch.from_arrays([cids.take(pa.array(who)), pa.array(since), pa.array(until), *none], names)
            dealt = parts[owner] > 1
            if dealt.any():
                owner, offset, interval, again = owner[dealt], offset[dealt], interval[dealt], again[dealt]
                _, one = np.unique(interval, return_index=True)
                owner, offset = owner[one], offset[one]
                strings = np.empty(len(one), STRING)
                strings["h1"], strings["h2"] = string_hashes(contexts, owner, offset, length)
                strings["cid"] = np.array(cids.to_pylist(), "S16")[owner]
                strings["since"], strings["again"] = offset, again[one]
                shard = (strings["h1"] >> np.uint64(33)).astype(np.int64) % shards
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order])) + 1
                packed = [(int(shard[at[0]]), strings[at].tobytes()) for at in np.split(order, cuts)]
                blank = [pa.nulls(len(packed), k) for k in (pa.binary(), pa.int64(), pa.int64())]
                numbers, blobs = zip(*packed, strict=True)
                yield pa.RecordBatch.from_arrays([*blank, pa.array(numbers, pa.int32()), pa.array(blobs)], names)

    return run


def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, strings) sorted by shard to (cid, since, until): strings that two
    tasks have, where a task did not know them to repeat."""
    for table in whole_groups(batches, ["shard"], 1):
        strings = np.frombuffer(b"".join(table.column("strings").to_pylist()), STRING)
        order = np.lexsort((strings["h2"], strings["h1"]))
        strings = strings[order]
        same = (strings["h1"][1:] == strings["h1"][:-1]) & (strings["h2"][1:] == strings["h2"][:-1])
        met = np.append(same, False) | np.append(False, same)
        strings = strings[met & ~strings["again"]]
        cids = pa.array([c.ljust(16, b"\0") for c in strings["cid"].tolist()], pa.binary())
        since = strings["since"].astype(np.int64)
        yield pa.RecordBatch.from_arrays([cids, pa.array(since), pa.array(since + 1)], ["cid", "since", "until"])


# ------------------------------------------------------------- the result


def remove(length: int) -> Callable:
    """(tkey, text, spans) to (tkey, n_removed, n_spans, kept_sha256, kept)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4 << 20):
            raw, bounds = utf8(batch.column("text"))
            data = raw.tobytes()
            spans = batch.column("spans")
            cuts = spans.offsets.to_numpy() - spans.offsets[0].as_py()
            flat = spans.flatten()
            since, until = flat.field("since").to_numpy(), flat.field("until").to_numpy()
            out = []
            for d in range(batch.num_rows):
                text = data[bounds[d] : bounds[d + 1]]
                a, b = since[cuts[d] : cuts[d + 1]], until[cuts[d] : cuts[d + 1]] + length - 1
                by = np.argsort(a, kind="stable")
                a, b = a[by], np.maximum.accumulate(b[by])
                new = np.ones(len(a), bool)
                new[1:] = a[1:] > b[:-1]
                head = np.flatnonzero(new)
                a, b = a[head], b[np.append(head[1:], len(b)) - 1]
                edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(text)]
                kept = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(text) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            arrays = [batch.column("tkey"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["tkey", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def deal(pool: DataFrame, sizes: DataFrame) -> DataFrame:
    """Contexts with their anchor's number of parts and their part, those of an
    (anchor, part) together; anchors with one context are left out. Rows move
    once, by both: no task gets all contexts of an anchor that very many have."""
    parts = F.ceil(F.col("_n") / SHARED_MOST).cast("int").alias("parts")
    many = sizes.filter(F.col("_n") > SHARED_MOST).select("anchor", parts)
    small = many.count() <= BROADCAST_IDS
    work = pool.join(F.broadcast(many) if small else many, "anchor", "left")
    work = work.withColumn("parts", F.coalesce("parts", F.lit(1)))
    work = work.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    together = Window.partitionBy("anchor", "part")
    work = work.repartition("anchor", "part").withColumn("_n", F.count(F.lit(1)).over(together))
    return work.filter("parts > 1 or _n > 1").drop("_n").sortWithinPartitions("anchor", "part")


def deduplicate(
    documents: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", texts: bool = False
) -> DataFrame:
    """id_col, n_bytes, n_removed, n_spans, kept_sha256 per document; texts=True
    gives all columns of `documents` and `kept_text` besides."""
    if not 8 <= length <= 440:
        raise ValueError("lengths from 8 to 440 bytes")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    docs = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        text.alias("text"),
        F.unhex(F.md5(F.encode(text, "UTF-8"))).alias("tkey"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    copies = docs.filter(F.col("n_bytes") >= length).groupBy("tkey")
    copies = stepped(copies.agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")), "texts")

    spots = docs.select("tkey", "text").mapInArrow(find_anchors(length, SLICE), ANCHORS)
    # Equal texts have equal rows; an anchor whose windows a slice's edge parts has two, one run together.
    spots = spots.groupBy("tkey", "place").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.first("anchor").alias("anchor")
    )
    spots = stepped(spots, "anchors")
    # Written, so that the join after it may split an anchor that very many texts have.
    twice = spots.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    twice = stepped(twice, "shared-anchors")
    shared = spots.join(twice, "anchor").groupBy("tkey")
    shared = shared.agg(F.collect_list(F.struct("first", "last", "anchor")).alias("spots"))

    # Texts with an anchor that others have too, or with copies: one row each.
    concerned = copies.join(shared, "tkey", "left").filter("spots is not null or copies > 1")
    owner = docs["doc_id"].eqNullSafe(concerned["first"]) & (docs["tkey"] == concerned["tkey"])
    concerned = docs.join(concerned, owner).select(concerned["tkey"], "text", "n_bytes", "copies", "spots")
    concerned = stepped(concerned.dropDuplicates(["tkey"]), "concerned")

    contexts = concerned.filter("spots is not null").select("tkey", "text", "spots")
    contexts = written(contexts.mapInArrow(cut_contexts(length), CONTEXTS), "contexts")
    forget(spots)
    pool = contexts.groupBy("anchor", "cid").agg(
        F.first("context").alias("context"), F.first("starts").alias("starts"), F.count(F.lit(1)).alias("n")
    )
    pool = stepped(pool, "pool")
    # Anchors with more contexts than one task takes, and the one context of an anchor where it repeats.
    sizes = pool.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("_n"), *(F.first(c).alias(c) for c in ("cid", "starts", "n"))
    )
    sizes = stepped(sizes.filter(f"_n > {SHARED_MOST} or (_n = 1 and n > 1)"), "sizes")
    work = deal(pool.drop("starts"), sizes)
    shards = shuffle_partitions(documents.sparkSession)
    found = stepped(work.mapInArrow(index(length, shards), FOUND), "found")
    forget(pool)
    # The one context of an anchor is one interval at every start; it repeats
    # if the context does.
    alone = sizes.filter("_n = 1").select("cid", F.lit(0).cast("long").alias("since"), F.col("starts").alias("until"))

    dealt = found.filter("shard is not null").select("shard", "strings").repartition("shard")
    met = dealt.sortWithinPartitions("shard").mapInArrow(across, "cid binary, since long, until long")
    repeated = found.filter("shard is null").select("cid", "since", "until").unionByName(met).unionByName(alone)
    spans = contexts.select("cid", "tkey", "first").join(repeated, "cid")
    ends = [(F.col("first") + F.col(c)).alias(c) for c in ("since", "until")]
    spans = spans.select("tkey", *ends)
    spans = spans.groupBy("tkey").agg(F.collect_list(F.struct("since", "until")).alias("spans"))

    # A text with copies repeats from its first byte to its last.
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("since"), (F.col("n_bytes") - length + 1).alias("until")))
    spans = concerned.select("tkey", "text", "n_bytes", "copies").join(spans, "tkey", "left")
    spans = spans.withColumn("spans", F.when(F.col("copies") > 1, all_of_it).otherwise(F.col("spans")))
    cleaned = spans.filter("spans is not null").select("tkey", "text", "spans")
    schema = "tkey binary, n_removed long, n_spans long, kept_sha256 string, kept string"
    cleaned = cleaned.mapInArrow(remove(length), schema)
    if not texts:
        base = docs.select("doc_id", "tkey", "n_bytes", F.sha2(F.encode("text", "UTF-8"), 256).alias("whole"))
        joined = base.join(cleaned.drop("kept"), "tkey", "left")
        return joined.select(
            F.col("doc_id").alias(id_col),
            "n_bytes",
            F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        )
    full = documents.withColumn("_tkey", F.unhex(F.md5(F.encode(text, "UTF-8"))))
    cleaned = cleaned.select(F.col("tkey").alias("_tkey"), F.col("kept").alias("_kept"))
    full = full.join(cleaned, "_tkey", "left")
    return full.withColumn("kept_text", F.coalesce("_kept", F.col(text_col))).drop("_tkey", "_kept")
