"""Sums of n-gram values per document, with the values sharded over tasks.

A score that adds up over n-grams needs no task to hold a whole model: a batch
of documents sends, per shard of the n-grams, its distinct n-grams once and for
each of their occurrences the document's number in the batch (two bytes). The
task that has the shard's values adds them up per document and sends sparse
sums back to the batch.

What batches send is laid out for the codec of the shuffle: sorted keys as the
steps between them, and numbers by planes of bytes, so that upper bytes, mostly
the same, stand together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from textloom.llm.common import group_starts, mix, whole_groups

#: role 0: a shard's model (keys, a, b); 1: postings; 2: what a batch adds itself.
PARCEL = "shard int, role int, batch long, keys binary, a binary, b binary"
SUMS = "batch long, role int, keys binary, a binary, b binary"
MOST_DOCS = 1 << 16


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) >> np.uint64(33)).astype(np.int64) % shards


def batch_ids() -> Iterator[int]:
    """Numbers for the batches of this task that no other task has."""
    number = TaskContext.get().partitionId() << 24
    while True:
        yield number
        number += 1


def parcel(columns: list[list]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in PARCEL.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def planes(values: np.ndarray) -> bytes:
    """The first byte of every number, then the second of every one, and so on."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: pa.Buffer | bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def steps(keys: np.ndarray, kind: str) -> bytes:
    """Ascending keys."""
    keys = keys.astype(kind)
    return planes(np.diff(keys, prepend=keys.dtype.type(0)))


def from_steps(data: pa.Buffer | bytes, kind: str) -> np.ndarray:
    return np.cumsum(from_planes(data, kind), dtype=kind)


def count_parcels(keys: np.ndarray, second: np.ndarray, shards: int, batch: int, kind: str) -> pa.RecordBatch:
    """Distinct keys with their counts, and those where `second` holds, by shard."""
    order = np.argsort(keys, kind="stable")
    keys, second = keys[order], second[order]
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    counts = np.diff(np.append(head, len(keys))).astype("<u4")
    marked = np.add.reduceat(second.astype(np.uint32), head).astype("<u4") if len(head) else counts
    keys = keys[head]
    rows = [[], [], [], [], [], []]
    for shard, at in split(shard_of(keys, shards)):
        for column, value in zip(
            rows,
            (shard, 1, batch, steps(keys[at], kind), planes(counts[at]), planes(marked[at])),
            strict=True,
        ):
            column.append(value)
    return parcel(rows)


def posting_parcels(
    keys: np.ndarray, docs: np.ndarray, shards: int, batch: int, kind: str, homes: np.ndarray | None = None
) -> pa.RecordBatch:
    """Distinct keys with their counts, and the documents of each, by shard;
    homes: the shard of each key, where it is not the key's own."""
    order = np.argsort(keys, kind="stable")
    homes = shard_of(keys, shards) if homes is None else homes
    homes = homes[order]
    keys, docs = keys[order], docs[order].astype("<u2")
    head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    counts = np.diff(np.append(head, len(keys)))
    rows = [[], [], [], [], [], []]
    for shard, at in split(homes[head]):
        c = counts[at]
        spots = np.repeat(head[at], c) + np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
        values = (shard, 1, batch, steps(keys[head[at]], kind), planes(c.astype("<u4")), planes(docs[spots]))
        for column, value in zip(rows, values, strict=True):
            column.append(value)
    return parcel(rows)


def split(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(value, where it stands) for each value, places in their order."""
    order = np.argsort(group, kind="stable")
    cuts = np.flatnonzero(np.diff(group[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(group[part[0]]), part


#: Keys in a row of counts or values: rows of some 100 KB a column, as larger ones
#: are allocated apart by the JVM and make its heap grow.
PIECE = 1 << 14


def pieces(shard: int, role: int, columns: list[np.ndarray], layout: Callable) -> Iterator[pa.RecordBatch]:
    """Columns as rows of PIECE entries, numbered by `batch`; layout: of the
    columns of a piece, as bytes."""
    for number, at in enumerate(range(0, len(columns[0]), PIECE)):
        blobs = layout(*(c[at : at + PIECE] for c in columns))
        yield parcel([[shard], [role], [number], *([x] for x in blobs)])


def model_layout(kind: str) -> Callable:
    """What add_up takes for a model."""
    return lambda keys, a, b: (steps(keys, kind), planes(a), planes(b))


#: Entries of parcels that wait for a merge, beside as many as are merged already.
PENDING = 1 << 19


def sum_counts(kind: str) -> Callable:
    """Parcels of counts, sorted by shard, to rows (role 0) per shard. Parcels
    are merged as they come: a task holds a shard's distinct keys twice over,
    however many batches have them."""

    def merged(parts: list[tuple]) -> list[tuple]:
        keys, *counts = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")  # of sorted runs
        keys = keys[order]
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        return [(keys[head], *(np.add.reduceat(c[order], head) for c in counts))] if len(keys) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, waiting = None, [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            for done in merged(parts) if parts else []:
                yield from pieces(shard, 0, done, lambda *columns: [x.tobytes() for x in columns])

        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column("shard")[row].as_py()
                if here != shard:
                    if shard is not None:
                        yield from finished()
                    shard, parts, waiting = here, [], 0
                keys, *counts = (batch.column(c)[row].as_buffer() for c in ("keys", "a", "b"))
                part = from_steps(keys, kind), *(from_planes(c, "<u4").astype("<i8") for c in counts)
                parts.append(part)
                waiting += len(part[0])
                if waiting > max(PENDING, len(parts[0][0])):
                    parts, waiting = merged(parts), 0
        if shard is not None:
            yield from finished()

    return run


def served(batches: Iterator[pa.RecordBatch], kind: str, value: np.dtype | str) -> Iterator[tuple]:
    """Values of a shard (role 0: keys, a) and what is asked of it (role 1), sorted
    by shard and role: per request its row as (shard, batch, keys, a), and the
    shard's sorted keys and values. A request is held by itself."""
    shard, parts, names, values = None, [], np.zeros(0, kind), np.zeros(0, value)
    for batch in batches:
        for row in range(batch.num_rows):
            here, role, number = (batch.column(c)[row].as_py() for c in ("shard", "role", "batch"))
            keys, a = (batch.column(c)[row].as_buffer() for c in ("keys", "a"))
            if here != shard:
                shard, parts, names, values = here, [], np.zeros(0, kind), np.zeros(0, value)
            if role == 0:
                parts.append((np.frombuffer(keys, kind).copy(), np.frombuffer(a, value).copy()))
                continue
            if parts:
                names, values = (np.concatenate(c) for c in zip(*parts, strict=True))
                order = np.argsort(names)
                names, values, parts = names[order], values[order], []
            yield (shard, number, np.frombuffer(keys, kind), a), names, values


def gathered(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    parts = [np.frombuffer(x.as_buffer(), kind) for x in column if x.as_py() is not None]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def add_up(kind: str, values: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> Callable:
    """A shard's model (keys as steps, a and b as planes of 64 bits) and postings,
    sorted by shard and role, to SUMS: per batch the documents met (role 1) and
    the sums of their two values. values: from (keys, a, b) of the model to the
    two values of each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, one, two, shard, parts = np.zeros(0, kind), np.zeros(0), np.zeros(0), None, []
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row in range(batch.num_rows):
                here, role, number = (batch.column(c)[row].as_py() for c in ("shard", "role", "batch"))
                blobs = [batch.column(c)[row] for c in ("keys", "a", "b")]
                if here != shard:
                    names, one, two, shard, parts = np.zeros(0, kind), np.zeros(0), np.zeros(0), here, []
                if role == 0:
                    kinds = ((from_steps, kind), (from_planes, "<i8"), (from_planes, "<i8"))
                    parts.append([f(x.as_buffer(), k) for x, (f, k) in zip(blobs, kinds, strict=True)])
                    continue
                if parts:
                    names, *both = (np.concatenate(x) for x in zip(*parts, strict=True))
                    (one, two), parts = values(names, *both), []
                if role == 2:
                    new = [number, 0, *(x.as_py() for x in blobs)]
                else:
                    keys = from_steps(blobs[0].as_buffer(), kind)
                    counts, docs = (from_planes(x.as_buffer(), k) for x, k in zip(blobs[1:], ("<u4", "<u2"), strict=True))
                    place = np.minimum(np.searchsorted(names, keys), max(len(names) - 1, 0))
                    known = names[place] == keys if len(names) else np.zeros(len(keys), bool)
                    sums = []
                    for value in (one, two):
                        each = np.zeros(len(keys))
                        each[known] = value[place[known]]
                        sums.append(np.bincount(docs, np.repeat(each, counts)))
                    some = np.flatnonzero((sums[0] != 0) | (sums[1] != 0))
                    new = [number, 1, some.astype("<u2").tobytes(), *(s[some].tobytes() for s in sums)]
                for column, value in zip(out, new, strict=True):
                    column.append(value)
            if out[0]:
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [c.split()[0] for c in SUMS.split(", ")]
                )

    return run


def by_shard(parcels: DataFrame) -> DataFrame:
    return parcels.repartition("shard").sortWithinPartitions("shard", "role", "batch")


def by_batch(sums: DataFrame) -> DataFrame:
    return sums.repartition("batch").sortWithinPartitions("batch", "role")


def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Per batch its own row (role 0) and the sums of its documents' values."""
    for table in whole_groups(batches, ["batch"], 1):
        starts = group_starts(table, ["batch"])
        for a, b in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            part = table.slice(a, b - a)
            sums = np.zeros((2, MOST_DOCS))
            for row in range(1, part.num_rows):
                docs = np.frombuffer(part.column("keys")[row].as_buffer(), "<u2")
                for k, c in enumerate(("a", "b")):
                    sums[k, docs] += np.frombuffer(part.column(c)[row].as_buffer(), "<f8")
            yield part.slice(0, 1), sums[0], sums[1]
