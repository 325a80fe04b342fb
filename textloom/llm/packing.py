"""Packing of token streams into fixed windows by deficit round-robin over sources.

Every source is a queue of its documents' tokens. Each window adds a quantum to
every queue's deficit, in proportion to the target weights, and each queue
serves the whole tokens it is due, in turn; what is left of a deficit carries
over. So every window holds the target proportions to within a token per queue
until a queue runs out, whose room the others then share. Without weights the
proportions are those of all tokens and no queue runs out before the end.

The served total of a queue after n tokens is a function of n (the rounded
running sum of its quanta), so deficits carry across partitions without one
waiting for another: texts are tokenised once and written where they are, the
token totals per partition and queue place each partition in its queue, and
every document finds its windows by itself. Nothing but those totals moves.

Defined cases: a null text is empty and has only the closing id; a null source
is a queue of its own; rows that repeat an id are packed as documents of their
own; an empty table gives no pieces; texts of any length are cut over as many
windows as needed; more than MAX_QUEUES sources are refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import sliced, written
from textloom.llm.tokens import encoder

WINDOW = 2_048
CLOSING_ID = 1
MAX_QUEUES = 1_024  # fewer than a window has tokens; their totals go to every task
NONE = "(none)"
BLOCK = 1_024  # windows whose schedule is worked out together

TOKENS = "doc_id long, queue string, part int, since long, n long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "queue string, sequence_tokens long, padded_tokens long"
)


def tokenise(path: str, ranks_path: str | None, closing: int) -> Callable:
    """Rows (doc_id, queue, text) to TOKENS: ids as 32-bit numbers, 16-bit where
    the vocabulary fits, and the tokens of its queue before it in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, ranks_path)
        kind = id_type(coder.whole.get_vocab_size(), closing)
        part = TaskContext.get().partitionId()
        before: dict[str, int] = {}
        for batch in sliced(batches, "text", 4 << 20):
            ids, bounds = coder.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], closing).astype(kind)
            bounds = bounds + np.arange(len(bounds))
            n = np.diff(bounds)
            queue = batch.column("queue").dictionary_encode()
            code = queue.indices.to_numpy()
            since = np.empty(len(n), np.int64)
            for k, name in enumerate(queue.dictionary.to_pylist()):
                mine = code == k
                since[mine] = before.get(name, 0) + np.cumsum(n[mine]) - n[mine]
                before[name] = before.get(name, 0) + int(n[mine].sum())
            offsets = pa.array(bounds * kind().itemsize, pa.int64()).buffers()[1]
            data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, offsets, pa.py_buffer(ids)])
            columns = [batch.column("doc_id"), batch.column("queue"), pa.array(np.full(len(n), part, np.int32))]
            columns += [pa.array(since), pa.array(n), data.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "queue", "part", "since", "n", "ids"])

    return run


def id_type(vocabulary: int, closing: int) -> type:
    return np.uint16 if max(vocabulary, closing + 1) <= 1 << 16 else np.uint32


class Schedule:
    """How many tokens of each queue the first n tokens of all windows hold."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int) -> None:
        self.totals, self.weights, self.window = totals, weights.astype(np.float64), window
        self.all = int(totals.sum())
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.longest = float((totals / self.weights).max()) + 1 if len(totals) else 1.0

    def due(self, time: np.ndarray) -> np.ndarray:
        """Whole tokens due to each queue when every one had `time` times its
        weight: the deficits rounded to the nearest token."""
        return np.minimum(np.floor(time[:, None] * self.weights + 0.5), self.totals).astype(np.int64)

    def served(self, windows: np.ndarray) -> np.ndarray:
        """Tokens served per queue before each window, a row per window. Tokens
        that fall due at the same moment go by queue."""
        n = np.minimum(windows * self.window, self.all)
        lo, hi = np.zeros(len(n)), np.full(len(n), self.longest)
        base = self.due(lo)
        for _ in range(80):  # ends sooner unless tokens fall due together
            if (base.sum(axis=1) == n).all():
                break
            mid = (lo + hi) / 2
            due = self.due(mid)
            enough = due.sum(axis=1) > n
            hi = np.where(enough, mid, hi)
            lo = np.where(enough, lo, mid)
            base = np.where(enough[:, None], base, due)
        jump = self.due(hi) - base
        missing = (n - base.sum(axis=1))[:, None]
        earlier = np.cumsum(jump, axis=1) - jump
        return base + np.clip(missing - earlier, 0, jump)

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of BLOCK windows: tokens served before each (one row more), where each
        queue's tokens begin in each, and the tokens of each."""
        if k not in self.blocks:
            if len(self.blocks) >= 64:
                self.blocks.clear()
            served = self.served(np.arange(k * BLOCK, (k + 1) * BLOCK + 1))
            took = np.diff(served, axis=0)
            self.blocks[k] = (served, np.cumsum(took, axis=1) - took, took.sum(axis=1))
        return self.blocks[k]

    def first_window(self, queue: int, position: int) -> int:
        """The window that holds a queue's token: by bisection over blocks,
        from a guess that is right while every queue lasts."""
        last = -(-self.all // self.window) // BLOCK
        k = min(last, int(position / max(int(self.totals[queue]), 1) * self.all / self.window) // BLOCK)
        lo, hi = 0, last
        while lo < hi or lo == k:
            served = self.block(k)[0][:, queue]
            if position < served[0]:
                hi = k - 1
            elif position >= served[-1]:
                lo = k + 1
            else:
                return k * BLOCK + int(np.searchsorted(served, position, "right")) - 1
            k = (lo + hi) // 2
        return k * BLOCK + int(np.searchsorted(self.block(k)[0][:, queue], position, "right")) - 1


def place(schedule: Schedule, names: list[str], kind: type) -> Callable:
    """Rows of TOKENS with `base` to PIECES."""
    number = {name: k for k, name in enumerate(names)}

    def windows_of(queue: int, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Windows that hold tokens [start, end) of a queue: (window, first token
        of the queue in it, its offset there, tokens in the window), and the end."""
        at = schedule.first_window(queue, start) // BLOCK
        out = []
        while True:
            served, inside, size = schedule.block(at)
            out.append((at * BLOCK + np.arange(BLOCK), served[:-1, queue], inside[:, queue], size))
            if served[-1, queue] >= end:
                return tuple(np.concatenate(x) for x in zip(*out, strict=True))
            at += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "ids", 8 << 20):
            queue = np.array([number[q] for q in batch.column("queue").to_pylist()])
            begin = (batch.column("base").to_numpy() + batch.column("since").to_numpy()).astype(np.int64)
            n = batch.column("n").to_numpy()
            for q in np.unique(queue):
                mine = np.flatnonzero(queue == q)
                mine = mine[np.argsort(begin[mine], kind="stable")]
                # Documents of one part follow one another; parts may lie far apart.
                gaps = np.flatnonzero(begin[mine][1:] != (begin + n)[mine][:-1]) + 1
                for rows in np.split(mine, gaps):
                    yield pieces(batch, rows, begin[rows], n[rows], q)

    def pieces(batch: pa.RecordBatch, rows: np.ndarray, begin: np.ndarray, n: np.ndarray, q: int) -> pa.RecordBatch:
        window, first, inside, size = windows_of(q, int(begin[0]), int(begin[-1] + n[-1]))
        cuts = np.unique(np.concatenate([begin, first[(first > begin[0]) & (first < begin[-1] + n[-1])]]))
        ends = np.append(cuts[1:], begin[-1] + n[-1])
        doc = np.searchsorted(begin, cuts, "right") - 1
        # A window without tokens of this queue has the same first token as the next.
        w = np.searchsorted(first, cuts, "right") - 1
        start = cuts - begin[doc]
        length = ends - cuts
        flat = [batch.column("ids")[int(r)].as_buffer() for r in rows]
        crc = np.empty(len(cuts), np.int64)
        here = -1
        for k, (d, a, m) in enumerate(zip(doc.tolist(), start.tolist(), length.tolist(), strict=True)):
            if d != here:
                ids, here = memoryview(np.frombuffer(flat[d], kind).astype("<u4")).cast("B"), d
            crc[k] = zlib.crc32(ids[4 * a : 4 * (a + m)])
        tokens = size[w]
        full = np.where((tokens & (tokens - 1)) == 0, tokens, schedule.window)
        columns = [
            batch.column("doc_id").take(pa.array(rows[doc])),
            *map(pa.array, (start, length, crc, n[doc], window[w], inside[w] + cuts - first[w])),
            pa.array([names[q]] * len(cuts), pa.string()),
            pa.array(tokens),
            pa.array(full),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    return run


def pack(
    documents: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    window: int = WINDOW,
    closing: int = CLOSING_ID,
    weights: Mapping[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """PIECES of all documents. weights: target proportions by source (all
    others weigh `*`, or 1); None takes the proportions of the tokens."""
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit(NONE)).alias("queue"),
        F.col(text_col).cast("string").alias("text"),
    )
    tokens = written(rows.mapInArrow(tokenise(tokenizer, ranks, closing), TOKENS), "tokens")
    sums = written(tokens.groupBy("queue", "part").agg(F.sum("n").alias("sum")), "token-sums")
    totals = sums.groupBy("queue").agg(F.sum("sum").alias("total")).orderBy("queue").limit(MAX_QUEUES + 1).collect()
    if len(totals) > MAX_QUEUES:
        raise ValueError(f"more than {MAX_QUEUES} sources: group them before packing")
    names = [r["queue"] for r in totals]
    total = np.array([r["total"] for r in totals], np.int64)
    if weights is None:
        weight = total
    else:
        weight = np.array([float(weights.get(q, weights.get("*", 1.0))) for q in names])
        if (weight <= 0).any():
            raise ValueError("target weights must be above 0")
        weight = weight / weight.sum() * max(int(total.sum()), 1)
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("queue", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
    kind = id_type(encoder(tokenizer, ranks).whole.get_vocab_size(), closing)
    placed = tokens.join(bases, ["queue", "part"])
    return placed.mapInArrow(place(Schedule(total, weight, window), names, kind), PIECES)
