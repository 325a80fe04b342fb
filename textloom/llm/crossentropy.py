"""Language-model scores: the cross-entropy difference of a target and a background.

Two bigram models of the same form, Witten-Bell interpolation over add-one
unigrams, are trained on the target documents and on all documents. They share
one vocabulary: all words that occur at least twice in the target, all others being
one unknown word. A document's score is its mean loss per token under the target
less that under the background: low for documents like the target.

In back-off form an interpolated model adds up over the words, contexts and
seen bigrams of a document (log P(w | v) = log P(w) + log bow(v) + the gain of
the bigram), so bigram counts stay sharded over tasks. The words most frequent in
the target, at most VOCABULARY_MOST, are broadcast with what the models say of
them. The others stay in shards: batches are written once with their words and
ask the shards which are in the vocabulary, and under what number; shards of
bigrams ask for their values; and documents get them as they get those of
bigrams, of which a key is two numbers of 32 bits. Bigrams and such words that make up more than
1 / HOT_SHARE of all tokens, at most HOT_SHARE of them, are broadcast too: no
task gathers the postings of a bigram that a third of the documents have.
Scratch space is held down by scoring the shards in PARTS, one after the other.

Counts and scores cover all documents and whole texts. Defined cases: null and
empty texts have 0 tokens (only their end is an event), losses of that event;
repeated rows count and are scored one by one; without target documents the
target model knows nothing and every word is unknown to both; columns other
than id and text are not looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm import postings
from textloom.llm.common import (
    flagged,
    forget,
    group_starts,
    lowered,
    shuffle_partitions,
    sliced,
    stepped,
    whole_groups,
    word_hashes,
    written,
)

VOCABULARY_MOST = 65_000  # words that are broadcast
UNKNOWN = 0
HOT_SHARE = 20_000
SHARD_TOKENS = 2_000_000  # a shard of bigrams has at most about so many, were all distinct
BATCH_BYTES = 1_000_000  # of text, in a task at once; a longer text comes alone
PARTS = 2  # of the shards, scored one after the other: what is sent at once goes by half
KIND = "<u8"
ASK = np.uint32(1 << 31)  # with a word's place among the distinct words that a batch asks for
WORD = np.uint64(0xFFFFFFFF << 32)  # with a word's number: the key of its own value
VALUE = np.dtype([("p", "<f8", 2), ("kinds", "<f8", 2)])


def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, target) to (word, n, in_target), a row per distinct word of a batch."""
    for batch in sliced(batches, "text", BATCH_BYTES):
        words, bounds = word_hashes(lowered(batch.column("text")))
        target = np.repeat(batch.column("target").to_numpy(zero_copy_only=False), np.diff(bounds))
        names, inverse = np.unique(words, return_inverse=True)
        n = np.bincount(inverse, minlength=len(names))
        t = np.bincount(inverse, target, len(names)).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names.view(np.int64)), pa.array(n), pa.array(t)], ["word", "n", "in_target"]
        )


@dataclass(frozen=True)
class Words:
    """The broadcast words: sorted hashes and the number of each (from 1)."""

    hashes: np.ndarray
    numbers: np.ndarray

    @property
    def end(self) -> int:
        return len(self.hashes) + 1

    def encode(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(words), np.int64)
        place = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[place] == words, self.numbers[place], UNKNOWN)


def encoded(words: Words, shards: int, ask: bool) -> Callable:
    """(doc_id, target, text) to batches (role 2: rows, symbols of all tokens) and,
    if there are words besides the broadcast ones, what each batch asks (role 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = postings.batch_ids()
        for batch in sliced(batches, "text", BATCH_BYTES):
            number = next(numbers)
            hashes, bounds = word_hashes(lowered(batch.column("text")))
            symbols = words.encode(hashes).astype("<u4")
            if ask:
                other = np.flatnonzero(symbols == UNKNOWN)
                names, place = np.unique(hashes[other], return_inverse=True)
                symbols[other] = place.astype(np.uint32) | ASK
                rows: list[list] = [[], [], [], [], [], []]
                for shard, at in postings.split(postings.shard_of(names, shards)):
                    values = (shard, 1, number, names[at].tobytes(), at.astype("<u4").tobytes(), b"")
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                yield postings.parcel(rows)
            table = batch.select(["doc_id", "target"]).append_column("tokens", pa.array(np.diff(bounds)))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as stream:
                stream.write_batch(table)
            shard = int(postings.shard_of(np.array([number]), shards)[0])
            yield postings.parcel([[shard], [2], [number], [sink.getvalue().to_pybytes()], [symbols.tobytes()], [b""]])

    return run


def word_parcels(shards: int) -> Callable:
    """(word, number) to parcels (role 0) by shards of the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, numbers = batch.column("word").to_numpy().view(np.uint64), batch.column("number").to_numpy()
            for shard, at in postings.split(postings.shard_of(names, shards)):
                yield postings.parcel([[shard], [0], [0], [names[at].tobytes()], [numbers[at].astype("<u4").tobytes()], [b""]])

    return run


def by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, dict[int, pa.Table]]]:
    """The rows of each shard or batch, by role."""
    for table in whole_groups(batches, [key], 1):
        starts = group_starts(table, [key])
        for a, b in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            part = table.slice(a, b - a)
            roles = part.column("role").to_numpy()
            yield part.column(key)[0].as_py(), {r: part.filter(pa.array(roles == r)) for r in range(4)}


def found(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted are among the sorted names, and whether they are."""
    place = np.minimum(np.searchsorted(names, wanted), max(len(names) - 1, 0))
    return place, (names[place] == wanted if len(names) else np.zeros(len(wanted), bool))


def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a shard and what batches ask of it to the numbers (b) of the
    words (a: places) that are in the vocabulary, by batch (role 1)."""
    for (shard, batch, keys, at), names, numbers in postings.served(batches, KIND, "<u4"):
        place, known = found(names, keys)
        blobs = np.frombuffer(at, "<u4")[known].tobytes(), numbers[place[known]].tobytes()
        yield postings.parcel([[shard], [1], [batch], [b""], *([x] for x in blobs)])


def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches with their answers, sorted by batch, to batches without ASK."""
    for number, parts in by_key(batches, "batch"):
        symbols = postings.gathered(parts[2].column("a"), "<u4").copy()
        asked = np.flatnonzero(symbols & ASK)
        place = symbols[asked] & ~ASK
        numbers = np.full(int(place.max(initial=0)) + 1, UNKNOWN, "<u4")
        numbers[postings.gathered(parts[1].column("a"), "<u4")] = postings.gathered(parts[1].column("b"), "<u4")
        symbols[asked] = numbers[place]
        shard, rows = (parts[2].column(c)[0].as_py() for c in ("shard", "keys"))
        yield postings.parcel([[shard], [2], [number], [rows], [symbols.tobytes()], [b""]])


def events(batch: pa.RecordBatch, row: int, end: int) -> tuple:
    """Of a batch: its rows, and (word, context, has context, text) of every
    event, the end of each text included."""
    table = pa.ipc.open_stream(batch.column("keys")[row].as_buffer()).read_all()
    tokens = table.column("tokens").to_numpy()
    doc = np.repeat(np.arange(len(tokens)), tokens + 1)
    last = np.cumsum(tokens + 1) - 1
    word = np.empty(len(doc), np.int64)
    inner = np.ones(len(doc), bool)
    inner[last] = False
    word[inner] = np.frombuffer(batch.column("a")[row].as_buffer(), "<u4")
    word[last] = end
    context = np.zeros(len(doc), np.int64)
    context[1:] = word[:-1]
    follows = np.ones(len(doc), bool)
    follows[last - tokens] = False
    return table, word, context, follows, doc


def bigram_counts(end: int, shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                table, word, context, follows, doc = events(batch, row, end)
                target = table.column("target").to_numpy()[doc]
                keys = (context << 32 | word)[follows].astype(np.uint64)
                if len(keys):
                    number = batch.column("batch")[row].as_py()
                    yield postings.count_parcels(keys, target[follows], shards, number, KIND)

    return run


def context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard, of every context: tokens and distinct words that follow it, in
    all documents and in the target."""
    for batch in batches:
        for row in range(batch.num_rows):
            keys = np.frombuffer(batch.column("keys")[row].as_buffer(), KIND)
            counts = [np.frombuffer(batch.column(c)[row].as_buffer(), "<i8") for c in ("a", "b")]
            context = (keys >> np.uint64(32)).astype(np.int64)
            names, inverse = np.unique(context, return_inverse=True)
            sums = [np.bincount(inverse, x, len(names)).astype(np.int64) for c in counts for x in (c, c > 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), *map(pa.array, sums)], ["context", "n", "kinds", "t_n", "t_kinds"]
            )


class Model:
    """What both models say about words and contexts, by number."""

    def __init__(self, size: int, total: np.ndarray, unigrams: np.ndarray, contexts: np.ndarray) -> None:
        # unigrams: (words, 2) counts in all documents and in the target;
        # contexts: (words, 4) as from context_rows; size: of the vocabulary.
        self.word = (unigrams + 1) / (total + size)
        self.kinds = contexts[:, [1, 3]].astype(np.float64)
        n = contexts[:, [0, 2]]
        with np.errstate(divide="ignore", invalid="ignore"):
            self.bow = np.where(n > 0, np.log(self.kinds / (n + self.kinds)), 0.0)


def other_values(size: int, total: np.ndarray, shards: int) -> Callable:
    """(number, counts...) of words that are not broadcast to their VALUEs (role 0,
    by number) and what they add as words and contexts (role 3, by key; the
    count and both sums)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("number").to_numpy().astype("<u4")
            counts = np.stack([batch.column(c).to_numpy() for c in OTHER], axis=1)
            model = Model(size, total, counts[:, :2], counts[:, 2:])
            values = np.empty(len(numbers), VALUE)
            values["p"], values["kinds"] = model.word, model.kinds
            for shard, at in postings.split(numbers.astype(np.int64) % shards):
                yield postings.parcel([[shard], [0], [0], [numbers[at].tobytes()], [values[at].tobytes()], [b""]])
            keys = numbers.astype(np.uint64) | WORD
            each = np.log(model.word) + model.bow
            for shard, at in postings.split(postings.shard_of(keys, shards)):
                blobs = (keys[at], each[at], counts[at, 0].astype("<i8"))
                yield postings.parcel([[shard], [3], [0], *([x.tobytes()] for x in blobs)])

    return run


OTHER = ("n", "in_target", "c_n", "c_kinds", "c_t_n", "c_t_kinds")


def value_asks(end: int, shards: int) -> Callable:
    """Bigrams of a shard to the numbers whose values it asks for (role 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, shard = np.zeros(0, np.uint64), None

        def sent() -> Iterator[pa.RecordBatch]:
            numbers = asked[asked > end].astype("<u4")
            for to, at in postings.split(numbers.astype(np.int64) % shards):
                yield postings.parcel([[to], [1], [shard], [numbers[at].tobytes()], [b""], [b""]])

        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column("shard")[row].as_py()
                if here != shard:
                    yield from sent()
                    asked, shard = np.zeros(0, np.uint64), here
                keys = np.frombuffer(batch.column("keys")[row].as_buffer(), KIND)
                asked = np.unique(np.concatenate([asked, keys >> np.uint64(32), keys & np.uint64(0xFFFFFFFF)]))
        yield from sent()

    return run


def value_answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To (role 1) the numbers and VALUEs that each shard of bigrams asked for."""
    for (_, asked_by, keys, _), numbers, values in postings.served(batches, "<u4", VALUE):
        place, known = found(numbers, keys)
        place = place[known]
        blobs = [numbers[place].tobytes()], [values[place].tobytes()], [b""]
        yield postings.parcel([[asked_by], [1], [0], *blobs])


def gain_rows(model: Model, most: int) -> Callable:
    """Bigrams of a shard (role 0), asked values (role 1) and other words (role 3)
    to keys and what each adds to log P under both models (role 0), and those
    with more than `most` occurrences once more (role 4)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in by_key(batches, "shard"):
            keys = postings.gathered(parts[0].column("keys"), KIND)
            counts = [postings.gathered(parts[0].column(c), "<i8") for c in ("a", "b")]
            names, values = (postings.gathered(parts[1].column(c), k) for c, k in (("keys", "<u4"), ("a", VALUE)))
            order = np.argsort(names)
            names, values = names[order], values[order]

            def value(numbers: np.ndarray, field: str, own: np.ndarray, k: int) -> np.ndarray:
                out = own[np.minimum(numbers, len(own) - 1), k]
                other = np.flatnonzero(numbers >= len(own))
                out[other] = values[field][np.searchsorted(names, numbers[other].astype(np.uint32)), k]
                return out

            context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
            gains = []
            for k in (0, 1):
                base = np.maximum(value(context, "kinds", model.kinds, k), 1) * value(word, "p", model.word, k)
                gains.append(np.where(counts[k] > 0, np.log1p(counts[k] / base), 0.0))
            gains = np.stack(gains, axis=1)
            more = postings.gathered(parts[3].column("keys"), KIND)
            each = postings.gathered(parts[3].column("a"), "<f8").reshape(-1, 2)
            n = np.concatenate([counts[0], postings.gathered(parts[3].column("b"), "<i8")])
            keys, gains = np.concatenate([keys, more]), np.concatenate([gains, each])
            order = np.argsort(keys)
            keys, gains, n = keys[order], gains[order], n[order]
            for role, some in ((0, np.ones(len(n), bool)), (4, n > most)):
                columns = [keys[some], *(gains[some, k] for k in (0, 1))]
                yield from postings.pieces(shard, role, columns, postings.model_layout(KIND))

    return run


def as_gains(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return a.view(np.float64), b.view(np.float64)


def score_parcels(end: int, model: Model, hot: tuple[np.ndarray, np.ndarray], shards: int, part: int) -> Callable:
    """Batches to postings of ordinary bigrams and words of the shards of a part,
    and with part 0, per batch, the ids, tokens and what broadcast words, contexts
    and hot keys add."""
    log_word = np.log(model.word)
    hot_keys, hot_gain = hot

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                table, word, context, follows, doc = events(batch, row, end)
                number = batch.column("batch")[row].as_py()
                other = word > end
                keys = (context << 32 | word)[follows].astype(np.uint64)
                keys = np.concatenate([keys, word[other].astype(np.uint64) | WORD])
                owner = np.concatenate([doc[follows], doc[other]])
                homes = postings.shard_of(keys, shards)
                if part == 0:
                    place, known = found(hot_keys, keys)
                    near = np.flatnonzero(follows & (context <= end))
                    own = []
                    for k in (0, 1):
                        each = np.bincount(doc[~other], log_word[word[~other], k], table.num_rows)
                        each += np.bincount(doc[near], model.bow[context[near], k], table.num_rows)
                        each += np.bincount(owner[known], hot_gain[place[known], k], table.num_rows)
                        own.append(each.astype("<f8"))
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, table.schema) as stream:
                        stream.write_table(table)
                    shard = int(postings.shard_of(np.array([number]), shards)[0])
                    yield postings.parcel(
                        [[shard], [2], [number], [sink.getvalue().to_pybytes()], [own[0].tobytes()], [own[1].tobytes()]]
                    )
                    mine = np.flatnonzero(~known & (homes % PARTS == 0))
                else:
                    mine = np.flatnonzero(homes % PARTS == part)
                    mine = mine[~found(hot_keys, keys[mine])[1]]
                if len(mine):
                    yield postings.posting_parcels(keys[mine], owner[mine], shards, number, KIND, homes[mine])

    return run


def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SUMS by batch to (doc_id, n_tokens, target_loss, background_loss, score)."""
    for own, background, target in postings.totals(batches):
        table = pa.ipc.open_stream(own.column("keys")[0].as_buffer()).read_all()
        n = table.num_rows
        tokens = table.column("tokens").to_numpy()
        both = []
        for extra, column in ((background, "a"), (target, "b")):
            logs = np.frombuffer(own.column(column)[0].as_buffer(), "<f8") + extra[:n]
            both.append(-logs / (tokens + 1))
        columns = [table.column("doc_id").combine_chunks(), pa.array(tokens)]
        columns += [pa.array(x) for x in (both[1], both[0], both[1] - both[0])]
        names = ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]
        yield pa.RecordBatch.from_arrays(columns, names)


def vocabulary(counts: DataFrame, most: int) -> tuple[Words, np.ndarray]:
    """The broadcast part of the vocabulary: at most `most` words, those of whole
    counts in the target; and per number (unknown and end left 0) the counts in
    all documents and in the target. From a table of counts by count, so no
    task ranks all words."""
    sizes = counts.filter("in_target > 1").groupBy("in_target").count().orderBy(F.desc("in_target"))
    kept, least = 0, None
    for row in sizes.toLocalIterator():  # one row per distinct count, until the vocabulary is full
        if kept + row["count"] > most:
            break
        kept, least = kept + row["count"], row["in_target"]
    if least is None:
        return Words(np.zeros(0, np.uint64), np.zeros(0, np.int64)), np.zeros((2, 2), np.int64)
    rows = counts.filter(F.col("in_target") >= least).toPandas()  # at most `most`
    hashes = rows["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    unigrams = np.zeros((len(order) + 2, 2), np.int64)
    unigrams[1:-1] = rows[["n", "in_target"]].to_numpy()[order]
    return Words(hashes[order], np.arange(1, len(order) + 1)), unigrams


def numbered(others: DataFrame, first: int, shards: int) -> tuple[DataFrame, int, np.ndarray]:
    """Words that are not broadcast, numbered from `first`, how many there are and
    their counts in all documents and in the target."""
    others = others.withColumn("_shard", F.pmod(F.xxhash64("word"), F.lit(shards)).cast("int"))
    sizes = others.groupBy("_shard").agg(*[x.alias(c) for c, x in (("d", F.count(F.lit(1))), ("n", F.sum("n")), ("t", F.sum("in_target")))])
    sizes = sizes.orderBy("_shard").collect()  # one row per shard
    base, at = [0] * shards, first
    for row in sizes:
        base[row["_shard"]], at = at, at + row["d"]
    place = F.row_number().over(Window.partitionBy("_shard").orderBy("word"))
    number = F.element_at(F.array(*map(F.lit, base)), F.col("_shard") + 1) + place - 1
    others = others.withColumn("number", number.cast("long")).drop("_shard")
    counted = np.array([sum(r["n"] for r in sizes), sum(r["t"] for r in sizes)], np.int64)
    return (stepped(others, "other-words") if sizes else others), at - first, counted


def score(documents: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens, target_loss, background_loss, score per document.
    target: one row per id (id_col) of the target's documents."""
    spark = documents.sparkSession
    ids = target.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = flagged(docs, written(ids, "target-ids"), "doc_id", "target")

    counts = docs.select("text", "target").mapInArrow(tallies, "word long, n long, in_target long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("in_target").alias("in_target"))
    counts = stepped(counts, "word-counts")
    words, unigrams = vocabulary(counts, VOCABULARY_MOST)
    rows = docs.select(F.count(F.lit(1)).alias("d"), F.count_if("target").alias("t")).first()
    tokens = counts.agg(F.sum("n").alias("n"), F.sum("in_target").alias("t")).first()
    all_tokens = np.array([tokens["n"] or 0, tokens["t"] or 0])
    shards = max(shuffle_partitions(spark), int(all_tokens[0]) // SHARD_TOKENS)
    least = int(unigrams[1:-1, 1].min()) if words.end > 1 else None
    others = counts.filter("in_target > 1" if least is None else f"in_target > 1 and in_target < {least}")
    others, n_others, in_others = numbered(others, words.end + 1, shards)
    unigrams[UNKNOWN] = all_tokens - unigrams.sum(axis=0) - in_others
    unigrams[words.end] = rows["d"], rows["t"]
    size, total = words.end + 1 + n_others, all_tokens + [rows["d"], rows["t"]]

    sent = docs.select("doc_id", "target", "text").mapInArrow(encoded(words, shards, n_others > 0), postings.PARCEL)
    texts = stepped(sent, "batches")
    if n_others:
        asked = texts.filter("role = 1").unionByName(others.mapInArrow(word_parcels(shards), postings.PARCEL))
        told = postings.by_shard(asked).mapInArrow(answers, postings.PARCEL)
        work = postings.by_batch(texts.filter("role = 2").unionByName(told))
        asking, texts = texts, stepped(work.mapInArrow(resolved, postings.PARCEL), "numbered-batches")
        forget(asking)
    forget(counts)

    parcels = texts.mapInArrow(bigram_counts(words.end, shards), postings.PARCEL)
    bigrams = stepped(postings.by_shard(parcels).mapInArrow(postings.sum_counts(KIND), postings.PARCEL), "bigrams")
    numbers = ("n", "kinds", "t_n", "t_kinds")
    contexts = bigrams.mapInArrow(context_rows, "context long, " + ", ".join(f"{c} long" for c in numbers))
    contexts = stepped(contexts.groupBy("context").agg(*[F.sum(c).alias(f"c_{c}") for c in numbers]), "contexts")
    near = contexts.filter(F.col("context") <= words.end).toPandas()
    by_number = np.zeros((words.end + 1, 4), np.int64)  # one row per broadcast word
    by_number[near["context"].to_numpy(np.int64)] = near[[f"c_{c}" for c in numbers]].to_numpy(np.int64)
    model = Model(size, total, unigrams, by_number)
    most = max(1, int(all_tokens[0]) // HOT_SHARE)
    work = bigrams
    if n_others:
        values = others.join(contexts.withColumnRenamed("context", "number"), "number", "left").fillna(0)
        values = stepped(values.mapInArrow(other_values(size, total, shards), postings.PARCEL), "word-values")
        asked = bigrams.mapInArrow(value_asks(words.end, shards), postings.PARCEL).unionByName(values.filter("role = 0"))
        told = postings.by_shard(asked).mapInArrow(value_answers, postings.PARCEL)
        work = postings.by_shard(bigrams.unionByName(told).unionByName(values.filter("role = 3")))
    gains = stepped(work.mapInArrow(gain_rows(model, most), postings.PARCEL), "gains")
    forget(bigrams, contexts, *([others, values] if n_others else []))
    hot = gains.filter("role = 4").select("keys", "a", "b").toPandas()  # at most 2 * HOT_SHARE keys
    keys = np.concatenate([np.zeros(0, KIND), *(postings.from_steps(x, KIND) for x in hot["keys"])])
    both = [np.concatenate([np.zeros(0), *(postings.from_planes(x, "<f8") for x in hot[c])]) for c in ("a", "b")]
    order = np.argsort(keys)
    hot = keys[order], np.stack(both, axis=1)[order]

    sums = []
    for part in range(PARTS):
        sent = texts.mapInArrow(score_parcels(words.end, model, hot, shards, part), postings.PARCEL)
        work = postings.by_shard(gains.filter(f"role = 0 and shard % {PARTS} = {part}").unionByName(sent))
        sums.append(stepped(work.mapInArrow(postings.add_up(KIND, as_gains), postings.SUMS), "sums"))
    schema = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    work = postings.by_batch(functools.reduce(DataFrame.unionByName, sums))
    scored = stepped(work.mapInArrow(losses, schema), "losses")
    forget(gains, texts, *sums)
    return scored.withColumnRenamed("doc_id", id_col)
