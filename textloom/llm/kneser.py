"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model.

The model is trained on trusted documents. Documents are scored by their mean
loss per event (words and the end), and kept up to a quantile, by language, of
the losses of trusted documents that the model was not trained on.

The model is counted over all trusted documents outside the held-out share.
Trigrams (u, v, w) are sharded by their middle word, so that a shard has all that
their probabilities need but how often w follows anything: the counts of its
trigrams, the contexts (u, v), the bigrams (v, w) and what follows v. For w, shards
ask its owner once per word. A middle word with more than a share of a shard is
parted by u; its bigrams are then summed and valued by the owner of w, and what
follows it is summed over all owners and broadcast. Counts are written once, with
the words of a shard as a dictionary and n-grams as places in it. Nothing derived
from them is written: the task that scores a shard makes its probabilities.

A batch of documents sends its distinct trigrams to their shards, most words as
numbers of a broadcast code of bounded size, and gets sums back, in back-off form: the middle word's own gain, and those of the bigram, the
context and the trigram that were seen. Shards are scored in PARTS, one after the
other, so that only a part of the shuffled n-grams takes disk at a time.

Held out by a hash of the id are HELD_MOST trusted documents, but at most a half
and at least a tenth of all; every document is scored, whole. Defined cases: a
null or empty text is the end alone; null languages are a group of their own;
a language with fewer than LEAST held-out trusted documents takes the quantile
of all languages together, and with none at all everything is kept; repeated
rows are scored one by one; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import postings
from textloom.llm.common import (
    BROADCAST_IDS,
    forget,
    group_starts,
    lowered,
    mix,
    shuffle_partitions,
    sliced,
    stepped,
    whole_groups,
    word_hashes,
    written,
)

HELD_MOST = 2_000
QUANTILE = 0.98
LEAST = 50
PARTS = 4  # of the shards, scored one after the other
HOT_SHARE = 20_000  # words with less than this part of all tokens are never parted
SPLIT = 4  # a middle word is parted from this part of a shard on
CODED = 1 << 18  # words at most that batches to be scored name by a number, of 2 MB in all
TEXT_BYTES = 4 << 20  # of text, counted or scored together
KIND = "<u8"
BEGIN = np.uint64(0x0B0E0B0E0B0E0B0E)
END = np.uint64(0x0E0D0E0D0E0D0E0D)
NONE = "(none)"


# ---------------------------------------------------------------- events


def events(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Words as sorted hashes; (w, v, u, text) of every word and end as places in
    them, begins filled in; and the tokens of each text."""
    hashes, bounds = word_hashes(lowered(texts))
    tokens = np.diff(bounds)
    names, places = np.unique(np.append(hashes, [BEGIN, END]), return_inverse=True)
    begin, end = places[-2:]
    doc = np.repeat(np.arange(len(tokens)), tokens + 1)
    last = np.cumsum(tokens + 1) - 1
    first = last - tokens
    inner = np.ones(len(doc), bool)
    inner[last] = False
    w = np.empty(len(doc), np.int64)
    w[inner], w[last] = places[:-2], end
    v, u = np.empty_like(w), np.empty_like(w)
    v[1:], u[2:] = w[:-1], w[:-2]
    v[first] = begin
    u[first] = begin
    second = (first + 1)[tokens > 0]
    u[second] = begin
    return names, w, v, u, doc, tokens


def find(names: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key in sorted names, and whether it is there."""
    if not len(names):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return place, names[place] == keys


class Hot:
    """Words whose trigrams are parted by their first word, with the number of
    their parts, sorted; begin and end are among them, with no parts."""

    def __init__(self, words: np.ndarray, parts: np.ndarray) -> None:
        self.words, self.parts = words, parts

    def number(self, names: np.ndarray) -> np.ndarray:
        """1 and on for words that are parted, else 0."""
        place, known = find(self.words, names)
        return np.where(known & (self.parts[place] > 0), place + 1, 0)

    def homes(self, names: np.ndarray, v: np.ndarray, u: np.ndarray, shards: int) -> np.ndarray:
        """The shard of each trigram."""
        number = self.number(names)
        home = postings.shard_of(names, shards)[v]
        at = np.flatnonzero(number[v])
        if len(at):
            middle = v[at]
            part = mix(names[u[at]]) % self.parts[number[middle] - 1]
            home[at] = postings.shard_of(mix(names[middle] + np.uint64(1) + part), shards)
        return home


def frequent(share: int) -> Callable:
    """(text) to the words of a batch that may be above the share of all, and its
    events (a null word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", TEXT_BYTES):
            hashes, bounds = word_hashes(lowered(batch.column("text")))
            names, n = np.unique(hashes, return_counts=True)
            some = n * 2 * share > len(hashes)
            words = [*names[some].view(np.int64).tolist(), None]
            counts = [*n[some].tolist(), len(hashes) + batch.num_rows]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(counts, pa.int64())], ["word", "n"])

    return run


def hot_words(texts: DataFrame, shards: int) -> Hot:
    """Which words those are decides where n-grams are counted, not what is counted."""
    share = min(HOT_SHARE, SPLIT * shards)
    counts = texts.mapInArrow(frequent(share), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stepped(counts, "frequent")
    total = counts.filter("word is null").agg(F.sum("n")).first()[0] or 0
    rows = counts.filter("word is not null").filter(F.col("n") * share > total).toPandas()  # fewer than `share`
    forget(counts)
    words = rows["word"].to_numpy(np.int64).view(np.uint64)
    parts = -(-rows["n"].to_numpy(np.int64) * SPLIT * shards // max(1, total))
    words, first = np.unique(np.concatenate([[BEGIN, END], words]), return_index=True)
    return Hot(words, np.concatenate([[0, 0], parts])[first].astype(np.uint64))


# ---------------------------------------------------------------- trigrams as parcels

#: A trigram's count, the upper bit set where the bigram it ends with is new.
NEW = np.uint32(1 << 31)


def ordered(size: int, v: np.ndarray, w: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigrams by v, w and u: their order, and where a bigram and where a trigram begins."""
    bits = max(1, int(size).bit_length())
    if 3 * bits < 64:
        two = (v << bits) | w
        key = (two << bits) | u
        order = np.argsort(key, kind="stable")
        two, key = two[order], key[order]
        new = np.append(True, two[1:] != two[:-1])[: len(v)]
        return order, new, np.append(True, key[1:] != key[:-1])[: len(v)]
    order = np.lexsort((u, w, v))
    u, two = u[order], (v << 32 | w)[order]
    new = np.append(True, two[1:] != two[:-1])[: len(v)]
    return order, new, new | np.append(True, u[1:] != u[:-1])[: len(v)]


class Names:
    """Words of a batch, those of the code first: they travel as places in it."""

    def __init__(self, names: np.ndarray, code: np.ndarray) -> None:
        place, known = find(code, names)
        order = np.argsort(~known, kind="stable")
        self.names, self.coded = names[order], place[order][: int(known.sum())]
        self.rank = np.empty(len(names), np.int64)  # where each word is now
        self.rank[order] = np.arange(len(names))

    def blob(self, used: np.ndarray) -> bytes:
        """Ascending places in names."""
        n = int(np.searchsorted(used, len(self.coded)))
        coded, rest = self.coded[used[:n]], self.names[used[n:]]
        return np.array([n], "<u4").tobytes() + postings.steps(coded, "<u4") + postings.steps(rest, KIND)


NO_CODE = np.zeros(0, KIND)


def named(keys: pa.Buffer, code: np.ndarray) -> np.ndarray:
    n = int(np.frombuffer(keys, "<u4", 1)[0])
    coded = postings.from_steps(keys.slice(4, 4 * n), "<u4")
    return np.concatenate([code[coded], postings.from_steps(keys.slice(4 + 4 * n), KIND)])


def packed(names: Names, v: np.ndarray, w: np.ndarray, u: np.ndarray, n: np.ndarray | None = None) -> tuple:
    """Trigrams (places in names) as the blobs of a parcel, equal ones together,
    with the sums of n, else their number: the words in use, and bigrams and
    trigrams as places among them; and the order of the trigrams."""
    used, local = np.unique(np.concatenate([v, w, u]), return_inverse=True)
    v, w, u = np.split(local, 3)
    order, two, three = ordered(len(used), v, w, u)
    head = np.flatnonzero(three)
    counts = np.diff(np.append(head, len(u))) if n is None else np.add.reduceat(n[order], head)
    counts = counts.astype("<u4")
    counts[two[head]] |= NEW
    begins = order[two]
    columns = [np.diff(v[begins], prepend=0), w[begins], u[order[head]], counts]
    sizes = np.array([len(begins), len(head)], "<u4").tobytes()
    return names.blob(used), b"".join([sizes, *(postings.planes(c.astype("<u4")) for c in columns)]), order


class Trigrams:
    """What `packed` has: names; v and w of each bigram; of each trigram its
    bigram (owner), u and count n."""

    def __init__(self, keys: pa.Buffer, a: pa.Buffer, code: np.ndarray = NO_CODE) -> None:
        self.names = named(keys, code)
        n2, n3 = np.frombuffer(a, "<u4", 2).tolist()
        ends = 8 + 4 * np.cumsum([0, n2, n2, n3, n3])
        v, w, u, n = (postings.from_planes(a.slice(x, y - x), "<u4") for x, y in zip(ends.tolist(), ends[1:].tolist()))
        self.v, self.w, self.u = np.cumsum(v, dtype=np.int64), w.astype(np.int64), u.astype(np.int64)
        self.owner, self.n = np.cumsum(n >= NEW) - 1, (n & ~NEW).astype(np.int64)

    def kinds(self) -> np.ndarray:
        """Below the highest order a count is in how many contexts a bigram was
        seen; what begins a text has one context only and keeps its own count."""
        begins = (self.names == BEGIN)[self.v]
        each = np.where(begins[self.owner], self.n, 1)
        return np.bincount(self.owner, each, len(self.v)).astype(np.int64)


def parsed(batch: pa.RecordBatch | pa.Table, row: int) -> Trigrams:
    return Trigrams(*(batch.column(c)[row].as_buffer() for c in ("keys", "a")))


def filled(rows: list[tuple]) -> pa.RecordBatch:
    """(shard, role, batch, keys, a, b) rows as parcels."""
    return postings.parcel([list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], [], [], []])


def trigram_parcels(hot: Hot, shards: int) -> Callable:
    """(text) to the distinct trigrams of a batch, by shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = postings.batch_ids()
        for batch in sliced(batches, "text", TEXT_BYTES):
            number = next(numbers)
            names, w, v, u, _, _ = events(batch.column("text"))
            homes = hot.homes(names, v, u, shards)
            names = Names(names, NO_CODE)
            rows = []
            for shard, at in postings.split(homes):
                keys, a, _ = packed(names, v[at], w[at], u[at])
                rows.append((shard, 1, number, keys, a, b""))
            yield filled(rows)

    return run


def by_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    for table in whole_groups(batches, ["shard"], 1):
        starts = group_starts(table, ["shard"])
        for a, b in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            yield table.column("shard")[int(a)].as_py(), table.slice(a, b - a)


def sum_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parcels of trigrams, sorted by shard, to one row (role 0) per shard."""
    for shard, part in by_shards(batches):
        each = [parsed(part, row) for row in range(part.num_rows)]
        names = np.unique(np.concatenate([x.names for x in each]))
        columns: list[list] = [[], [], [], []]
        for x in each:
            to = np.searchsorted(names, x.names)
            for column, value in zip(columns, (to[x.v][x.owner], to[x.w][x.owner], to[x.u], x.n), strict=True):
                column.append(value)
        keys, a, _ = packed(Names(names, NO_CODE), *map(np.concatenate, columns))
        yield filled([(shard, 0, 0, keys, a, b"")])


# ---------------------------------------------------------------- how often words follow others


def often(counts: np.ndarray) -> list[int]:
    """How many counts are 1 to 4, and how many there are."""
    return [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), len(counts)]


SHARD_STATS = [*(f"three{k}" for k in (1, 2, 3, 4)), "kinds3", *(f"two{k}" for k in (1, 2, 3, 4)), "kinds2"]
SHARD_STATS += ["after_begin", "begin1", "begin2", "begin3"]


def shard_stats(hot: Hot) -> Callable:
    """Of counted shards: trigrams by count, bigrams that are not parted by count,
    and what follows the begin of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = parsed(batch, row)
                counts = x.kinds()
                whole = hot.number(x.names)[x.v] == 0
                begins = counts[(x.names == BEGIN)[x.v]]
                values = [*often(x.n), *often(counts[whole]), *following(begins)]
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.int64()) for y in values], SHARD_STATS)

    return run


def following(counts: np.ndarray) -> list[int]:
    """All of the counts, and how many are 1, 2 and more."""
    return [int(counts.sum()), int((counts == 1).sum()), int((counts == 2).sum()), int((counts > 2).sum())]


class Asked:
    """What a shard asks the owners of its words, by owner and word: per word how
    many words that are not parted it follows (hot 0), and per bigram of a parted
    word its count here (hot: the number of that word)."""

    def __init__(self, x: Trigrams, counts: np.ndarray, hot: Hot, shards: int) -> None:
        number = hot.number(x.names)[x.v]
        self.words = np.flatnonzero(np.bincount(x.w, minlength=len(x.names)))
        self.parted = np.flatnonzero(number)
        follows = np.bincount(x.w[number == 0], minlength=len(x.names))
        word = np.concatenate([self.words, x.w[self.parted]])
        which = np.concatenate([np.zeros(len(self.words), np.int64), number[self.parted]])
        n = np.concatenate([follows[self.words], counts[self.parted]])
        owner = postings.shard_of(x.names, shards)[word]
        self.order = np.lexsort((which, word, owner))
        self.owner, self.hot, self.n = owner[self.order], which[self.order], n[self.order]
        self.word = x.names[word[self.order]]

    def answered(self, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of `words` and of `parted`."""
        values = np.empty(len(self.order), np.int64)
        values[self.order] = answers
        return values[: len(self.words)], values[len(self.words) :]


def requests(hot: Hot, shards: int) -> Callable:
    """Counted shards to what they ask, by owners; batch: the shard that asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x = parsed(batch, row)
                asked = Asked(x, x.kinds(), hot, shards)
                rows = []
                for owner, at in postings.split(asked.owner):
                    which, n = postings.planes(asked.hot[at].astype("<u2")), postings.planes(asked.n[at].astype("<u4"))
                    number = batch.column("shard")[row].as_py()
                    rows.append((owner, 1, number, postings.steps(asked.word[at], KIND), which, n))
                yield filled(rows)

    return run


def owners(hot: Hot) -> Callable:
    """Requests, sorted by owner, to answers (role 1) by the shard that asked, in
    its order: for a word how many words it follows, for a bigram its count. And
    per owner its words with their counts, and those of the bigrams of parted words
    that end with them (role 2), and statistics (role 3)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, part in by_shards(batches):
            blobs = [[part.column(c)[row].as_buffer() for c in ("keys", "a", "b")] for row in range(part.num_rows)]
            words = [postings.from_steps(x[0], KIND) for x in blobs]
            cuts = np.cumsum([len(x) for x in words])[:-1]
            word = np.concatenate(words)
            which = np.concatenate([postings.from_planes(x[1], "<u2") for x in blobs]).astype(np.int64)
            n = np.concatenate([postings.from_planes(x[2], "<u4") for x in blobs]).astype(np.int64)
            order = np.lexsort((which, word))
            fresh = np.append(True, word[order][1:] != word[order][:-1])
            new = fresh | np.append(True, which[order][1:] != which[order][:-1])
            head = np.flatnonzero(new)
            sums = np.add.reduceat(n[order], head)
            kind, name = which[order][head], np.cumsum(fresh)[head] - 1
            # A parted word counts once for what it is followed by.
            follows = np.bincount(name, np.where(kind == 0, sums, 1)).astype(np.int64)
            result = np.empty(len(word), np.int64)
            result[order] = np.where(kind == 0, follows[name], sums)[np.cumsum(new) - 1]
            names = word[order][fresh]
            rows = [
                (int(to), 1, shard, b"", postings.planes(x.astype("<u4")), b"")
                for to, x in zip(part.column("batch").to_pylist(), np.split(result, cuts), strict=True)
            ]
            bigrams = sums[kind > 0]
            columns = (name[kind > 0], "<u4"), (kind[kind > 0], "<u2"), (bigrams, "<u4")
            pairs = b"".join(postings.planes(c.astype(k)) for c, k in columns)
            rows.append((shard, 2, 0, postings.steps(names, KIND), postings.planes(follows.astype("<u4")), pairs))
            all_of_it = [*often(follows), int(follows.sum()), *often(bigrams), int(follows[names == END].sum())]
            table = [[0, *all_of_it]]
            behind = kind[kind > 0]
            for number, at in postings.split(behind):
                table.append([number, *following(bigrams[at]), 0, *[0] * 7])
            numbers = hot.number(names)
            table += [[int(numbers[k]), 0, 0, 0, 0, int(follows[k]), *[0] * 7] for k in np.flatnonzero(numbers)]
            rows.append((shard, 3, 0, b"", np.array(table, "<i8").tobytes(), b""))
            yield filled(rows)

    return run


OWNER_STATS = ["hot", *(f"x{k}" for k in range(12))]


def owner_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            table = np.frombuffer(batch.column("a")[row].as_buffer(), "<i8").reshape(-1, len(OWNER_STATS))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T.copy()], OWNER_STATS)


def owned_words(test: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names = postings.from_steps(batch.column("keys")[row].as_buffer(), KIND)
                columns = test(names, postings.from_planes(batch.column("a")[row].as_buffer(), "<u4").astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "n"])

    return run


MOST_FOLLOWED = 1 << 12


def word_code(answers: DataFrame) -> np.ndarray:
    """At most CODED words, those that follow the most others, sorted: whole
    counts, so that no task ranks all words. It decides what is sent, not what it is worth."""

    def sizes(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = np.bincount(np.minimum(n, MOST_FOLLOWED), minlength=MOST_FOLLOWED + 1)
        return np.arange(len(each)), each

    owned = answers.filter("role = 2")
    rows = owned.mapInArrow(owned_words(sizes), "word long, n long").groupBy("word").agg(F.sum("n")).collect()
    table = np.zeros(MOST_FOLLOWED + 1, np.int64)
    for n, words in rows:  # MOST_FOLLOWED + 1 at most
        table[n] = words
    least = int(np.searchsorted(-np.cumsum(table[::-1])[::-1], -CODED))  # the first whose words and all above fit

    def most(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return names[n >= least].view(np.int64), n[n >= least]

    if least > MOST_FOLLOWED:
        return NO_CODE
    return np.sort(owned.mapInArrow(owned_words(most), "word long, n long").toPandas()["word"].to_numpy(np.int64).view(np.uint64))


def discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ from how many n-grams were seen 1 to 4 times."""
    if not n[0] or not n[1]:
        return [0.5, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    out = [k + 1 - (k + 2) * y * (n[k + 1] / n[k] if n[k] else 0) for k in range(3)]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(out)]


def less(d: list[float], n: np.ndarray) -> np.ndarray:
    """What is taken off each count."""
    return np.array([0.0, *d])[np.minimum(n, 3)]


# ---------------------------------------------------------------- the model


class Trained:
    """The counts in shards, and the few numbers every task gets."""

    def __init__(self, three: DataFrame, answers: DataFrame, hot: Hot, shards: int) -> None:
        self.three = three  # PARCEL, role 0: the trigrams of a shard
        self.answers = answers  # PARCEL, roles 1 and 2: what words follow, for each shard
        self.hot, self.shards, self.code = hot, shards, word_code(answers)
        stats = three.mapInArrow(shard_stats(hot), ", ".join(f"{c} long" for c in SHARD_STATS))
        sums = [x or 0 for x in stats.agg(*[F.sum(c) for c in SHARD_STATS]).first()]
        owned = answers.filter("role = 3").mapInArrow(owner_stats, ", ".join(f"{c} long" for c in OWNER_STATS))
        owned = owned.groupBy("hot").agg(*[F.sum(c).alias(c) for c in OWNER_STATS[1:]])
        rows = {r[0]: list(r[1:]) for r in owned.collect()}  # a row per parted word
        words = rows.pop(0, [0] * 12)
        self.d1 = discounts(words[:4])
        self.d2 = discounts([a + b for a, b in zip(sums[5:9], words[6:10], strict=True)])
        self.d3 = discounts(sums[:4])
        self.total, kinds = words[5] or 1, words[4] + 1  # and the unknown word
        once, twice = words[:2]
        mass = self.d1[0] * once + self.d1[1] * twice + self.d1[2] * (words[4] - once - twice) or self.total
        self.base = mass / self.total / kinds
        self.unknown = float(np.log(self.base))
        # What follows parted words, and their own gains.
        behind = np.array([rows.get(k + 1, [0] * 12)[:5] for k in range(len(hot.words))], float).reshape(-1, 5)
        self.hot_total = np.maximum(behind[:, 0], 1)
        self.hot_left = np.where(behind[:, 0] > 0, behind[:, 1:4] @ np.array(self.d2) / self.hot_total, 1.0)
        self.hot_gain = np.log(self.p1(behind[:, 4].astype(np.int64))) - self.unknown + np.log(self.hot_left)
        # The end of every text, and the begin before it, are the same for all.
        begin = sums[11] * self.d2[0] + sums[12] * self.d2[1] + sums[13] * self.d2[2]
        self.start = float(np.log(self.p1(np.array(words[11])))) + (float(np.log(begin / sums[10])) if sums[10] else 0.0)

    def p1(self, n: np.ndarray) -> np.ndarray:
        return (n - less(self.d1, n)) / self.total + self.base

    def numbers(self) -> Numbers:
        out = object.__new__(Numbers)
        out.__dict__ = {k: v for k, v in self.__dict__.items() if k not in ("three", "answers")}
        return out


class Numbers:
    """Of a trained model, what goes to the tasks."""

    p1 = Trained.p1


def train(texts: DataFrame) -> Trained:
    """texts: one column, `text`."""
    shards = -(-shuffle_partitions(texts.sparkSession) // PARTS) * PARTS
    hot = hot_words(texts, shards)
    three = postings.by_shard(texts.mapInArrow(trigram_parcels(hot, shards), postings.PARCEL))
    three = stepped(three.mapInArrow(sum_trigrams, postings.PARCEL), "trigrams")
    asked = postings.by_shard(three.mapInArrow(requests(hot, shards), postings.PARCEL))
    answers = stepped(asked.mapInArrow(owners(hot), postings.PARCEL), "answers")
    return Trained(three, answers, hot, shards)


class Owned:
    """The words that a shard owns, what they follow, and the gains of the bigrams
    of parted words that end with them."""

    def __init__(self, keys: pa.Buffer, a: pa.Buffer, b: pa.Buffer, model: Numbers) -> None:
        self.names, self.follows = postings.from_steps(keys, KIND), postings.from_planes(a, "<u4").astype(np.int64)
        n = b.size // 10
        place, hot = postings.from_planes(b.slice(0, 4 * n), "<u4"), postings.from_planes(b.slice(4 * n, 2 * n), "<u2")
        counts, hot = postings.from_planes(b.slice(6 * n), "<u4").astype(np.int64), hot.astype(np.int64)
        self.two = place.astype(np.int64) << 16 | hot
        lower = model.hot_left[hot - 1] * model.p1(self.follows[place])
        self.gain2 = np.log1p((counts - less(model.d2, counts)) / model.hot_total[hot - 1] / lower)

    def sums(self, keys: pa.Buffer, a: pa.Buffer, b: pa.Buffer, code: np.ndarray) -> np.ndarray:
        """Of the bigrams of parted words of a batch, per document."""
        many = a.size // 10
        w, n = (postings.from_planes(a.slice(at, 4 * many), "<u4") for at in (0, 4 * many))
        hot = postings.from_planes(a.slice(8 * many), "<u2").astype(np.int64)
        place, known = (x[np.cumsum(w, dtype=np.int64)] for x in find(self.names, named(keys, code)))
        two, found = find(self.two, place << 16 | hot)
        value = np.zeros(many)
        found &= known
        value[found] = self.gain2[two[found]]
        return np.bincount(postings.from_planes(b, "<u2"), np.repeat(value, n))


def parted_bigrams(names: Names, w: np.ndarray, hot: np.ndarray, docs: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Bigrams (w, number of a parted word) as blobs: equal ones together, with their documents."""
    order = np.argsort(w << 16 | hot, kind="stable")
    w, hot = w[order], hot[order]
    new = np.append(True, (w[1:] != w[:-1]) | (hot[1:] != hot[:-1]))
    head = np.flatnonzero(new)
    used, local = np.unique(w[head], return_inverse=True)
    columns = (np.diff(local, prepend=0), "<u4"), (np.diff(np.append(head, len(w))), "<u4"), (hot[head], "<u2")
    a = b"".join(postings.planes(c.astype(k)) for c, k in columns)
    return names.blob(used), a, postings.planes(docs[order].astype("<u2"))


class Shard:
    """The gains of a shard's words, bigrams, contexts and trigrams."""

    def __init__(self, x: Trigrams, answers: np.ndarray, owned: Owned, model: Numbers) -> None:
        size = len(x.names)
        counts = x.kinds()
        asked = Asked(x, counts, model.hot, model.shards)
        follows = np.zeros(size, np.int64)
        follows[asked.words], counts[asked.parted] = asked.answered(answers)
        taken = less(model.d2, counts)
        # What follows each word that is not parted is all here.
        total, left = np.bincount(x.v, counts, size), np.bincount(x.v, taken, size)
        known = total > 0
        left[known] /= total[known]
        left[~known] = 1.0
        number = model.hot.number(x.names)
        parted = number > 0
        total[parted], left[parted] = model.hot_total[number[parted] - 1], model.hot_left[number[parted] - 1]
        p1 = model.p1(follows)[x.w]
        lower = left[x.v] * p1
        p2 = (counts - taken) / total[x.v] + lower
        self.names, self.two = x.names, x.v << 32 | x.w
        self.gain2 = np.log(p2 / lower)
        self.contexts, owner = np.unique(x.v[x.owner] << 32 | x.u, return_inverse=True)
        aside = less(model.d3, x.n)
        left3, total3 = np.bincount(owner, aside, len(self.contexts)), np.bincount(owner, x.n, len(self.contexts))
        self.context_gain = np.log(left3 / total3)
        self.three = x.owner << 32 | x.u
        self.gain3 = np.log1p((x.n - aside) / p2[x.owner] / left3[owner])
        # A word's own loss over an unknown one's, and its weight as a context. The
        # owner of a word that is not parted has what follows it, too.
        self.word_gain = np.zeros(size)
        place, here = find(owned.names, x.names)
        here &= ~parted
        self.word_gain[here] = np.log(model.p1(owned.follows[place[here]])) - model.unknown + np.log(left[here])
        # A parted word's bigrams are not all in the shard that a trigram goes to.
        self.gain2[parted[x.v]] = 0.0

    def sums(self, x: Trigrams, docs: np.ndarray) -> np.ndarray:
        """Of the trigrams of a batch, per document."""
        place, known = find(self.names, x.names)
        place = np.where(known, place, -1)
        v, w = place[x.v], place[x.w]
        value = np.zeros(len(x.v))
        some = v >= 0
        value[some] = self.word_gain[v[some]]
        two, found = find(self.two, v << 32 | w)
        found &= some & (w >= 0)
        value[found] += self.gain2[two[found]]
        value = value[x.owner]
        u, v = place[x.u], v[x.owner]
        both = np.flatnonzero((u >= 0) & (v >= 0))
        context, met = find(self.contexts, v[both] << 32 | u[both])
        value[both[met]] += self.context_gain[context[met]]
        both = both[met & found[x.owner[both]]]
        three, met = find(self.three, two[x.owner[both]] << 32 | u[both])
        value[both[met]] += self.gain3[three[met]]
        return np.bincount(docs, np.repeat(value, x.n))


# ---------------------------------------------------------------- scores


def score_parcels(model: Numbers, part: int) -> Callable:
    """Batches to their trigrams (role 3) by the shards of a part, bigrams of parted
    words (role 5) by the owners of their last word, and a row of their own (role 4)
    with a mark of the batch; with part 0, this row has the documents and what does
    not come from shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = postings.batch_ids()
        for batch in sliced(batches, "text", TEXT_BYTES):
            number = next(numbers)
            names, w, v, u, doc, tokens = events(batch.column("text"))
            rows = batch.drop_columns(["text"]).append_column("tokens", pa.array(tokens))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as stream:
                stream.write_batch(rows)
            body = sink.getvalue().to_pybytes()
            mark = zlib.crc32(body, zlib.crc32(np.bincount(doc, names[w] >> np.uint64(32)).tobytes()))
            number_of = model.hot.number(names)[v]
            parted = np.flatnonzero(number_of)
            own = model.unknown * tokens + model.start
            own += np.bincount(doc[parted], model.hot_gain[number_of[parted] - 1], len(tokens))
            own = own.astype("<f8").tobytes()
            shard = int(postings.shard_of(np.array([number]), model.shards // PARTS)[0]) * PARTS + part
            first = (body, own) if part == 0 else (b"", b"")
            out = [(shard, 4, number, *first, mark.to_bytes(4, "little"))]
            homes = model.hot.homes(names, v, u, model.shards)
            owner = postings.shard_of(names, model.shards)[w[parted]]
            names = Names(names, model.code)
            w, v, u = (names.rank[x] for x in (w, v, u))
            mine = np.flatnonzero(homes % PARTS == part)
            for shard, at in postings.split(homes[mine]):
                at = mine[at]
                keys, a, order = packed(names, v[at], w[at], u[at])
                out.append((shard, 3, number, keys, a, postings.planes(doc[at][order].astype("<u2"))))
            mine = parted[owner % PARTS == part]
            for shard, at in postings.split(owner[owner % PARTS == part]):
                at = mine[at]
                out.append((shard, 5, number, *parted_bigrams(names, w[at], number_of[at], doc[at])))
            yield filled(out)

    return run


def score_shards(model: Numbers) -> Callable:
    """A shard's counts and answers, and what batches send, sorted by shard and
    role, to SUMS: a batch's own row (role 0, or 2 with the mark alone) and the
    sums of its documents (role 1)."""
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in postings.SUMS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, three, answers, owned, values = None, None, [], None, None
        for batch in batches:
            out: list[tuple] = []
            for row in range(batch.num_rows):
                shard, role, number = (batch.column(c)[row].as_py() for c in ("shard", "role", "batch"))
                keys, a, b = (batch.column(c)[row].as_buffer() for c in ("keys", "a", "b"))
                if shard != at:
                    at, three, answers, owned, values = shard, None, [], None, None
                if role == 0:
                    three = parsed(batch, row)
                elif role == 1:
                    answers.append(postings.from_planes(a, "<u4"))
                elif role == 2:
                    owned = Owned(keys, a, b, model)
                elif role == 4:
                    out.append((number, 0 if keys.size else 2, keys.to_pybytes(), a.to_pybytes(), b.to_pybytes()))
                elif (three if role == 3 else owned) is not None:
                    if role == 3:
                        owned = owned or Owned(*[pa.py_buffer(b"")] * 3, model)
                        values = values or Shard(three, np.concatenate(answers), owned, model)
                        sums = values.sums(Trigrams(keys, a, model.code), postings.from_planes(b, "<u2"))
                    else:
                        sums = owned.sums(keys, a, b, model.code)
                    some = np.flatnonzero(sums)
                    nothing = np.zeros(len(some)).tobytes()  # totals() adds two values
                    out.append((number, 1, some.astype("<u2").tobytes(), sums[some].tobytes(), nothing))
            if out:
                columns = [pa.array(c, k) for c, k in zip(map(list, zip(*out, strict=True)), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def mean_losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for own, sums, _ in postings.totals(batches):
        rows = pa.ipc.open_stream(own.column("keys")[0].as_buffer()).read_all()
        logs = np.frombuffer(own.column("a")[0].as_buffer(), "<f8") + sums[: rows.num_rows]
        tokens = rows.column("tokens").to_numpy()
        columns = [rows.column(c).combine_chunks() for c in ("doc_id", "lang")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(tokens), pa.array(-logs / (tokens + 1))], ["doc_id", "lang", "n_tokens", "loss"]
        )


def part_sums(documents: DataFrame, model: Trained) -> DataFrame:
    """SUMS of all parts, each of a pass over the documents."""
    numbers, parts = model.numbers(), []
    for part in range(PARTS):
        sent = documents.mapInArrow(score_parcels(numbers, part), postings.PARCEL)
        counted = model.three.unionByName(model.answers.filter("role < 3")).filter(f"shard % {PARTS} = {part}")
        work = postings.by_shard(counted.unionByName(sent))
        parts.append(stepped(work.mapInArrow(score_shards(numbers), postings.SUMS), f"sums-{part}"))
    return reduce(DataFrame.unionByName, parts)


def losses(documents: DataFrame, model: Trained) -> DataFrame:
    """(doc_id, lang, n_tokens, loss) of (doc_id, lang, text)."""
    sums = part_sums(documents, model)
    marks = sums.filter("role <> 1").groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("b").alias("kinds"))
    if marks.filter(f"n <> {PARTS} or kinds <> 1").limit(1).count():
        # Not the same batches in each pass, as with rows from a shuffle: from a written table they are.
        forget(sums)
        sums = part_sums(documents := written(documents, "documents"), model)
        forget_after = [sums, documents]
    else:
        forget_after = [sums]
    schema = "doc_id long, lang string, n_tokens long, loss double"
    found = stepped(postings.by_batch(sums.filter("role < 2")).mapInArrow(mean_losses, schema), "losses")
    forget(*forget_after)
    return found


def classify(
    documents: DataFrame,
    trusted: DataFrame,
    quantile: float = QUANTILE,
    held_most: int = HELD_MOST,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """id_col, lang, n_tokens, loss, perplexity, threshold, kept per document.
    trusted: ids (id_col) of trusted documents."""
    docs = documents.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NONE)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    ids = trusted.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    ids = written(ids, "trusted-ids")
    n_ids = ids.count()
    share = min(0.5, max(0.1, held_most / max(1, n_ids)))
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 30)) < int(share * (1 << 30))
    learnt = ids.filter(~held_out)
    model = train(docs.join(F.broadcast(learnt) if n_ids <= BROADCAST_IDS else learnt, "doc_id").select("text"))

    scored = losses(docs, model)
    forget(model.three, model.answers)
    held = scored.join(ids.filter(held_out), "doc_id")
    cut = F.percentile_approx("loss", quantile, 10_000)
    by_lang = held.groupBy("lang").agg(cut.alias("own"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST)
    overall = held.agg(cut).first()[0]
    found = scored.join(by_lang.drop("n"), "lang", "left")
    threshold = F.coalesce("own", F.lit(float("inf") if overall is None else overall))
    return found.select(
        F.col("doc_id").alias(id_col),
        "lang",
        "n_tokens",
        "loss",
        F.exp("loss").alias("perplexity"),
        F.exp(threshold).alias("threshold"),
        (F.col("loss") <= threshold).alias("kept"),
    )
