"""Byte-pair-encoding training as rounds of Spark jobs.

Corpus-size work happens once: cutting texts into words and counting each
distinct word, an aggregate that combines map-side. After that the state is the
table of distinct words, written to the shared folder and never collected.

Which pair is merged next depends on counts over all words after all earlier
merges, so a job per merge would do. A round does better: the driver proposes
the next merges, tasks apply them one after the other to their words and report
how each step changes the pair counts, and the driver makes
those that are in turn, by those exact counts, the most frequent pair, in that
order: proposals that meet nowhere in the words may change places, and the round
ends at one that would come before one it meets. The proposals come from a sample
of bounded size of the words, drawn by their counts; they decide how many merges a
round gains, never which merges are made.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.operators import vocab as vb
from textloom.session import discard, materialize

TOP_PAIRS = 8_192  # ranked pairs a recount brings to the driver
PROPOSALS = (64, 2_048)  # merges proposed in a round: twice what the last one gained, or what it left
RANKED = 4  # times so many pairs are ranked on the driver at most
HEAD_WORDS = 250_000  # words of usual length the proposals are made from, at most about
USUAL = 8  # symbols of a word of usual length
REBASE_MERGES = 2_048  # merges between writings of the word table
FEW_RUNS = 8  # runs of merges that are applied by scans of all symbols
PAIR = 1 << 24  # symbol ids are below this; a pair is left * PAIR + right
DEAD = -2  # a place whose symbol went into a merge
BLOCK_SYMBOLS = 2_000_000  # symbols of one task that are indexed together


def training_texts(df: DataFrame, column: str = "text", groups: tuple[str, ...] = ()) -> DataFrame:
    """(groups, text): trimmed texts, blank ones left out."""
    return df.select(*groups, tx.strip(tx.or_empty(F.col(column))).alias("text")).filter(F.col("text") != "")


def word_counts(df: DataFrame, column: str = "text") -> DataFrame:
    """(word, n) over the whole corpus."""
    words = training_texts(df, column).select(F.explode(vb.pretokens(F.col("text"))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def byte_counts(counts: DataFrame) -> DataFrame:
    """(byte, n): the bytes in use, weighted by the words' counts."""
    hexed = F.hex(F.encode("word", "UTF-8"))
    pairs = F.regexp_extract_all(hexed, F.lit("(..)"), F.lit(1))
    return (
        counts.select(F.explode(pairs).alias("h"), "n")
        .groupBy("h")
        .agg(F.sum("n").alias("n"))
        .select(F.conv("h", 16, 10).cast("int").alias("byte"), "n")
    )


def pair_counts(counts: DataFrame) -> DataFrame:
    """(l, r, n): adjacent byte pairs inside words, weighted by word count."""
    hexed = F.hex(F.encode("word", "UTF-8"))
    b = F.regexp_extract_all(hexed, F.lit("(..)"), F.lit(1))
    pairs = F.arrays_zip(F.slice(b, 1, F.size(b) - 1).alias("l"), F.slice(b, 2, F.size(b) - 1).alias("r"))
    return (
        counts.filter(F.octet_length("word") > 1)
        .select(F.explode(pairs).alias("p"), "n")
        .groupBy("p.l", "p.r")
        .agg(F.sum("n").alias("n"))
        .select(F.conv("l", 16, 10).cast("int").alias("l"), F.conv("r", 16, 10).cast("int").alias("r"), "n")
    )


@dataclass
class Vocabulary:
    """A trained vocabulary; at most vocab_size tokens, so small by definition."""

    tokens: list[bytes]  # by id, the specials first
    merges: list[tuple[int, int, int, int]] = field(default_factory=list)  # left, right, new id, count

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        shown = vb.visible_bytes()
        rows = [
            (i, "".join(shown[b] for b in t)) for i, t in enumerate(self.tokens)
        ]
        return spark.createDataFrame(rows, "id int, token string")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(rank, *m) for rank, m in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left_id int, right_id int, new_id int, n bigint")

    def save(self, spark: SparkSession, path: str) -> None:
        self.vocab_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
        self.merge_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Vocabulary:
        byte_of = {c: b for b, c in enumerate(vb.visible_bytes())}
        shown = [r.token for r in spark.read.parquet(f"{path}/vocab").orderBy("id").collect()]
        merges = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
        tokens = [bytes(byte_of[c] for c in t) for t in shown]
        return cls(tokens, [(m.left_id, m.right_id, m.new_id, m.n) for m in merges])


# -- symbols of many words in one flat array, words separated by -1 -----------


def merge_all(flat: np.ndarray, batch: list[tuple[int, int, int]]) -> np.ndarray:
    """Apply one batch of merges, left to right within each word.

    Merges of a batch never overlap one another, except that a pair of equal
    symbols overlaps itself in runs; there every second place counts.
    """
    order = sorted((left * PAIR + right, new) for left, right, new in batch)
    keys = np.array([k for k, _ in order], dtype=np.int64)
    news = np.array([n for _, n in order], dtype=np.int64)
    pairs = np.where((flat[:-1] >= 0) & (flat[1:] >= 0), flat[:-1] * PAIR + flat[1:], -1)
    slot = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
    at = np.flatnonzero(keys[slot] == pairs)
    if len(at) == 0:
        return flat
    if batch[0][0] == batch[0][1]:
        at = _every_second(at)
    out = flat.copy()
    out[at] = news[slot[at]]
    return np.delete(out, at + 1)


def _sum_by_key(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(values, starts) if len(starts) else values


def _flatten(column: pa.ListArray) -> np.ndarray:
    """List column to one flat array with -1 after every word."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy()[offsets[0] : offsets[-1]]
    return np.insert(values.astype(np.int64), offsets[1:] - offsets[0], -1)


def _unflatten(flat: np.ndarray) -> pa.ListArray:
    ends = np.flatnonzero(flat < 0)
    offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[flat >= 0].astype(np.int32)))


class Words:
    """Symbols of many words in one array, -1 after each, and where pairs are.

    Places never move: a merged symbol stays at the place of its left part, the
    right part's place is dead, and `after` and `before` lead from one living
    place to the next. Pairs are found through an index from a pair to its
    places, made once, and one more per symbol made since: a merge costs what
    its occurrences cost, not a look at every symbol.
    """

    def __init__(self, flat: np.ndarray, weight: np.ndarray):
        n = len(flat)
        ends = flat < 0
        self.flat = flat.astype(np.int64)
        self.weight = weight[np.minimum(np.cumsum(ends) - ends, max(len(weight) - 1, 0))] if n else weight[:0]
        self.after = np.arange(1, n + 1)
        self.before = np.arange(-1, n - 1)
        starts = np.flatnonzero((flat[:-1] >= 0) & (flat[1:] >= 0))
        keys = self.flat[starts] * PAIR + self.flat[starts + 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], starts[order]
        self.made: dict[int, tuple] = {}  # symbol to (sorted pairs, their places) of its merges

    @classmethod
    def of(cls, flat: np.ndarray, weight: np.ndarray) -> Words:
        return cls(flat, weight)

    def copy(self) -> Words:
        out = object.__new__(Words)
        out.flat, out.after, out.before = self.flat.copy(), self.after.copy(), self.before.copy()
        out.weight, out.keys, out.places, out.made = self.weight, self.keys, self.places, dict(self.made)
        return out

    def living(self) -> np.ndarray:
        """The symbols as they are now, -1 after every word."""
        return self.flat[self.flat != DEAD]

    def packed(self) -> Words:
        """The same words of two symbols and more without dead places, indexed anew."""
        flat, weight = self.living(), self.weight[self.flat == -1]
        ends = np.flatnonzero(flat < 0)
        sizes = np.diff(ends, prepend=-1)
        return Words(flat[np.repeat(sizes > 2, sizes)], weight[sizes > 2])

    def pairs_at(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair keys at the places that start one, with their weights, and the places."""
        at = at[(at >= 0) & (at < len(self.flat))]
        at = at[self.flat[at] >= 0]
        right = self.flat[self.after[at]]
        at, right = at[right >= 0], right[right >= 0]
        return self.flat[at] * PAIR + right, self.weight[at], at

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs with the sums of their weights."""
        return _sum_by_key(*self.pairs_at(np.arange(len(self.flat)))[:2])

    def _places(self, left: int, right: int) -> np.ndarray:
        """Where the pair stands now, ascending."""
        key = left * PAIR + right
        noted = [(self.keys, self.places)]
        for symbol in {left, right}:
            noted += self.made.get(symbol, ())
        found = []
        for keys, places in noted:
            a, b = keys.searchsorted((key, key + 1))
            if a < b:
                found.append(places[a:b])
        # Places noted at merges are not in order, and may be noted twice.
        first = len(found) == 1 and found[0].base is self.places
        at = found[0] if first else np.unique(np.concatenate(found)) if found else self.places[:0]
        # A place may have gone into another merge since it was noted.
        at = at[self.flat[at] == left]
        return at[self.flat[self.after[at]] == right]

    def merge(self, left: int, right: int, new: int, told: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Merge one pair everywhere; returns, if it is to be told, how that
        changes pair counts.

        Only pairs that touch a merged place change: before, those starting at
        the place itself or next to it; after, those with the new symbol."""
        at = self._places(left, right)
        if left == right:
            at = self._every_second(at)
        if len(at) == 0:
            return at, at
        second = self.after[at]
        earlier = self.before[at]
        apart = np.ones(len(at), bool)  # of the merged place before, whose pair is looked at once
        np.not_equal(earlier[1:], second[:-1], out=apart[1:])
        if told:
            gone, lost, _ = self.pairs_at(np.concatenate([earlier[apart], at, second]))
        follow = self.after[second]
        self.flat[at] = new
        self.flat[second] = DEAD
        self.after[at] = follow
        self.before[follow] = at  # every word is followed by its -1
        made, won, places = self.pairs_at(np.concatenate([earlier[apart], at]))
        if len(made):
            order = np.argsort(made, kind="stable")
            self.made[new] = (*self.made.get(new, ()), (made[order], places[order]))
        return _sum_by_key(np.concatenate([gone, made]), np.concatenate([-lost, won])) if told else (made, won)

    def _every_second(self, at: np.ndarray) -> np.ndarray:
        """Of places in a row, every second: a a a holds one pair to merge, not two."""
        if not len(at):
            return at
        new = np.append(True, self.after[at[:-1]] != at[1:])
        heads = np.flatnonzero(new)
        within = np.arange(len(at)) - np.repeat(heads, np.diff(heads, append=len(at)))
        return at[within % 2 == 0]


def _every_second(at: np.ndarray) -> np.ndarray:
    """Of places in a row, every second: a a a holds one pair to merge, not two."""
    starts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    within = np.arange(len(at)) - np.repeat(starts, np.diff(starts, append=len(at)))
    return at[within % 2 == 0]


def together(merges: list[tuple]) -> list[list[tuple]]:
    """Cut a sequence of merges into runs that can be applied at once: no two of
    a run can touch the same symbol, and none needs one made in the run."""
    runs: list[list[tuple]] = []
    lefts, rights, made = set(), set(), set()
    for merge in merges:
        left, right, new = merge[:3]
        meets = left in rights or right in lefts or left in made or right in made
        if not runs or meets or left == right or runs[-1][0][0] == runs[-1][0][1]:
            runs.append([])
            lefts, rights, made = set(), set(), set()
        runs[-1].append(merge)
        lefts.add(left)
        rights.add(right)
        made.add(new)
    return runs


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols, counts) of the task's words, about BLOCK_SYMBOLS symbols at a time."""
    flats, counts, held = [], [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        flats.append(_flatten(batch.column("symbols")))
        counts.append(batch.column("n").to_numpy())
        held += len(flats[-1])
        if held >= BLOCK_SYMBOLS:
            yield np.concatenate(flats), np.concatenate(counts)
            flats, counts, held = [], [], 0
    if flats:
        yield np.concatenate(flats), np.concatenate(counts)


def _merged(flat: np.ndarray, n: np.ndarray, runs: list[list[tuple]]) -> Words:
    """A block after the merges of `runs`: by scans where runs are few, else each
    merge through the index."""
    few = len(runs) <= FEW_RUNS
    for run in runs if few else ():
        flat = merge_all(flat, run)
    words = Words(flat, n)
    for run in () if few else runs:
        for left, right, new, *_ in run:
            words.merge(left, right, new, told=False)
    return words


def _count_pairs(words: DataFrame) -> DataFrame:
    """(pair, n) over all words; tasks add up their own words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            keys, totals = Words(*block).totals()
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(totals)], ["pair", "n"])

    return words.mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _updated(words: DataFrame, merges: list[tuple]) -> DataFrame:
    """The words after the merges; a word of one symbol has no pair left to
    merge and leaves the table."""
    shared = words.sparkSession.sparkContext.broadcast(together(merges))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, n in _blocks(batches):
            flat = _merged(flat, n, shared.value).living()
            yield pa.RecordBatch.from_arrays([_unflatten(flat), pa.array(n)], ["symbols", "n"])

    return words.mapInArrow(apply, words.schema).filter(F.size("symbols") > 1)


def _changes(words: DataFrame, merges: list[tuple], proposed: list[tuple], listed: np.ndarray) -> DataFrame:
    """(step, pair, n): how each proposed merge in turn changes the counts of
    the listed pairs and of pairs with a symbol made by the proposals."""
    shared = words.sparkSession.sparkContext.broadcast((together(merges), proposed, listed))
    made_from = min(p[2] for p in proposed)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, proposed, listed = shared.value
        for block in _blocks(batches):
            w = _merged(*block, runs)
            steps, keys, values = [], [], []
            for step, (left, right, new) in enumerate(proposed):
                k, v = w.merge(left, right, new)
                if not len(k):
                    continue
                slot = np.minimum(np.searchsorted(listed, k), len(listed) - 1)
                wanted = (k // PAIR >= made_from) | (k % PAIR >= made_from) | (listed[slot] == k)
                keys.append(k[wanted])
                values.append(v[wanted])
                steps.append(np.full(wanted.sum(), step, dtype=np.int32))
            none = ([np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
            columns = [pa.array(np.concatenate(c or z)) for c, z in zip((steps, keys, values), none, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["step", "pair", "n"])

    rows = words.mapInArrow(follow, "step int, pair bigint, n bigint")
    return rows.groupBy("step", "pair").agg(F.sum("n").alias("n"))


def _least_weight(n: np.ndarray, symbols: np.ndarray, most: int) -> float:
    """The weight w with which words drawn with a chance of n / w (1 from there
    on) hold about `most` symbols; 0 takes all."""
    order = np.argsort(-n)
    n, symbols = n[order].astype(float), symbols[order].astype(float)
    if symbols.sum() <= most:
        return 0.0
    sure = np.cumsum(symbols) - symbols  # of all more frequent words
    rest = np.cumsum((n * symbols)[::-1])[::-1]
    # Where the first k counts are sure, the others share what is left.
    weight = rest / np.maximum(most - sure, 1e-9)
    return float(weight[np.flatnonzero((sure < most) & (weight >= n))[0]])


def _head(words: DataFrame, most: int) -> Words:
    """Words to make proposals from, all of them or a sample by their counts
    whose weights stand for all."""
    # A row per number of times that words come: at most the root of twice all words.
    by_count = words.groupBy("n").agg(F.sum(F.size("symbols")).alias("symbols")).toArrow()
    least = _least_weight(by_count.column("n").to_numpy(), by_count.column("symbols").to_numpy(), most)
    share = F.pmod(F.xxhash64("symbols"), F.lit(1 << 30)) / F.lit(1 << 30)
    drawn = words.filter(F.col("n") > share * least).toArrow().combine_chunks()
    if not drawn.num_rows:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64))
    weight = np.maximum(drawn.column("n").to_numpy(), round(least))
    return Words(_flatten(drawn.column("symbols").combine_chunks()), weight)


class Ranking:
    """Counts of the pairs that can come next, most frequent first, ties by ids."""

    def __init__(self, counts: dict[int, float]):
        self.counts = counts
        self.heap = [(-n, pair) for pair, n in counts.items()]
        heapq.heapify(self.heap)

    def best(self) -> tuple[int, float] | None:
        while self.heap:
            n, pair = self.heap[0]
            if self.counts.get(pair) == -n:
                return pair, -n
            heapq.heappop(self.heap)  # an outdated entry
        return None

    def cut(self, most: int) -> tuple[float, int] | None:
        """Forget all but the `most` first pairs where they are several times as
        many; returns the place in the order of the last one kept."""
        if len(self.counts) <= RANKED * most:
            return None
        kept = heapq.nsmallest(most, ((-n, pair) for pair, n in self.counts.items()))
        self.__init__({pair: -n for n, pair in kept})
        return kept[-1]

    def add(self, pair: int, change: float) -> None:
        self.counts[pair] = self.counts.get(pair, 0) + change
        heapq.heappush(self.heap, (-self.counts[pair], pair))


def propose(
    ranking: Ranking, head: Words, spell: list[bytes], tokens: dict, last: tuple, limit: int, seen: dict | None = None
) -> list[tuple]:
    """The next merges by the ranking and, for pairs that merging changes, by
    what happened in all words when they were last proposed (`seen`), or else
    by what happens in the head words, scaled up to all words.

    A merge that spells an existing token goes alone.
    """
    seen = seen or {}
    guess = Ranking(dict(ranking.counts))
    head = head.copy()
    spell, known = list(spell), {}
    out: list[tuple] = []
    while len(out) < limit and (top := guess.best()) and (-top[1], top[0]) <= last:
        pair, n = top
        left, right = divmod(pair, PAIR)
        text = spell[left] + spell[right]
        if text in tokens or text in known:
            return out or [(left, right, tokens[text])]
        new = len(spell)
        spell.append(text)
        known[text] = new
        out.append((left, right, new))
        keys, values = head.merge(left, right, new)
        if (spell[left], spell[right]) in seen:
            changed = []
            for a, b, v in seen[spell[left], spell[right]]:
                a, b = tokens.get(a, known.get(a)), tokens.get(b, known.get(b))
                if a is not None and b is not None:
                    changed.append((a * PAIR + b, v))
        else:
            scale = n / max(-values[keys == pair].sum(), 1)
            changed = zip(keys.tolist(), (values * scale).tolist())
        for k, v in changed:
            if v > 0 or k in guess.counts:
                guess.add(k, v)
        guess.counts.pop(pair, None)
    return out


def _followed(proposed: list[tuple], rows: list[tuple], base: int) -> tuple[dict[int, list], dict[int, set]]:
    """What each proposed merge changes, and the earlier ones it has to wait for.

    Two merges wait for one another if they meet somewhere: the later one needs
    the symbol of the earlier, or loses places to it, or changes a pair with its
    symbol, that is, stands next to it. Merges that never meet change the same
    counts in either order, so a later one may come first.
    """
    changes: dict[int, list] = defaultdict(list)
    step_of = {left * PAIR + right: step for step, (left, right, _) in enumerate(proposed)}
    waits = {step: {s - base for s in p[:2] if s >= base} for step, p in enumerate(proposed)}
    for step, pair, n in rows:
        changes[step].append((pair, n))
        waits[step] |= {s - base for s in divmod(pair, PAIR) if base <= s < base + step}
        if step_of.get(pair, -1) > step:
            waits[step_of[pair]].add(step)
    return changes, waits


def _left_over(proposed: list[tuple], changes: dict[int, list], made: dict, tokens: list[bytes], base: int) -> dict:
    """What proposals that were not made would have changed, by the symbols'
    spelling: (left, right) to (left, right, change) of pairs."""
    spelled = tokens[:base]
    for left, right, _ in proposed:
        spelled.append(spelled[left] + spelled[right])
    out = {}
    for step, (left, right, _) in enumerate(proposed):
        if step not in made:
            rows = ((*divmod(pair, PAIR), n) for pair, n in changes[step])
            out[spelled[left], spelled[right]] = [(spelled[a], spelled[b], n) for a, b, n in rows]
    return out


def _named(pair: int, final: dict[int, int], base: int) -> int:
    """The pair with the ids that proposed symbols got in the end."""
    left, right = (s if s < base else final[s - base] for s in divmod(pair, PAIR))
    return left * PAIR + right


def _known(proposed: list[tuple], steps: Iterable[int], final: dict[int, int], base: int) -> dict[int, int]:
    """Pair to step, of those steps whose two symbols exist by now."""
    made = [s for s in steps if all(x < base or x - base in final for x in proposed[s][:2])]
    return {_named(proposed[s][0] * PAIR + proposed[s][1], final, base): s for s in made}


def train(
    df: DataFrame,
    vocab_size: int = 32_000,
    min_frequency: int = 2,
    full_alphabet: bool = False,
    column: str = "text",
    top: int = TOP_PAIRS,
) -> Vocabulary:
    """Learn a vocabulary from the texts of df.

    full_alphabet gives all 256 bytes an id, so that bytes the corpus lacks can
    still be encoded; otherwise the alphabet is the bytes seen.
    """
    counts = materialize(word_counts(df, column), "words")
    return train_from_counts(counts, vocab_size, min_frequency, full_alphabet, top)


def train_from_counts(
    counts: DataFrame,
    vocab_size: int = 32_000,
    min_frequency: int = 2,
    full_alphabet: bool = False,
    top: int = TOP_PAIRS,
) -> Vocabulary:
    """Learn from (word, n), a written table of distinct words."""
    # At most 256 rows.
    seen = set(range(256)) if full_alphabet else {r.byte for r in byte_counts(counts).select("byte").collect()}
    ids = vb.byte_ids(seen)
    by_id = {i: bytes([b]) for b, i in ids.items()}
    model = Vocabulary([t.encode() for t in vb.SPECIALS] + [by_id[i] for i in sorted(by_id)])
    tokens = {t: i for i, t in enumerate(model.tokens)}

    if len(model.tokens) >= vocab_size:
        return model

    table = np.zeros(256, dtype=np.int32)
    for byte, i in ids.items():
        table[byte] = i
    least = max(min_frequency, 1)
    words = materialize(_as_symbols(counts, table).repartition(_parts(counts)), "symbols")
    head = _head(words, HEAD_WORDS * USUAL)  # only to make proposals from

    pending: list[tuple] = []  # merges made since the words were last written
    ranking, last, complete, recount, gained, seen = Ranking({}), (0, 0), False, True, 0, {}
    while len(model.tokens) < vocab_size:
        if pending and (recount or len(pending) >= REBASE_MERGES):
            before, words = words, materialize(_updated(words, pending), "symbols")
            discard(before)
            pending, head = [], head.packed()
        if recount:
            # Pairs outside this list rank after its last one, now and later:
            # merges only take from the counts of pairs of older symbols.
            ranked = _count_pairs(words).filter(F.col("n") >= least)
            rows = ranked.orderBy(F.desc("n"), "pair").limit(top).collect()
            complete = len(rows) < top
            last = (-least, PAIR * PAIR) if complete else (-rows[-1].n, rows[-1].pair)
            ranking, recount = Ranking({r.pair: r.n for r in rows}), False
        if (place := ranking.cut(top)) and place < last:
            # The others rank after it until they are counted again.
            last, complete = place, False
        best = ranking.best()
        if best is None or (-best[1], best[0]) > last:
            if complete:
                break
            recount = True
            continue
        room = max(PROPOSALS[0], min(max(2 * gained, len(seen)), PROPOSALS[1]))
        proposed = propose(ranking, head, model.tokens, tokens, last, min(room, vocab_size - len(model.tokens)), seen)
        listed = np.sort(np.fromiter(ranking.counts, dtype=np.int64))
        moved = _changes(words, pending, proposed, listed).filter((F.col("n") < 0) | (F.col("n") >= -last[0]))
        base, gained = len(model.tokens), 0
        moved = moved.toArrow()
        changes, waits = _followed(proposed, list(zip(*(moved.column(c).to_pylist() for c in moved.column_names))), base)
        final: dict[int, int] = {}  # steps made so far, and the id of each one's symbol
        later = defaultdict(list)
        for step, earlier in waits.items():
            for s in earlier:
                later[s].append(step)
        known = _known(proposed, range(len(proposed)), final, base)
        while (best := ranking.best()) and (-best[1], best[0]) <= last:
            step = known.get(best[0])
            if step is None or not waits[step] <= final.keys():
                break
            left, right = divmod(best[0], PAIR)
            new = proposed[step][2]
            if new >= base:
                new = len(model.tokens)
                text = model.tokens[left] + model.tokens[right]
                tokens[text] = new
                model.tokens.append(text)
            else:
                recount = True  # pairs of an older symbol may have grown
            final[step] = new
            model.merges.append((left, right, new, best[1]))
            pending.append((left, right, new))
            gained += 1
            head.merge(left, right, new)
            for pair, change in changes[step]:
                pair = _named(pair, final, base)
                if pair in ranking.counts or change > 0:
                    ranking.add(pair, change)
            ranking.counts.pop(best[0])
            del known[best[0]]
            known |= _known(proposed, [s for s in later[step] if s not in final], final, base)
        seen = _left_over(proposed, changes, final, model.tokens, base) if proposed[0][2] == base else {}
    return model


def _as_symbols(counts: DataFrame, table: np.ndarray) -> DataFrame:
    """(symbols, n): words of two bytes and more as byte ids."""
    shared = counts.sparkSession.sparkContext.broadcast(table)

    def spell(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks:
            raw = [np.frombuffer(w, dtype=np.uint8) for w in block.column("word").cast(pa.binary()).to_pylist()]
            lengths = np.array([len(r) for r in raw], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = shared.value[np.concatenate(raw)] if raw else np.zeros(0, dtype=np.int32)
            symbols = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([symbols, block.column("n")], ["symbols", "n"])

    return counts.filter(F.octet_length("word") > 1).mapInArrow(spell, "symbols array<int>, n bigint")


def _parts(df: DataFrame) -> int:
    """Tasks for the word table: rounds are compute-bound, so one per core even
    where the table is small."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def training_stats(
    spark: SparkSession, model: Vocabulary, vocab_size: int, min_frequency: int, run_id: str
) -> DataFrame:
    row = (len(model.tokens), vocab_size, min_frequency, list(vb.SPECIALS), run_id)
    return spark.createDataFrame(
        [row],
        "vocab_size int, vocab_size_requested int, min_frequency int, special_tokens array<string>, run_id string",
    )
