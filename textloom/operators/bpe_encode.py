"""Encoding and decoding with a trained vocabulary: narrow, no shuffle.

Texts are cut into words in the JVM; tasks encode each distinct word of an Arrow
batch once, remember it, and gather the ids of all texts by offsets; decoding
gathers bytes the same way. Both go through a batch in slices of bounded size. What travels to the tasks is
the vocabulary, whose size is fixed by its vocab_size.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import chain
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators import vocab as vb
from textloom.operators.bpe_train import Vocabulary

CACHE_WORDS = 200_000  # encoded words a task remembers before starting over
SLICE_ITEMS = 500_000  # words, or ids, of the texts that are gathered together

_SPECIAL = "|".join(vb.SPECIALS)


def pieces(text: Column) -> Column:
    """Words of a text as encoding sees them: a special token written out in
    the text is a piece of its own, and cuts the text around it."""
    parts = F.split(text, f"(?={_SPECIAL})|(?<={_SPECIAL})", -1)
    cut = F.transform(parts, lambda p: F.when(p.isin(*vb.SPECIALS), F.array(p)).otherwise(vb.pretokens(p)))
    return F.when(text.rlike(_SPECIAL), F.flatten(cut)).otherwise(vb.pretokens(text))


def spells_special(text: Column) -> Column:
    """Whether a special token is written out in the text."""
    return reduce(or_, [F.contains(text, F.lit(t)) for t in vb.SPECIALS])


def _broadcast(value):
    return SparkSession.active().sparkContext.broadcast(value)


def merge_word(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Repeat the best-ranked merge, leftmost first, until none applies."""
    n = len(symbols)
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (found := ranks.get((symbols[i], symbols[j]))):
            heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = nxt[i]
        if symbols[i] != left or j >= n or symbols[j] != right:
            continue  # one of the two was merged away meanwhile
        symbols[i], symbols[j] = new, -1
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        if prv[i] >= 0:
            offer(prv[i])
        offer(i)
    return [s for s in symbols if s >= 0]


def _start(model: Vocabulary) -> list[int]:
    """The id of each byte."""
    byte_of = {t[0]: i for i, t in enumerate(model.tokens) if len(t) == 1}
    return [byte_of.get(b, vb.UNK) for b in range(256)]


def _ranks(model: Vocabulary) -> dict[tuple[int, int], tuple[int, int]]:
    # Should training merge a pair a second time, its later rank counts.
    return {(left, right): (rank, new) for rank, (left, right, new, _) in enumerate(model.merges)}


def token_count(word: Column, model: Vocabulary) -> Column:
    """How many tokens a word of a text has."""
    shared = _broadcast((_start(model), _ranks(model)))

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        start, ranks = shared.value
        for words in batches:
            sizes = [len(merge_word([start[b] for b in w], ranks)) for w in words.cast(pa.binary()).to_pylist()]
            yield pa.array(sizes, pa.int64())

    return count.asNondeterministic()(word)


def encode(text: Column, model: Vocabulary, template: bool = True) -> Column:
    """Token ids of a text; `template` puts <s> before and </s> after them."""
    start, ranks = _start(model), _ranks(model)
    specials = {t: i for i, t in enumerate(vb.SPECIALS)}
    shared = _broadcast((start, ranks, specials))

    @F.arrow_udf("array<int>")
    def to_ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        start, ranks, specials = shared.value
        cache: dict[str, list[int]] = {}

        def ids_of(word: str) -> list[int]:
            known = cache.get(word)
            if known is None:
                known = merge_word([start[b] for b in word.encode("utf-8", "surrogatepass")], ranks)
                cache[word] = known
            return known

        for texts in chain.from_iterable(map(_slices, batches)):
            if len(cache) > CACHE_WORDS or not cache:
                cache = {t: [i] for t, i in specials.items()}
            words = texts.flatten().dictionary_encode()
            known = [ids_of(w) for w in words.dictionary.to_pylist()]
            table, bounds = gathered(_flat(known), words.indices.to_numpy())
            yield _templated(table, bounds[_bounds(texts)], template)

    return to_ids.asNondeterministic()(pieces(F.coalesce(text, F.lit(""))))


def _slices(lists: pa.Array) -> Iterator[pa.Array]:
    """The same lists, at most about SLICE_ITEMS items together; a longer one
    alone. A batch without lists stays as it is."""
    part = _bounds(lists)[:-1] // SLICE_ITEMS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lists)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield lists.slice(a, b - a)


def _bounds(lists: pa.Array) -> np.ndarray:
    """Where each list starts in the flattened values, and their number."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _flat(parts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Lists as one array and the bounds of each."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.fromiter(chain.from_iterable(parts), np.int32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


def gathered(table: tuple[np.ndarray, np.ndarray], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of a (values, bounds) table at `codes`, one after the other,
    and the bounds of each in the result."""
    values, at = table
    sizes = (at[1:] - at[:-1])[codes]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    return values[np.repeat(at[codes] - bounds[:-1], sizes) + np.arange(bounds[-1])], bounds


def _templated(ids: np.ndarray, bounds: np.ndarray, template: bool) -> pa.Array:
    if template:
        n = len(bounds) - 1
        out = np.full(len(ids) + 2 * n, vb.BOS, np.int32)
        out[np.arange(len(ids)) + 2 * np.repeat(np.arange(n), np.diff(bounds)) + 1] = ids
        bounds = bounds + 2 * np.arange(n + 1)
        out[bounds[1:] - 1] = vb.EOS
        ids = out
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))


def encode_pair(first: Column, second: Column, model: Vocabulary) -> Column:
    """Ids and type ids of a pair: <s> A </s> of type 0, B </s> of type 1."""
    a = encode(first, model)
    b = F.concat(encode(second, model, template=False), F.array(F.lit(vb.EOS)))
    zeros, ones = F.transform(a, lambda x: x * 0), F.transform(b, lambda x: x * 0 + 1)
    return F.struct(F.concat(a, b).alias("ids"), F.concat(zeros, ones).alias("type_ids"))


def decode(ids: Column, model: Vocabulary) -> Column:
    """Text of the ids. Special tokens are left out; bytes that are no UTF-8
    (ids cut in mid-character) show as the replacement character."""
    plain = [b"" if i < len(vb.SPECIALS) else t for i, t in enumerate(model.tokens)]
    shared = _broadcast(_flat([list(t) for t in plain]))

    @F.arrow_udf("string")
    def to_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        values, at = shared.value
        table = values.astype(np.uint8), at
        for rows in chain.from_iterable(map(_slices, batches)):
            raw, ends = gathered(table, rows.flatten().to_numpy())
            bounds = ends[_bounds(rows)]
            buffers = [None, pa.py_buffer(bounds), pa.py_buffer(raw)]
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), buffers)
            try:
                texts = texts.cast(pa.large_string())
            except pa.ArrowInvalid:  # some text was cut in mid-character
                texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.large_string())
            yield pc.if_else(rows.is_null(), pa.scalar(None, pa.large_string()), texts).cast(pa.string())

    return to_text.asNondeterministic()(ids)


def token_strings(ids: Column, model: Vocabulary) -> Column:
    """The visible form of each id."""
    shown = vb.visible_bytes()
    shared = _broadcast(["".join(shown[b] for b in t) for t in model.tokens])

    @F.pandas_udf("array<string>")
    def show(rows: pd.Series) -> pd.Series:
        return rows.map(lambda ids: [shared.value[i] for i in ids], na_action="ignore")

    return show.asNondeterministic()(ids)


def encode_documents(df: DataFrame, model: Vocabulary, column: str = "text") -> DataFrame:
    return df.withColumn("ids", encode(F.col(column), model))
