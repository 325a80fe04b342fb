"""Language tags from a character n-gram model, fitted and applied on Spark.

Fitting counts the 1- to 3-grams of labelled texts and turns the counts into
smoothed log-probabilities, stored as integers so that sums do not depend on
the order of addition. Applying the model adds them up per text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.config import Settings
from textloom.functions import text as tx
from textloom.operators import domain
from textloom.session import materialize

SCALE = 1_000_000  # log-probabilities are whole millionths
GRAM_SIZES = (1, 2, 3)
UNKNOWN = "unknown"
SHARD_GRAMS = 4_000_000  # of a model that goes to every task, and of a shard of a larger one
PIECE = 1 << 19  # characters whose grams are counted, or looked up, in one go
MOST_TEXTS = 1 << 16  # texts of such a piece
TABLE_CELLS = 1 << 23  # of a model laid out as tables


def _packed(text: str) -> np.ndarray:
    """The 1- to 3-grams of a text as integers, 21 bits per character."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) + 1
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    return np.concatenate([c, two, three])


def _unpacked(key: int) -> str:
    places = (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF)
    return "".join(chr(p - 1) for p in places if p)


def _gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) from (lang, text). Tasks count the grams of a batch
    before anything is shuffled: a handful of rows instead of three per
    character."""

    def count(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            for lang, part in block.groupby("lang"):
                yield from (rows.assign(lang=lang)[["lang", "key", "n"]] for rows in _piece_counts(part["text"]))

    def spell(blocks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in blocks:
            yield pd.DataFrame({"lang": block["lang"], "gram": block["key"].map(_unpacked), "n": block["n"]})

    partial = texts.mapInPandas(count, "lang string, key bigint, n bigint")
    summed = partial.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    return summed.mapInPandas(spell, "lang string, gram string, n bigint")


def fit(df: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """Model rows (lang, gram, logp): every language has a row for every gram
    of any language. The only corpus-size step is the first aggregate, which
    combines map-side; its result is bounded by the grams in use and is written
    once, because three later steps read it."""
    texts = df.select(F.col(label).alias("lang"), F.col(text).alias("text"))
    seen = materialize(_gram_counts(texts), "grams")
    by_gram = seen.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts"))
    totals = seen.groupBy("lang").agg(F.sum("n").alias("total"))
    # One row: the totals of all languages and the number of grams.
    shape = totals.agg(F.map_from_entries(F.collect_list(F.struct("lang", "total"))).alias("totals")).first()
    n_grams = by_gram.count()
    if not shape["totals"]:
        return seen.select("lang", "gram", F.lit(0).cast("bigint").alias("logp")).limit(0)
    totals_map = F.create_map(*[F.lit(x) for kv in sorted(shape["totals"].items()) for x in kv])
    expanded = by_gram.select("gram", "counts", F.explode(totals_map).alias("lang", "total"))
    share = (F.coalesce(F.try_element_at("counts", F.col("lang")), F.lit(0)) + 1) / (F.col("total") + n_grams)
    return expanded.select("lang", "gram", F.round(F.log(share) * SCALE).cast("bigint").alias("logp"))


@dataclass(frozen=True)
class Scorer:
    """A model, or a shard of one, as arrays: sorted gram keys, one least
    log-probability per language, and per gram what some languages have above
    theirs."""

    langs: list[str]
    least: np.ndarray
    keys: np.ndarray
    bounds: np.ndarray  # of each gram's entries
    where: np.ndarray  # language of an entry
    more: np.ndarray  # its log-probability above the least

    @classmethod
    def of(cls, langs: list[str], least: np.ndarray, table: pa.Table) -> Scorer:
        """From rows (key, where, more), one per gram."""
        table = table.take(pa.array(np.argsort(table.column("key").to_numpy()))).combine_chunks()
        sizes = pc.list_value_length(table.column("where")).to_numpy()

        def values(name: str) -> np.ndarray:
            return pc.list_flatten(table.column(name)).to_numpy().astype(np.int64)

        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        return cls(langs, least, table.column("key").to_numpy(), bounds, values("where"), values("more"))

    def places(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the found keys stand, and whether they do."""
        if not len(self.keys):
            return np.zeros(len(found), np.int64), np.zeros(len(found), bool)
        at = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        return at, self.keys[at] == found

    def sums(self, doc: np.ndarray, at: np.ndarray, times: np.ndarray, docs: int) -> np.ndarray:
        """(docs, languages + 1): what each text's grams add above the least,
        and in the last column their number. Whole numbers throughout."""
        out = np.zeros((docs, len(self.langs) + 1), np.int64)
        np.add.at(out[:, -1], doc, times)
        size = self.bounds[at + 1] - self.bounds[at]
        entry = np.repeat(self.bounds[at] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        cell = np.repeat(doc, size) * out.shape[1] + self.where[entry]
        np.add.at(out.reshape(-1), cell, self.more[entry] * np.repeat(times, size))
        return out


@dataclass(frozen=True)
class Tables:
    """A model laid out to be looked up by place, for few characters and
    languages: a number per character, a gram's row by its characters' numbers,
    and per language (and for the count) what a row adds. Row 0 adds nothing."""

    numbers: np.ndarray
    base: int
    rows: np.ndarray
    adds: np.ndarray

    @classmethod
    def of(cls, scorer: Scorer) -> Tables | None:
        parts = np.stack([scorer.keys >> 42, scorer.keys >> 21 & 0x1FFFFF, scorer.keys & 0x1FFFFF])
        used = np.unique(parts[parts > 0])
        base = len(used) + 2  # 0: no character, 1: one that the model does not have
        wide = len(scorer.langs) + 1
        if not len(used) or base**3 > TABLE_CELLS or (len(scorer.keys) + 1) * wide > TABLE_CELLS:
            return None
        numbers = np.ones(1 << 21, np.int32)
        numbers[0], numbers[used] = 0, np.arange(2, base)
        a, b, c = numbers[parts].astype(np.int64)
        rows = np.zeros(base**3, np.int32)
        rows[(a * base + b) * base + c] = np.arange(1, len(scorer.keys) + 1)
        adds = np.zeros((wide, len(scorer.keys) + 1), np.int64)
        adds[scorer.where, np.repeat(np.arange(1, len(scorer.keys) + 1), np.diff(scorer.bounds))] = scorer.more
        adds[-1, 1:] = 1
        return cls(numbers, base, rows, adds)

    def sums(self, texts: pd.Series) -> np.ndarray:
        """The same as Scorer.sums of the texts' grams."""
        texts = texts.fillna("")
        length = texts.str.len().to_numpy(np.int64)
        raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        gram = c = self.numbers[raw + 1]
        out = np.zeros((len(length), len(self.adds)), np.int64)
        some = np.flatnonzero(length)
        ends = np.cumsum(length)[some]
        for n in GRAM_SIZES:
            if n > 1:
                gram = gram[:-1] * self.base + c[n - 1 :]
            row = np.zeros(len(c), np.int32)
            row[: len(gram)] = self.rows[gram]
            for over in range(1, n):  # grams that reach over the end of a text
                row[np.maximum(ends - over, 0)] = 0
            for lang, add in enumerate(self.adds if len(some) else ()):
                out[some, lang] += np.add.reduceat(add[row], ends - length[some])
        return out


def verdicts(langs: list[str], least: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
    """Language and posterior per row of Scorer.sums; without known grams
    `unknown` and 0."""
    known = sums[:, -1] > 0
    if not langs or not known.any():
        return pd.DataFrame({"lang": [UNKNOWN] * len(sums), "conf": np.zeros(len(sums))})
    scores = sums[:, :-1] + sums[:, -1:] * least
    p = np.exp((scores - scores.max(axis=1, keepdims=True)) / SCALE)
    names = np.array(langs, object)[p.argmax(axis=1)]
    conf = np.where(known, p.max(axis=1) / p.sum(axis=1), 0.0)
    return pd.DataFrame({"lang": np.where(known, names, UNKNOWN), "conf": conf})


def _pieces(texts: pd.Series, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `most` characters together."""
    ends = np.cumsum(texts.str.len().fillna(0).to_numpy(np.int64))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + most, "right")), first + 1)
        last = min(last, first + MOST_TEXTS)
        yield first, last
        first = last


def _grams(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of all grams of the texts of a piece, packed at once; grams
    that reach over the end of a text are left out."""
    texts = texts.fillna("")
    length = texts.str.len().to_numpy(np.int64)
    found = _packed("".join(texts))
    doc = np.repeat(np.arange(len(length)), length)
    left = np.repeat(np.cumsum(length), length) - np.arange(len(doc))  # characters of the text from here on
    owners, inside = [], []
    for n in GRAM_SIZES:
        some = len(doc) - n + 1
        owners.append(doc[: max(some, 0)])
        inside.append(left[: max(some, 0)] >= n)
    keep = np.concatenate(inside)
    return np.concatenate(owners)[keep], found[keep]


def _piece_counts(texts: pd.Series, most: int = PIECE) -> Iterator[pd.DataFrame]:
    """(key, n) of the grams of about `most` characters of texts at a time."""
    texts = texts[texts.notna() & (texts != "")]
    for a, b in _pieces(texts, most):
        found, n = np.unique(_grams(texts.iloc[a:b])[1], return_counts=True)
        yield pd.DataFrame({"key": found, "n": n})


def _counted(doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, place) with their number; both are below 2^31."""
    both, times = np.unique(doc << 32 | at, return_counts=True)
    return both >> 32, both & 0xFFFFFFFF, times


@F.pandas_udf(T.LongType())
def _gram_key(grams: pd.Series) -> pd.Series:
    return grams.map(lambda g: int(_packed(g)[-1]))


@dataclass(frozen=True)
class PackedModel:
    """A model ready to be sent: rows (key, where, more), one per gram, written;
    their number; languages and their least log-probabilities."""

    rows: DataFrame
    grams: int
    langs: list[str]
    least: np.ndarray

    def scorer(self) -> Scorer:
        """The whole model on the driver; only below a checked number of grams."""
        if not self.langs:
            none = np.zeros(0, np.int64)
            return Scorer([], none, none, np.zeros(1, np.int64), none, none)
        return Scorer.of(self.langs, self.least, self.rows.toArrow())


def packed(model: DataFrame) -> PackedModel:
    """Packed on the executors, one row per gram; languages that never saw a
    gram take no space."""
    least = {r["lang"]: r["least"] for r in model.groupBy("lang").agg(F.min("logp").alias("least")).collect()}
    langs = sorted(least)
    if not langs:
        return PackedModel(model, 0, [], np.zeros(0, np.int64))
    number = F.create_map(*[F.lit(x) for i, lang in enumerate(langs) for x in (lang, i)])
    base = F.create_map(*[F.lit(x) for lang in langs for x in (lang, least[lang])])
    entry = F.struct(number[F.col("lang")].alias("where"), (F.col("logp") - base[F.col("lang")]).alias("more"))
    rows = model.groupBy("gram").agg(F.filter(F.collect_list(entry), lambda e: e["more"] > 0).alias("entries"))
    rows = rows.select(
        _gram_key("gram").alias("key"), F.col("entries.where").alias("where"), F.col("entries.more").alias("more")
    )
    rows = materialize(rows, "packed-model")
    return PackedModel(rows, rows.count(), langs, np.array([least[lang] for lang in langs], np.int64))


def _narrow(df: DataFrame, model: PackedModel, text: Column) -> DataFrame:
    """Adds `_tag`, the model going to every task."""
    shared = df.sparkSession.sparkContext.broadcast(model.scorer())

    @F.pandas_udf("lang string, conf double")
    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = shared.value
        tables = Tables.of(scorer)
        for texts in batches:
            parts = []
            for a, b in _pieces(texts):
                if tables:
                    parts.append(verdicts(scorer.langs, scorer.least, tables.sums(texts.iloc[a:b])))
                    continue
                doc, found = _grams(texts.iloc[a:b])
                at, known = scorer.places(found)
                sums = scorer.sums(*_counted(doc[known], at[known]), b - a)
                parts.append(verdicts(scorer.langs, scorer.least, sums))
            yield pd.concat(parts) if parts else verdicts([], scorer.least, np.zeros((0, 1), np.int64))

    # Marked so that the confidence gate is not pushed below the scoring.
    return df.withColumn("_tag", tag.asNondeterministic()(text))


#: unit: a shard of the model and a part of the batches. role 0: grams of the
#: shard (keys, places, counts hold keys, languages and values, `docs` how many
#: a gram has); 1: a batch's distinct grams of the shard, with per text and
#: gram the text, the gram's place and its count.
_PARCEL = "unit int, role int, batch long, keys binary, docs binary, places binary, counts binary"
#: role 0: the row numbers of a batch; 1: texts of it and their sums in a shard.
_SUMS = "batch long, role int, docs binary, sums binary"


def _as_batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[] for _ in fields]
    arrays = [pa.array(list(c), kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _model_parcels(shards: int, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            piece = Scorer.of([], np.zeros(0), pa.Table.from_batches([batch]))
            home = _shard(piece.keys, shards)
            rows = []
            for shard in np.unique(home):
                at = np.flatnonzero(home == shard)
                size = piece.bounds[at + 1] - piece.bounds[at]
                entry = np.repeat(piece.bounds[at] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
                blobs = [x.tobytes() for x in (piece.keys[at], size, piece.where[entry], piece.more[entry])]
                rows += [(int(shard) * parts + part, 0, 0, *blobs) for part in range(parts)]
            yield _as_batch(_PARCEL, rows)

    return run


def _text_parcels(shards: int, parts: int) -> Callable:
    """(row, text) to what each batch asks of each shard, and (unit -1) its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = task << 32
        for batch in batches:
            texts, names = batch.column("_text").to_pandas(), batch.column("_row").to_numpy()
            for a, b in _pieces(texts):
                doc, found = _grams(texts.iloc[a:b])
                keys, place = np.unique(found, return_inverse=True)
                doc, place, times = _counted(doc, place)
                home = _shard(keys, shards)
                rows = [(-1, 0, number, b"", names[a:b].tobytes(), b"", b"")]
                order = np.argsort(home[place], kind="stable")
                cuts = np.searchsorted(home[place[order]], np.arange(shards + 1))
                rank = np.zeros(len(keys), "<u4")
                for shard in np.flatnonzero(np.diff(cuts)):
                    own, at = np.flatnonzero(home == shard), order[cuts[shard] : cuts[shard + 1]]
                    rank[own] = np.arange(len(own))
                    blobs = (keys[own], doc[at].astype("<u4"), rank[place[at]], times[at].astype("<u4"))
                    rows.append((int(shard) * parts + (task + number) % parts, 1, number, *(x.tobytes() for x in blobs)))
                yield _as_batch(_PARCEL, rows)
                number += 1

    return run


def _shard_sums(langs: list[str], least: np.ndarray) -> Callable:
    """Units, sorted by unit and role, to the sums of each batch; a task holds
    one shard and one batch's parcel at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, pieces, scorer = None, [], None

        def held() -> Scorer:
            keys, size, where, more = (
                np.concatenate([np.frombuffer(p[i], np.int64) for p in pieces]) if pieces else np.zeros(0, np.int64)
                for i in range(4)
            )
            start = np.cumsum(size) - size
            order = np.argsort(keys)
            size, start = size[order], start[order]
            entry = np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            return Scorer(langs, least, keys[order], np.append(0, np.cumsum(size)), where[entry], more[entry])

        for batch in batches:
            for row in range(batch.num_rows):
                here, role, number, *blobs = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                if here != unit:
                    unit, pieces, scorer = here, [], None
                if role == 0:
                    pieces.append(blobs)
                    continue
                if scorer is None:
                    scorer, pieces = held(), []
                at, known = scorer.places(np.frombuffer(blobs[0], np.int64))
                doc, place, times = (np.frombuffer(x, "<u4").astype(np.int64) for x in blobs[1:])
                some = known[place]
                names, local = np.unique(doc[some], return_inverse=True)
                sums = scorer.sums(local, at[place[some]], times[some], len(names))
                yield _as_batch(_SUMS, [(number, 1, names.astype("<u4").tobytes(), sums.tobytes())])

    return run


def _batch_verdicts(langs: list[str], least: np.ndarray) -> Callable:
    """Sums, sorted by batch and role, to (row, lang, conf); a task holds one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sums = np.zeros(0, np.int64), np.zeros((0, 0), np.int64)

        def finished() -> pa.RecordBatch:
            out = verdicts(langs, least, sums)
            columns = [pa.array(rows), pa.array(list(out["lang"]), pa.string()), pa.array(out["conf"].to_numpy())]
            return pa.RecordBatch.from_arrays(columns, ["_row", "lang", "conf"])

        for batch in batches:
            for row in range(batch.num_rows):
                role, docs, more = (batch.column(c)[row].as_py() for c in ("role", "docs", "sums"))
                if role == 0:
                    if len(rows):
                        yield finished()
                    rows = np.frombuffer(docs, np.int64)
                    sums = np.zeros((len(rows), len(langs) + 1), np.int64)
                else:
                    sums[np.frombuffer(docs, "<u4")] += np.frombuffer(more, np.int64).reshape(-1, sums.shape[1])
        if len(rows):
            yield finished()

    return run


def _sharded(df: DataFrame, model: PackedModel, text: Column, shard_grams: int) -> DataFrame:
    """Adds `_tag` with the model in shards of about shard_grams grams. Batches
    of texts send their distinct grams once to each shard, and get sums per
    text back; the batches are dealt out over as many copies of the shards as
    fill the shuffle partitions, so that few shards do not mean few tasks."""
    spark = df.sparkSession
    shards = -(-model.grams // shard_grams)
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    # Written, so that a row keeps its number however often it is read.
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-tag")
    sent = materialize(rows.select("_row", text.alias("_text")).mapInArrow(_text_parcels(shards, parts), _PARCEL), "grams")
    known = model.rows.mapInArrow(_model_parcels(shards, parts), _PARCEL)
    work = known.unionByName(sent.filter("unit >= 0")).repartition(shards * parts, "unit")
    sums = work.sortWithinPartitions("unit", "role", "batch").mapInArrow(_shard_sums(model.langs, model.least), _SUMS)
    own = sent.filter("unit < 0").select("batch", "role", "docs", F.col("keys").alias("sums"))
    work = sums.unionByName(own).repartition("batch").sortWithinPartitions("batch", "role")
    told = work.mapInArrow(_batch_verdicts(model.langs, model.least), "_row long, lang string, conf double")
    told = told.select("_row", F.struct("lang", "conf").alias("_tag"))
    return rows.join(told, "_row").drop("_row")


def detect_language(
    df: DataFrame,
    model: DataFrame | PackedModel,
    window: int | None = None,
    column: str = "text",
    shard_grams: int = SHARD_GRAMS,
) -> DataFrame:
    """Add `lang` and the unrounded `conf`; a text without known grams is
    `unknown` with 0.0. A model of at most shard_grams grams goes to every task:
    a narrow step for tables and streams alike. A larger one stays in shards of
    that size, and sums travel instead; the same whole numbers are added up, so
    the tags are the same. On a stream that takes `foreachBatch`."""
    ready = model if isinstance(model, PackedModel) else packed(model)
    text = tx.head(F.col(column), window)
    if ready.grams <= shard_grams:
        tagged = _narrow(df, ready, text)
    elif df.isStreaming:
        raise ValueError("a model in shards tags the tables of foreachBatch, not a stream")
    else:
        tagged = _sharded(df, ready, text, shard_grams)
    return tagged.withColumn("lang", F.col("_tag.lang")).withColumn("conf", F.col("_tag.conf")).drop("_tag")


def confident(df: DataFrame, minimum: float = 0.8) -> DataFrame:
    """The gate compares the unrounded confidence; rounding comes after it."""
    return df.filter(F.col("conf") >= minimum)


def tag_documents(
    df: DataFrame, model: DataFrame | PackedModel, s: Settings = Settings(), shard_grams: int = SHARD_GRAMS
) -> DataFrame:
    """Language, gate, rounded confidence, domain."""
    detected = detect_language(df, model, s.lang_window, shard_grams=shard_grams)
    tagged = confident(detected, s.min_lang_confidence)
    return tagged.withColumns(
        {
            "lang_confidence": F.round("conf", 3),
            "domain": domain.domain_of(F.col("text"), s.domain_window),
        }
    ).drop("conf")


def language_histogram(df: DataFrame, top: int = 15) -> DataFrame:
    """The most frequent languages; ties by name."""
    return df.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")).orderBy(F.desc("docs"), "lang").limit(top)
