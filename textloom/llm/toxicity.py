"""Toxicity by cumulative-link ordinal regression on sparse word features.

Grades of severity 0 to 3 share one weight per feature and are told apart by
ordered thresholds: P(grade > k) = sigmoid(w x - t_k). The expected severity is
the sum of these over k. Features are a document's bare lower-case words and
the first 4, 5 and 6 bytes of each, weighted by log(1 + times); only those are kept
that toxic training documents have more often than others, beyond chance.

Labels that only say toxic or not give the grades 1 to 3 to thirds of the toxic
training documents, by the share of their words that are marker words.

Fitting takes at most TRAIN_MOST labelled documents of each kind (all of them,
if fewer; else drawn by a hash of the id), a documented bound; the ids drawn
and the weights (at most FEATURES_MOST) are small enough to broadcast. Every
document is scored, whole.

Defined cases: a null or empty text has no features and gets the severity of an
empty document and none is fitted on; labels that are null, or of documents that do not exist, are
left out; of several labels of a document the worst counts; without toxic labels nothing is
toxic (severity 0); columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import APART, forget, lowered, mix, prefix_hash, sliced, span_hash, word_spans, written

TRAIN_MOST = 5_000
FEATURES_MOST = 1 << 16
HEADS = (4, 5, 6)
GRADES = 4
MARKER = 2.5  # z-score beyond which a feature is kept
SLOTS = 20  # bits of the quick look-up


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text) of every feature occurrence, and the words of each text."""
    raw, start, end, bounds = word_spans(lowered(texts), APART)
    sums = prefix_hash(raw)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    hashes = [span_hash(sums, start, end)]
    for size in HEADS:
        salt = mix(np.array([size], np.uint64))
        hashes.append(span_hash(sums, start, np.minimum(end, start + size)) ^ salt)
    return np.concatenate(hashes), np.tile(doc, len(hashes)), np.diff(bounds)


def tally(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, hash) with the number of times."""
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    return doc[head], hashes[head], np.diff(np.append(head, len(doc)))


FEATURE_ROWS = "doc_id long, toxic int, words long, features array<long>, times array<int>"


def lists(doc: np.ndarray, n: int, values: np.ndarray) -> pa.Array:
    """Values sorted by text as one list a text."""
    bounds = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, toxic, text) to FEATURE_ROWS."""
    for batch in sliced(batches, "text", 2 << 20):
        hashes, doc, words = features(batch.column("text"))
        doc, hashes, times = tally(hashes, doc)
        columns = [batch.column("doc_id"), batch.column("toxic"), pa.array(words)]
        columns += [lists(doc, batch.num_rows, x) for x in (hashes.view(np.int64), times.astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "words", "features", "times"])


def marked(names: np.ndarray) -> Callable:
    """FEATURE_ROWS to the same with only the features of `names`, as places in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = batch.column("features")
            hashes = each.flatten().to_numpy().view(np.uint64)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(each.offsets.to_numpy()))
            place = np.minimum(np.searchsorted(names, hashes), max(len(names) - 1, 0))
            hit = names[place] == hashes if len(names) else np.zeros(len(hashes), bool)
            times = batch.column("times").flatten().to_numpy()
            columns = [batch.column(c) for c in ("doc_id", "toxic", "words")]
            columns += [lists(doc[hit], batch.num_rows, x[hit].astype(np.int32)) for x in (place, times)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "toxic", "words", "features", "times"])

    return run


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k), a column per threshold."""
        return sigmoid(score[:, None] - self.thresholds)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def training_rows(documents: DataFrame, labels: DataFrame, most: int = TRAIN_MOST) -> DataFrame:
    """(doc_id, toxic, text) of at most about `most` labelled documents a kind."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share = F.lit(0).cast("long")
    for kind, n in sizes.items():
        share = F.when(F.col("toxic") == kind, F.lit(int(min(1.0, most / n) * (1 << 30)))).otherwise(share)
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 30)) < share)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.join(F.broadcast(drawn), "doc_id")  # about 2 * most ids


def fit(documents: DataFrame, labels: DataFrame, most: int = TRAIN_MOST) -> Model:
    rows = training_rows(documents, labels, most).select("doc_id", "toxic", "text")
    rows = written(rows.mapInArrow(feature_rows, FEATURE_ROWS).filter("words > 0"), "toxic-features")
    kinds = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.countDistinct("doc_id").alias("n")).collect()}
    if len(kinds) < 2:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, 50.0))
    toxic, clean = F.lit(float(kinds[1])), F.lit(float(kinds[0]))
    seen = rows.select("toxic", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    )
    rate = (F.col("a") + F.col("b") + 1) / (toxic + clean + 2)
    gap = (F.col("a") + 0.5) / (toxic + 1) - (F.col("b") + 0.5) / (clean + 1)
    z = gap / F.sqrt(rate * (1 - rate) * (1 / toxic + 1 / clean))
    strong = seen.withColumn("z", z).filter((F.col("z") >= MARKER) & (F.col("a") + F.col("b") >= 3))
    strong = strong.orderBy(F.desc("z"), "feature").limit(FEATURES_MOST).select("feature").collect()
    names = np.sort(np.array([r["feature"] for r in strong], np.int64).view(np.uint64))
    # Some thousand rows of the bounded sample: one task fits them.
    marks = rows.mapInArrow(marked(names), FEATURE_ROWS.replace("<long>", "<int>")).repartition(1)
    fitted = marks.mapInArrow(fit_rows(len(names)), "weights binary, thresholds binary").first()
    forget(rows)
    return Model(
        names,
        np.frombuffer(fitted["weights"], np.float64),
        np.frombuffer(fitted["thresholds"], np.float64),
    )


def fit_rows(width: int) -> Callable:
    """Marked feature rows of all training documents to one row: the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        # Rows that repeat an id are one document here, as its label is one.
        ids, row = np.unique(table.column("doc_id").to_numpy(), return_inverse=True)
        toxic, words = np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64)
        np.maximum.at(toxic, row, table.column("toxic").to_numpy())
        np.maximum.at(words, row, table.column("words").to_numpy())
        each = table.column("features").combine_chunks()
        doc = np.repeat(row, np.diff(each.offsets.to_numpy()))
        column = each.flatten().to_numpy()
        times = table.column("times").combine_chunks().flatten().to_numpy()
        by = np.lexsort((times, column, doc))  # one order of summands, whatever the tasks
        doc, column, times = doc[by], column[by], times[by]
        density = np.bincount(doc, times, len(words)) / words
        weights, thresholds = regress(doc, column, np.log1p(times), grades(toxic, density), width)
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (weights, thresholds)]
        yield pa.RecordBatch.from_arrays(blobs, ["weights", "thresholds"])

    return run


def grades(toxic: np.ndarray, density: np.ndarray) -> np.ndarray:
    """0 for the others; 1, 2, ... for equal parts of the toxic by density."""
    out = np.zeros(len(toxic), np.int64)
    cuts = np.quantile(density[toxic == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    out[toxic == 1] = 1 + np.searchsorted(cuts, density[toxic == 1], "right")
    return out


def regress(
    doc: np.ndarray,
    column: np.ndarray,
    value: np.ndarray,
    grade: np.ndarray,
    width: int,
    ridge: float = 1e-5,
    rate: float = 0.1,
    rounds: int = 1_000,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and increasing thresholds of greatest penalised likelihood, by
    gradient steps scaled per parameter.

    Likelihood of a grade: sigmoid(u_k) - sigmoid(l_k) between its two
    thresholds; the gaps of the thresholds are kept positive as exponentials.
    """
    n, gaps = len(grade), GRADES - 2
    share = np.clip(np.cumsum(np.bincount(grade, minlength=GRADES))[:-1] / n, 1e-3, 1 - 1e-3)
    first = np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(width), first[:1], np.log(np.maximum(np.diff(first), 0.1))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, cut, steps = theta[:width], theta[width], np.exp(theta[width + 1 :])
        thresholds = np.concatenate([[-np.inf], cut + np.concatenate([[0], np.cumsum(steps)]), [np.inf]])
        score = np.bincount(doc, w[column] * value, n)
        upper = sigmoid(np.clip(thresholds[grade + 1] - score, -40, 40))
        lower = np.where(grade == 0, 0.0, sigmoid(np.clip(thresholds[grade] - score, -40, 40)))
        upper = np.where(grade == GRADES - 1, 1.0, upper)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p / n, lower * (1 - lower) / p / n
        by_score = du - dl  # gradient of the negative log-likelihood
        by_cut = np.bincount(grade + 1, -du, GRADES + 1) + np.bincount(grade, dl, GRADES + 1)
        by_cut = by_cut[1:GRADES]
        slope = np.empty_like(theta)
        slope[:width] = np.bincount(column, by_score[doc] * value, width) + ridge * w
        slope[width] = by_cut.sum()
        slope[width + 1 :] = [by_cut[k + 1 :].sum() * steps[k] for k in range(gaps)]
        m = 0.9 * m + 0.1 * slope
        v = 0.99 * v + 0.01 * slope**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    steps = np.exp(theta[width + 1 :])
    return theta[:width], theta[width] + np.concatenate([[0], np.cumsum(steps)])


def scorer(model: Model) -> Callable:
    """(row, text) to (row, severity, toxic_p, grade)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quick = np.zeros(1 << SLOTS, bool)
        quick[model.features >> np.uint64(64 - SLOTS)] = True
        for batch in sliced(batches, "text", 4 << 20):
            hashes, doc, _ = features(batch.column("text"))
            maybe = np.flatnonzero(quick[hashes >> np.uint64(64 - SLOTS)])
            hashes, doc = hashes[maybe], doc[maybe]
            place = np.minimum(np.searchsorted(model.features, hashes), max(len(model.features) - 1, 0))
            hit = model.features[place] == hashes if len(model.features) else np.zeros(len(hashes), bool)
            who, which, times = tally(place[hit].astype(np.uint64), doc[hit])
            score = np.bincount(who, model.weights[which.astype(np.int64)] * np.log1p(times), batch.num_rows)
            above = model.above(score)
            at_least = np.concatenate([np.ones((len(score), 1)), above, np.zeros((len(score), 1))], axis=1)
            grade = np.argmax(at_least[:, :-1] - at_least[:, 1:], axis=1).astype(np.int32)
            columns = [*batch.columns, *map(pa.array, (above.sum(axis=1), above[:, 0], grade))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "severity", "toxic_p", "severity_grade"])

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """`documents` with `severity` (expected grade), `toxic_p` (P(grade > 0)) and
    `severity_grade` (the likeliest); columns of these names are replaced."""
    own = ("severity", "toxic_p", "severity_grade")
    docs = documents.drop(*(c for c in own if c in documents.columns)).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType(docs.schema.fields[:]).add("severity", "double").add("toxic_p", "double")
    return docs.mapInArrow(scorer(model), schema.add("severity_grade", "integer"))


def rejected() -> Column:
    """Documents that are more likely toxic than not."""
    return F.col("toxic_p") >= 0.5
