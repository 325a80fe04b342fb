import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import odd
from textloom.llm import crossentropy, postings, queries


def plain(rows, target, most=crossentropy.VOCABULARY_MOST):
    """The same losses with dictionaries: rows (id, text), target a set of ids."""
    texts = [(i, (t or "").lower().split()) for i, t in rows]
    t_count = Counter(w for i, ws in texts if i in target for w in ws)
    vocabulary = {w for w, n in t_count.items() if n > 1}
    assert len(vocabulary) <= most
    sent = [(i, [w if w in vocabulary else "?" for w in ws] + ["$"]) for i, ws in texts]
    size = len(vocabulary) + 2

    def model(some):
        one = Counter(w for ws in some for w in ws)
        two = Counter(p for ws in some for p in zip(ws, ws[1:]))
        after, kinds = Counter(), Counter()
        for (v, _), n in two.items():
            after[v] += n
            kinds[v] += 1
        total = sum(one.values())
        p1 = lambda w: (one[w] + 1) / (total + size)

        def loss(ws):
            out = math.log(p1(ws[0]))
            for v, w in zip(ws, ws[1:]):
                p = (two[v, w] + kinds[v] * p1(w)) / (after[v] + kinds[v]) if after[v] else p1(w)
                out += math.log(p)
            return -out / len(ws)

        return loss

    everything, chosen = model([ws for _, ws in sent]), model([ws for i, ws in sent if i in target])
    return [(i, len(ws) - 1, chosen(ws), everything(ws), chosen(ws) - everything(ws)) for i, ws in sent]


def found(df):
    names = ("doc_id", "n_tokens", "target_loss", "background_loss", "score")
    return [tuple(r[n] for n in names) for r in df.collect()]


def close(got, want):
    got, want = (sorted(x, key=lambda r: (r[0] is None, r[0] or 0, r[3])) for x in (got, want))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:] == pytest.approx(w[2:], abs=1e-9)


def corpus():
    rows = [(i, odd.prose(i % 7, 30 + i % 50), "en", "", 0) for i in range(120)]
    rows += [(200 + i, " ".join(f"other{(i * k) % 90} the" for k in range(40)), "en", "", 0) for i in range(60)]
    return rows


@pytest.mark.parametrize("hot", [20_000, 50])
def test_against_dictionaries(spark, monkeypatch, hot):
    monkeypatch.setattr(crossentropy, "HOT_SHARE", hot)
    rows = corpus() + [r for r in odd.ROWS if r[0] != 7]
    target = {i for i in range(0, 120, 2)} | {2, 8}
    ids = spark.createDataFrame([(i,) for i in target] + [(None,), (5_000,), (2,)], "doc_id long")
    got = found(crossentropy.score(odd.documents(spark, rows).repartition(4), ids))
    close(got, plain([r[:2] for r in rows], target))
    inside = [g[4] for g in got if g[0] is not None and 0 < g[0] < 120]
    outside = [g[4] for g in got if g[0] is not None and g[0] >= 200]
    assert max(inside) < min(outside)


@pytest.mark.parametrize("most, hot", [(20, 20_000), (20, 50), (0, 50)])
def test_words_beyond_the_broadcast_ones_count(spark, monkeypatch, most, hot):
    """All words seen twice in the target are told apart, also those that do not fit."""
    monkeypatch.setattr(crossentropy, "VOCABULARY_MOST", most)
    monkeypatch.setattr(crossentropy, "HOT_SHARE", hot)
    rows = corpus() + [r for r in odd.ROWS if r[0] != 7]
    target = {i for i in range(0, 120, 2)} | {2, 8, 205, 210}
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    got = found(crossentropy.score(odd.documents(spark, rows).repartition(4), ids))
    close(got, plain([r[:2] for r in rows], target, 10_000))


def test_long_text_no_target_and_empty(spark):
    got = found(crossentropy.score(odd.documents(spark), spark.createDataFrame([], "doc_id long")))
    assert len(got) == len(odd.ROWS) and all(math.isfinite(x) for g in got for x in g[2:])
    assert crossentropy.score(odd.empty(spark), spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_query_against_dictionaries(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r["doc_id"] for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    close(found(queries.op7_entropy_difference(spark, sf)), plain(rows, good))


def test_vocabulary_keeps_whole_counts(spark):
    counts = spark.createDataFrame([(i, 9, n) for i, n in enumerate([5, 5, 3, 3, 3, 2, 1])], "word long, n long, in_target long")
    words, unigrams = crossentropy.vocabulary(counts, 4)
    assert sorted(words.hashes.tolist()) == [0, 1] and unigrams.sum(axis=0).tolist() == [18, 10]
    assert len(crossentropy.vocabulary(counts, 5)[0].hashes) == 5


def test_counts_merged_as_they_come(monkeypatch):
    """Parcels of many batches, merged ever and again, sum up as a dictionary
    does; a request meets the whole of its shard."""
    monkeypatch.setattr(postings, "PENDING", 5)
    rng = np.random.default_rng(3)
    parcels, want = [], Counter()
    for batch in range(40):
        keys = rng.integers(0, 60, 25).astype(np.uint64)
        marks = rng.integers(0, 2, 25).astype(bool)
        for k, m in zip(keys.tolist(), marks.tolist(), strict=True):
            want[k, 0] += 1
            want[k, 1] += m
        parcels.append(postings.count_parcels(keys, marks, 3, batch, "<u8"))
    table = pa.Table.from_batches(parcels).sort_by("shard").combine_chunks()
    got = Counter()
    for out in postings.sum_counts("<u8")(iter(table.to_batches(max_chunksize=7))):
        for row in out.to_pylist():
            keys = np.frombuffer(row["keys"], "<u8")
            assert (np.diff(keys.astype(np.int64)) > 0).all()
            for i, c in enumerate(("a", "b")):
                got.update({(k, i): n for k, n in zip(keys.tolist(), np.frombuffer(row[c], "<i8").tolist(), strict=True)})
    assert +got == +want

    names = np.arange(0, 50, 2).astype(np.uint64)
    model = [postings.parcel([[0], [0], [0], [n.tobytes()], [(n * 3).astype("<u4").tobytes()], [b""]]) for n in (names[9:], names[:9])]
    asks = [postings.parcel([[0], [1], [b], [names[b:].tobytes()], [b""], [b""]]) for b in (4, 5)]
    for (shard, batch, keys, _), held, values in postings.served(iter([*model, *asks]), "<u8", "<u4"):
        assert shard == 0 and keys.tolist() == names[batch:].tolist()
        assert held.tolist() == names.tolist() and values.tolist() == (names * 3).tolist()


@pytest.mark.parametrize("n", [0, 1, 7, 40])
def test_layouts_round_trip(n):
    rng = np.random.default_rng(n)
    keys = np.sort(rng.integers(0, 1 << 64, n, np.uint64, endpoint=False) | np.uint64(n and 1 << 63))
    values = rng.normal(size=(n, 2))
    assert postings.from_steps(postings.steps(keys, "<u8"), "<u8").tolist() == keys.tolist()
    assert postings.from_planes(postings.planes(values[:, 1]), "<f8").tolist() == values[:, 1].tolist()


def test_models_in_pieces_add_up(monkeypatch):
    """A shard's model in many rows, over several batches, gives the sums of a dictionary."""
    monkeypatch.setattr(postings, "PIECE", 4)
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 50, 30).astype(np.uint64))
    gains = rng.normal(size=(len(keys), 2))
    model = postings.pieces(0, 0, [keys, gains[:, 0], gains[:, 1]], postings.model_layout("<u8"))
    met = rng.integers(0, len(keys) + 3, 200)  # some that the model has not
    doc = rng.integers(0, 9, 200)
    every = np.append(keys, [1 << 51, 1 << 52, 1 << 53]).astype(np.uint64)
    sent = postings.posting_parcels(every[met], doc, 1, 7, "<u8")
    table = pa.Table.from_batches([*model, sent]).combine_chunks()
    assert table.num_rows > 5
    got = np.zeros((9, 2))
    for out in postings.add_up("<u8", crossentropy.as_gains)(iter(table.to_batches(max_chunksize=3))):
        for row in out.to_pylist():
            docs = np.frombuffer(row["keys"], "<u2")
            got[docs] += np.stack([np.frombuffer(row[c], "<f8") for c in ("a", "b")], axis=1)
    want = np.zeros((9, 2))
    for k, d in zip(met, doc, strict=True):
        if k < len(keys):
            want[d] += gains[k]
    assert got == pytest.approx(want)


def test_counts_in_pieces(monkeypatch):
    monkeypatch.setattr(postings, "PIECE", 4)
    keys = np.repeat(np.arange(10, 31, 2), 3).astype(np.uint64)
    sent = postings.count_parcels(keys, keys % np.uint64(4) == 0, 1, 0, "<u8")
    out = list(postings.sum_counts("<u8")(iter([sent, sent])))
    assert [b.column("batch")[0].as_py() for b in out] == [0, 1, 2]
    read = lambda c, kind: np.concatenate([np.frombuffer(b.column(c)[0].as_py(), kind) for b in out])
    assert read("keys", "<u8").tolist() == list(range(10, 31, 2))
    assert read("a", "<i8").tolist() == [6] * 11
    assert read("b", "<i8").tolist() == [6 * (k % 4 == 0) for k in range(10, 31, 2)]
