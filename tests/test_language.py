import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.operators import domain as dm
from textloom.operators import language as lg

SAMPLES = {
    "en": ["the house and the garden of the king", "this is what they said to the other men", "when will they come home"],
    "de": ["das haus und der garten des königs", "das ist was sie den anderen sagten", "wann kommen sie nach hause"],
    "fr": ["la maison et le jardin du roi", "c'est ce qu'ils ont dit aux autres", "quand viendront-ils à la maison"],
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(lang, t) for lang, texts in SAMPLES.items() for t in texts]
    return lg.fit(spark.createDataFrame(rows, "lang string, text string")).cache()


@pytest.fixture(scope="module")
def texts(spark):
    rows = [("1", "the other garden"), ("2", "der könig und die anderen"), ("3", "la maison du roi"), ("4", ""), ("5", "漢字")]
    return spark.createDataFrame(rows, "id string, text string")


def test_model_has_every_gram_for_every_language(model):
    counts = [r["count"] for r in model.groupBy("gram").count().collect()]
    assert set(counts) == {3}


def test_tags_of_unseen_texts(texts, model):
    got = {r.id: r for r in lg.detect_language(texts, model).collect()}
    assert [got[i].lang for i in "12345"] == ["en", "de", "fr", "unknown", "unknown"]
    assert got["4"].conf == 0.0 and got["1"].conf > 0.8


def test_every_row_by_its_own_text(spark, model):
    """Repeated and null ids, null texts, and a model without rows."""
    rows = [("1", "the other garden"), ("1", "la maison du roi"), (None, "der könig und die anderen"), ("2", None)]
    df = spark.createDataFrame(rows, "id string, text string")
    got = [(r.id, r.lang) for r in lg.detect_language(df, model).collect()]
    assert sorted(got, key=str) == sorted([("1", "en"), ("1", "fr"), (None, "de"), ("2", "unknown")], key=str)
    assert {r.lang for r in lg.detect_language(df, model.filter("false")).collect()} == {"unknown"}


def test_sparse_scores_equal_the_dense_sum(texts, model):
    table = {}
    for r in model.collect():
        table.setdefault(r.gram, {})[r.lang] = r.logp
    for r in lg.detect_language(texts, model).collect():
        grams = [r.text[i : i + n] for n in (1, 2, 3) for i in range(len(r.text) - n + 1)]
        sums = {k: sum(table[g][k] for g in grams if g in table) for k in SAMPLES}
        if any(g in table for g in grams):
            assert r.lang == max(sums, key=sums.get)


@pytest.mark.parametrize("shard_grams", [7, 100])
def test_shards_of_the_model_give_the_same_tags(spark, model, shard_grams):
    """Sums that travel are the sums of one table: tags and confidences are
    equal to the last bit, for repeated and null rows and for long texts too."""
    rows = [(str(i % 5), t) for i, t in enumerate(t for texts in SAMPLES.values() for t in texts)]
    rows += [("8", None), (None, ""), (None, "漢字"), ("9", "the house " * 70_000), ("9", "é"), ("9", "𝒳 la 𝒳"), ("9", "und")]
    df = spark.createDataFrame(rows, "id string, text string").repartition(3)
    whole = lg.detect_language(df, model)
    shards = lg.detect_language(df, model, shard_grams=shard_grams)
    assert shards.columns == whole.columns and shards.count() == len(rows)
    assert sorted(map(str, shards.collect())) == sorted(map(str, whole.collect()))
    assert lg.detect_language(df.limit(0), model, shard_grams=shard_grams).collect() == []


def test_pieces_of_a_batch_give_the_same_grams():
    texts = pd.Series(["ab", None, "", "x", "yzw", "𝒳é"])
    for most in (1, 3, 100):
        got = []
        for a, b in lg._pieces(texts, most):
            doc, keys = lg._grams(texts.iloc[a:b])
            got += [(a + d, lg._unpacked(k)) for d, k in zip(doc.tolist(), keys.tolist(), strict=True)]
        want = [(i, t[j : j + n]) for i, t in enumerate(texts.fillna("")) for n in (1, 2, 3) for j in range(len(t) - n + 1)]
        assert sorted(got) == sorted(want)


def test_grams_are_counted_a_bounded_piece_at_a_time():
    texts = pd.Series([None, "", "a", "ab", *["abc" * 50] * 20, "é漢😀x", None])
    pieces = list(lg._piece_counts(texts, 300))
    assert max(p["n"].sum() for p in pieces) <= 3 * 300 and len(pieces) >= 10
    want = Counter(t[i : i + n] for t in texts if t for n in (1, 2, 3) for i in range(len(t) - n + 1))
    got = Counter()
    for p in pieces:
        got.update({lg._unpacked(k): n for k, n in zip(p["key"].tolist(), p["n"].tolist(), strict=True)})
    assert got == want
    assert list(lg._piece_counts(pd.Series([None, ""], dtype=object))) == []


def test_gate_compares_before_rounding(spark):
    df = spark.createDataFrame([(0.79996,), (0.8,)], "conf double")
    assert [r.conf for r in lg.confident(df).collect()] == [0.8]


@pytest.mark.parametrize(
    "text, domain",
    [
        ("import numpy", "code"),
        ("A Theorem in algebra today", "math"),
        ("def f(): the theorem", "code"),
        ("The PATIENT hereinafter", "legal"),
        ("breaking news", "news"),
        ("nothing", "web"),
        ("x" * 493 + "theorem", "math"),
        ("x" * 494 + "theorem", "math"),
        (None, "web"),
    ],
)
def test_domain(spark, text, domain):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(dm.domain_of(F.col("t")).alias("d")).first().d == domain


def test_histogram_breaks_ties_by_name(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacd"], "lang string")
    assert [(r.lang, r.docs) for r in lg.language_histogram(df, 3).collect()] == [("a", 2), ("b", 2), ("c", 1)]


def test_tables_add_up_as_the_scorer_does(monkeypatch):
    r = random.Random(1)
    for case in range(80):
        alphabet, langs = "abé漢\U0001f600"[: r.randint(1, 5)], [str(i) for i in range(r.randint(1, 3))]
        grams = sorted({"".join(r.choices(alphabet, k=r.randint(1, 3))) for _ in range(r.randint(1, 40))})
        where = [sorted(r.sample(range(len(langs)), r.randint(0, len(langs)))) for _ in grams]
        more = [[r.randint(1, 10**6) for _ in w] for w in where]
        lists = pa.list_(pa.int64())
        rows = {"key": [int(lg._packed(g)[-1]) for g in grams], "where": pa.array(where, lists), "more": pa.array(more, lists)}
        scorer = lg.Scorer.of(langs, np.full(len(langs), -5 * 10**6), pa.table(rows))
        texts = [None, ""] + ["".join(r.choices(alphabet + "zq", k=r.choice([0, 1, 2, 3, 9]))) for _ in range(case % 9)]
        r.shuffle(texts)
        texts = pd.Series(texts, dtype=object)
        doc, found = lg._grams(texts)
        at, known = scorer.places(found)
        assert (lg.Tables.of(scorer).sums(texts) == scorer.sums(*lg._counted(doc[known], at[known]), len(texts))).all()
        monkeypatch.setattr(lg, "TABLE_CELLS", 5)
        assert lg.Tables.of(scorer) is None
        monkeypatch.undo()
