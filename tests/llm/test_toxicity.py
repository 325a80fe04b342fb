import numpy as np
from pyspark.sql import functions as F

from tests.llm import odd
from textloom.llm import queries, toxicity

DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    model = toxicity.fit(docs, labels.filter(~held))
    scored = toxicity.score(docs.join(labels.filter(held & (F.col("quality") == 1)), "doc_id"), model)
    rows = [(r["toxic"], r["toxic_p"], r["severity"]) for r in scored.select("toxic", "toxic_p", "severity").collect()]
    y, p, severity = map(np.array, zip(*rows))
    assert (p[y == 1] >= 0.5).mean() > 0.85 and (p[y == 0] >= 0.5).mean() < 0.03
    assert severity[y == 1].mean() > 1 > 0.2 > severity[y == 0].mean()


def toxic_corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        times = i // 4 % 3 * 3 + 1
        rows.append((i, odd.prose(i, 40) + " dreadfulword" * (times * toxic), "en", "", 0))
        labels.append((i, int(toxic)))
    return rows, labels


def test_grades_follow_the_density(spark):
    rows, labels = toxic_corpus()
    docs = odd.documents(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert (np.diff(model.thresholds) > 0).all()
    scored = toxicity.score(docs, model)
    assert set(odd.CLASHING) <= set(scored.columns)
    got = {r["doc_id"]: r for r in scored.collect()}
    assert all((got[i]["toxic_p"] >= 0.5) == (i % 4 == 0) for i in range(400))
    mean = [np.mean([got[i]["severity"] for i in range(0, 400, 4) if i // 4 % 3 == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2] <= 3


def test_odd_rows(spark):
    rows, labels = toxic_corpus(80)
    docs = odd.documents(spark, rows + [(*r,) for r in odd.ROWS])
    odd_labels = [*labels, (None, 1), (7, None), (1_000_000, 1), (0, 1), (0, 1)]
    model = toxicity.fit(docs, spark.createDataFrame(odd_labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == 80 + len(odd.ROWS)
    blank = {r["severity"] for r in got if not (r["text"] or "").strip()}
    assert len(blank) == 1 and blank.pop() < 0.5
    assert toxicity.score(odd.empty(spark), model).count() == 0


def test_without_toxic_labels_nothing_is_toxic(spark):
    docs = odd.documents(spark)
    for labels in ([], [(1, 0), (2, 0)]):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert all(r["severity"] < 1e-9 for r in toxicity.score(docs, model).collect())


def test_features_are_words_and_heads():
    import pyarrow as pa

    hashes, doc, words = toxicity.features(pa.array(["Loser, LOSER! losers", None]))
    assert words.tolist() == [3, 0] and len(hashes) == 12 and (doc == 0).all()
    assert len(set(hashes[:3].tolist())) == 2 and len(set(hashes[6:9].tolist())) == 1


def test_query_covers_every_document(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op5_ordinal_toxicity(spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
