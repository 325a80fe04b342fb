import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from textloom.llm import kneser, queries


class Plain:
    """Interpolated modified Kneser-Ney with dictionaries, from its definition."""

    def __init__(self, texts):
        sent = [["<b>", "<b>", *(t or "").lower().split(), "</b>"] for t in texts]
        self.three = Counter(x for s in sent for x in zip(s, s[1:], s[2:]))
        left = defaultdict(set)
        for u, v, w in self.three:
            left[v, w].add(u)
        own = Counter()
        for (_, v, w), n in self.three.items():
            own[v, w] += n
        self.two = Counter({k: own[k] if k[0] == "<b>" else len(left[k]) for k in own})
        self.one = Counter(w for _, w in self.two)
        self.d = [self.discounts(c) for c in (self.one, self.two, self.three)]
        self.kinds = len(self.one) + 1
        self.after2, self.after3 = defaultdict(list), defaultdict(list)
        for (v, _), n in self.two.items():
            self.after2[v].append(n)
        for (u, v, _), n in self.three.items():
            self.after3[u, v].append(n)

    @staticmethod
    def discounts(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        if not n[0] or not n[1]:
            return [0.5] * 3
        y = n[0] / (n[0] + 2 * n[1])
        out = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * (n[3] / n[2] if n[2] else 0)]
        return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(out)]

    def part(self, count, seen, d, lower):
        if not seen:
            return lower
        left = sum(d[min(c, 3) - 1] for c in seen)
        return ((count - d[min(count, 3) - 1] if count else 0) + left * lower) / sum(seen)

    def p(self, u, v, w):
        p1 = self.part(self.one[w], list(self.one.values()), self.d[0], 1 / self.kinds)
        p2 = self.part(self.two[v, w], self.after2.get(v), self.d[1], p1)
        return self.part(self.three[u, v, w], self.after3.get((u, v)), self.d[2], p2)

    def loss(self, text):
        s = ["<b>", "<b>", *(text or "").lower().split(), "</b>"]
        return -sum(math.log(self.p(*x)) for x in zip(s, s[1:], s[2:])) / (len(s) - 2)


@pytest.mark.parametrize("hot", [20_000, 30])
def test_losses_against_the_definition(spark, monkeypatch, hot):
    monkeypatch.setattr(kneser, "HOT_SHARE", hot)
    texts = [odd.prose(i % 9, 20 + i % 40) + " the end of it" * (i % 3) for i in range(80)] + ["", None, "one", "one two"]
    model = kneser.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    plain = Plain(texts)
    rows = [(i, t, "en", "", 0) for i, t in enumerate([*texts[:20], "new words only here", odd.prose(11, 60), "", None, "two one"])]
    docs = odd.documents(spark, rows).select("doc_id", "lang", "text").repartition(3)
    for r in kneser.losses(docs, model).collect():
        assert r["loss"] == pytest.approx(plain.loss(rows[r["doc_id"]][1]), abs=1e-9)


@pytest.mark.parametrize(("split", "coded"), [(1, 0), (60, 1 << 18), (60, 30)])
def test_losses_where_middle_words_are_parted(spark, monkeypatch, split, coded):
    monkeypatch.setattr(kneser, "SPLIT", split)
    monkeypatch.setattr(kneser, "CODED", coded)
    texts = [odd.prose(i % 9, 20 + i % 40) + " the end of the end it is the end" * (i % 3) for i in range(80)] + ["", None, "the"]
    model = kneser.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    assert (model.hot.parts > 1).sum() >= (split > 1)
    assert len(model.code) <= coded and (len(model.code) > 0) == (coded > 0)
    plain = Plain(texts)
    rows = [(i, t, "en", "", 0) for i, t in enumerate([*texts[:20], "end the new words", odd.prose(11, 60), "", None, "the the the"])]
    docs = odd.documents(spark, rows).select("doc_id", "lang", "text").repartition(3)
    for r in kneser.losses(docs, model).collect():
        assert r["loss"] == pytest.approx(plain.loss(rows[r["doc_id"]][1]), abs=1e-9)


def test_batches_that_change_from_pass_to_pass(spark):
    texts = [odd.prose(i % 9, 20 + i % 40) for i in range(80)]
    model = kneser.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    plain = Plain(texts)
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts[:40])], "doc_id long, lang string, text string")
    got = kneser.losses(docs.orderBy(F.rand().alias("r")).withColumn("_r", F.rand()).filter("_r >= 0").drop("_r"), model)
    moving = kneser.losses(docs.repartition(3, F.expr("uuid()")), model)
    for r in [*got.collect(), *moving.collect()]:
        assert r["loss"] == pytest.approx(plain.loss(texts[r["doc_id"]]), abs=1e-9)


def test_counts_take_little_space(spark):
    draw = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in range(400)]
    texts = [" ".join(words[int(k)] for k in np.minimum(draw.zipf(1.3, 300), 4000) - 1) for _ in range(400)]
    model = kneser.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    sizes = [len(r[0]) + len(r[1]) + len(r[2]) for r in model.three.select("keys", "a", "b").collect()]
    assert len(sizes) <= model.shards
    events = sum(len(t.split()) + 1 for t in texts)
    assert sum(sizes) < 16 * events  # as places in a dictionary, before compression: no 64-bit hash per n-gram


def test_probabilities_sum_to_one():
    plain = Plain([odd.prose(i % 3, 20) for i in range(6)])
    words = [*plain.one, "unknown"]
    for u, v in list(plain.after3)[:5]:
        assert sum(plain.p(u, v, w) for w in words) == pytest.approx(1)


def test_thresholds_by_language(spark):
    rows, trusted = [], []
    draw = np.random.default_rng(1)
    for i in range(600):
        lang = ("en", "de")[i % 2]
        good = i % 5 > 0
        words = [f"{lang}{(i + k * (i % 4)) % 40}" for k in range(30)] if good else [f"junk{draw.integers(1e6)}" for _ in range(30)]
        rows.append((i, " ".join(words), lang, "", 0))
        if good and i % 3:
            trusted.append((i,))
    df = odd.documents(spark, [*rows, *((900 + i, *r[1:]) for i, r in enumerate(odd.ROWS))])
    got = kneser.classify(df, spark.createDataFrame([*trusted, (None,), (10_000,)], "doc_id long")).collect()
    assert len(got) == 600 + len(odd.ROWS)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert sum(kept[i] for i in range(600) if i % 5) > 0.93 * 480
    assert not any(kept[i] for i in range(0, 600, 5))
    assert len({r["threshold"] for r in got if r["lang"] in ("en", "de")}) == 2


def test_all_trusted_documents_outside_the_held_out_share_are_counted(spark):
    n = 12_000
    docs = spark.range(n).selectExpr("id as doc_id", "'en' as lang", "concat('only', id, ' of them') as text")
    got = kneser.classify(docs, docs.select("doc_id")).select("loss").toPandas()["loss"].to_numpy()
    learnt = got < (got.min() + got.max()) / 2  # a word of its own, known where the document was read
    assert len(got) == n and abs(learnt.sum() - 10_000) < 300


def test_no_trusted_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long")
    got = kneser.classify(odd.documents(spark), none).collect()
    assert len(got) == len(odd.ROWS) and all(r["kept"] for r in got)
    assert kneser.classify(odd.empty(spark), none).count() == 0


def test_query_separates_quality(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(labels[r["doc_id"]], r["kept"]) for r in queries.op10_kneser_quality(spark, sf).collect() if r["doc_id"] in labels]
    good = [k for q, k in got if q == 1]
    bad = [k for q, k in got if q == 0]
    assert sum(good) > 0.96 * len(good) and sum(bad) < 0.3 * len(bad)
