import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import odd
from tests.llm.test_ngram_join import brute as links
from tests.llm.test_suffix import brute as repeats
from textloom.llm import toxicity

DIR = "/root/testdata/sf0.001"
SCHEMA = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What goes into and out of every stage."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('pipeline')}/{name}"
        stage(spark, docs, DIR).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "mixing", "packing"]
    for before, after in steps[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString()


def test_toxicity_stage(spark, steps):
    before, after = steps[0]
    model = toxicity.fit(before, spark.read.parquet(f"{DIR}/labels.parquet"))
    want = {r["doc_id"] for r in toxicity.score(before, model).collect() if r["toxic_p"] < 0.5}
    assert set(rows(after)) == want and 0 < len(want) < before.count()


def test_near_duplicate_stage(steps):
    before, after = steps[1]
    given = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert set(rows(after)) == {i for (i, _), (_, _, label) in zip(given, links(given)) if i == label}


def test_repeat_stage(steps):
    before, after = steps[2]
    given = before.collect()
    got = rows(after)
    assert len(got) == len(given)
    for r, (removed, _, digest) in zip(given, repeats([(r["text"] or "").encode() for r in given], corpus_pipeline.REPEAT_BYTES)):
        text = got[r["doc_id"]]["text"] or ""
        if removed == 0:
            assert text == (r["text"] or "")
        elif all(ord(c) < 128 for c in r["text"]):
            assert hashlib.sha256(text.encode()).hexdigest() == digest
        assert removed == 0 or got[r["doc_id"]]["n_chars"] == len(text)


def test_mixing_stage(steps):
    before, after = steps[3]
    tokens = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
    assert tokens(after) == tokens(before) * 3 // 4
    given = rows(before)
    assert all((given[i]["text"] or "").startswith(r["text"]) for i, r in rows(after).items())


def test_packing_stage(steps):
    before, after = steps[4]
    pieces = after.collect()
    assert {p["doc_id"] for p in pieces} == set(rows(before))
    used = np.bincount([p["sequence_id"] for p in pieces], [p["length"] for p in pieces])
    assert (used[:-1] == 2_048).all()


def test_run_is_registered(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, DIR).count() > 0


def test_one_query_for_every_operator():
    names = list(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_passages_of_just_over_fifty_words_go(spark):
    """Whole passages of 51 to 60 words, each in two documents, and nothing else."""
    draw = np.random.default_rng(5)
    words = [w for r in spark.read.parquet(f"{DIR}/documents.parquet").collect() for w in (r["text"] or "").split()]
    some = lambda n: " ".join(words[i] for i in draw.integers(0, len(words), n))
    passages = [some(n) for n in range(51, 61)]
    rows = [(i, f"{some(90)} {p} {some(90)}", "en", "a", 1) for i, p in enumerate(passages * 2)]
    rows.append((99, some(400), "en", "a", 1))
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeat_stage(spark, odd.documents(spark, rows), DIR).collect()}
    for i, text, *_ in rows:
        passage = passages[i % 10] if i < 99 else None
        if passage is None:
            assert got[i] == text
        elif len(passage.encode()) >= corpus_pipeline.REPEAT_BYTES:
            assert passage not in got[i] and len(got[i]) >= len(text) - len(passage) - 6
    assert sum(len(p.encode()) >= corpus_pipeline.REPEAT_BYTES for p in passages) == 10


#: Names that stages add, or use inside.
INNER = ("severity", "toxic_p", "severity_grade", "_digest", "_kept", "_id", "_own", "_tkey", "kept_text", "epoch")
INNER += ("n_tokens", "domain", "take_tokens", "stream_start", "mixed_text", "_document", "k", "n", "key")


@pytest.mark.parametrize("place", range(4))
@pytest.mark.parametrize("which", ["odd", "none"])
def test_stages_take_odd_rows_and_clashing_names(spark, place, which):
    """Nulls, empty and long texts, repeated rows, empty tables; no column is replaced."""
    docs = odd.documents(spark, odd.ROWS if which == "odd" else [])
    docs = docs.select(*SCHEMA, *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id"), F.lit(-1))).alias(c) for c in INNER])
    name, stage = corpus_pipeline.STAGES[place]
    after = stage(spark, docs, DIR)
    assert after.columns == docs.columns
    got = after.collect()
    if which == "none":
        assert not got
        return
    for r in got:
        own = -1 if r["doc_id"] is None else r["doc_id"]
        assert all(r[c] == f"{c} of {own}" for c in INNER)
    kept = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got)
    given = sorted(-1 if r[0] is None else r[0] for r in odd.ROWS)
    if name in ("toxicity", "repeats"):
        assert kept == given
    elif name == "near_duplicates":
        assert kept == [-1, 1, 3, 4, 5, 7, 8, 8]


def test_packing_stage_takes_odd_rows(spark):
    docs = odd.documents(spark)
    docs = docs.select(*SCHEMA, *[F.lit("x").alias(c) for c in INNER])
    pieces = corpus_pipeline.packing_stage(spark, docs, DIR).collect()
    assert {p["doc_id"] for p in pieces} == {r[0] for r in odd.ROWS}
    assert corpus_pipeline.packing_stage(spark, docs.filter("false"), DIR).count() == 0
