from dataclasses import fields, replace

import pytest
from pyspark.sql import functions as F

from textloom.config import Settings
from textloom.operators import language as lg
from textloom.operators.counters import Counters
from textloom.plans import stages
from textloom.plans.saved import content_key
from textloom.session import discard, materialize, scratch_root
from textloom.sources import shards as sh
from textloom.streaming.shards import tag_new_shards

DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def corpus(spark):
    d = spark.read.parquet(DOCS).repartition(4)
    return d.select(F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("id"), "text", "source").cache()


@pytest.fixture(scope="module")
def model(spark):
    return lg.fit(spark.read.parquet(DOCS).repartition(8)).cache()


def test_saved_stages_and_result(spark, corpus, model, tmp_path):
    out = stages.prepare(corpus, model, save_dir=str(tmp_path / "s"))
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == [
        "balanced", "extracted", "filtered", "recovered", "tagged", "unique",
    ]
    plain = stages.prepare(corpus, model)
    assert {(r.id, r.position) for r in out.collect()} == {(r.id, r.position) for r in plain.collect()}
    assert {"ord", "id", "text", "source", "lang", "lang_confidence", "domain", "position", "shard"} == set(out.columns)

    s = replace(Settings(), vocab_size=130, validation_docs=20)
    trained = stages.learn(out, s, path=str(tmp_path / "v"))
    assert trained.stats.first().vocab_size == 130
    assert trained.validation.first().docs_sampled == 20


def written_at(folder):
    return {p.name: (p / "_manifest.json").stat().st_mtime_ns for p in folder.iterdir()}


def test_a_run_takes_up_from_the_stages_that_are_valid(spark, corpus, model, tmp_path, monkeypatch):
    """Killed while near-duplicates are written; again with other settings, with
    a damaged stage, and with other documents of the same number."""
    folder = tmp_path / "s"

    def run(s=Settings(), docs=corpus):
        seen = Counters()
        rows = stages.prepare(docs, model, s, save_dir=str(folder), counters=seen).collect()
        return sorted(map(str, rows)), [tuple(r) for r in seen.table(spark).collect()]

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(stages.dedup, "deduplicate", killed)
        with pytest.raises(KeyboardInterrupt):
            run()
    early = written_at(folder)
    assert set(early) == {"filtered", "extracted", "recovered", "tagged"}
    rows, counts = run()
    full = written_at(folder)
    assert {n: full[n] for n in early} == early and set(full) == {*early, "unique", "balanced"}

    plain = Counters()
    fresh = stages.prepare(corpus, model, counters=plain)
    assert rows == sorted(map(str, fresh.select(spark.read.parquet(f"{folder}/balanced").columns).collect()))
    assert counts == [tuple(r) for r in plain.table(spark).collect()]
    assert [c[0] for c in counts] == ["filtered", "extracted", "recovered", "tagged", "unique", "balanced"]
    assert counts[0][1] == corpus.count() and counts[-1][2] == len(rows)

    assert run() == (rows, counts) and written_at(folder) == full  # nothing is left to do
    run(replace(Settings(), random_seed=7))
    assert {n for n, at in written_at(folder).items() if at != full[n]} == {"balanced"}
    run(replace(Settings(), vocab_size=99, random_seed=7))
    reseeded = written_at(folder)
    assert {n for n, at in reseeded.items() if at != full[n]} == {"balanced"}
    next((folder / "tagged").glob("part-*")).unlink()
    run(replace(Settings(), random_seed=7))
    mended = written_at(folder)
    assert {n for n, at in mended.items() if at != reseeded[n]} == {"tagged"}
    (folder / "unique" / "_manifest.json").write_text('{"stage": ')
    changed = corpus.withColumn("text", F.when(F.col("ord") == 7, F.concat("text", F.lit(" more"))).otherwise(F.col("text")))
    again, _ = run(docs=changed)
    assert all(at != mended[n] for n, at in written_at(folder).items())
    assert sum("more" in r for r in again) >= sum("more" in r for r in rows)


def test_every_setting_belongs_to_a_stage_or_to_none():
    """A setting that a stage looks at, but does not name, would leave old rows."""
    later = {"vocab_size", "min_frequency", "validation_docs", "run_id", "max_docs"}
    named = [name for uses in stages.USES.values() for name in uses]
    assert len(named) == len(set(named)) and set(named) | later == {f.name for f in fields(Settings)}


def test_content_key_knows_rows_and_not_their_order(spark):
    df = spark.createDataFrame([(1, "a", {"k": "v"}), (2, None, None), (2, None, None)], "id int, t string, m map<string,string>")
    assert content_key(df) == content_key(df.orderBy(F.desc("id")).repartition(2))
    for other in (df.limit(2), df.withColumnRenamed("t", "u"), df.fillna("", ["t"])):
        assert content_key(other) != content_key(df)


def test_counting_takes_no_job(spark, corpus):
    """The counts come with the write, in the one job of the stages."""
    seen = Counters()
    group = "counting"
    spark.sparkContext.setJobGroup(group, group)
    out = seen.watch(seen.watch(corpus, "input").filter("length(text) > 500"), "long")
    out.write.format("noop").mode("overwrite").save()
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert seen.docs("input") == corpus.count() and 0 < seen.docs("long") < seen.docs("input")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert before == 1


def test_stream_takes_each_shard_once(spark, corpus, model, tmp_path):
    docs = corpus.select("id", "text", "source", F.create_map(F.lit("k"), F.lit("v")).alias("meta"))
    args = [str(tmp_path / n) for n in ("in", "out", "log")]
    sh.write_shards(docs.filter("cast(id as int) < 100"), args[0])
    for _ in range(2):  # the second run finds nothing new
        tag_new_shards(spark, *args, model, shards_per_batch=2).awaitTermination()
    docs.filter("cast(id as int) >= 100").write.mode("append").option("compression", "gzip").json(args[0])
    tag_new_shards(spark, *args, model).awaitTermination()
    batch = lg.tag_documents(stages.clean(docs), model)
    columns = ["id", "text", "lang", "lang_confidence", "domain"]
    streamed = spark.read.parquet(args[1]).select(columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.select(columns).collect()))


def test_stream_with_a_model_in_shards(spark, corpus, model, tmp_path):
    docs = corpus.select("id", "text", "source", F.create_map(F.lit("k"), F.lit("v")).alias("meta"))
    args = [str(tmp_path / n) for n in ("in", "out", "log")]
    sh.write_shards(docs, args[0])
    for _ in range(2):
        tag_new_shards(spark, *args, model, shards_per_batch=2, shard_grams=5_000).awaitTermination()
    columns = ["id", "text", "lang", "lang_confidence", "domain"]
    batch = lg.tag_documents(stages.clean(docs), model).select(columns)
    assert sorted(map(str, spark.read.parquet(args[1]).select(columns).collect())) == sorted(map(str, batch.collect()))


def test_materialize_cuts_lineage(spark):
    df = spark.range(10).repartition(3)
    cut = materialize(df, "cut")
    assert "Exchange" not in cut._jdf.queryExecution().toString()
    assert cut.count() == 10
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == named if named else scratch_root(spark).endswith("/_scratch")
    discard(cut)
    with pytest.raises(Exception, match="does not exist|No such file|FileNotFound|PATH_NOT_FOUND|FILE_NOT_EXIST"):
        cut.collect()


def test_python_steps_run_once_under_a_filter(spark, corpus, model):
    plan = lg.tag_documents(stages.clean(corpus), model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 4  # page and plain references, composition, language
    assert "Exchange" not in plan.split("InMemoryTableScan")[0]
