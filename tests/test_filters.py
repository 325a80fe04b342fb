import pytest
from pyspark.sql import functions as F

from textloom.operators import boilerplate, counters
from textloom.operators import filters as ft

LONG = "word " * 40


@pytest.mark.parametrize(
    "text, reason",
    [
        (None, "length"),
        ("", "length"),
        ("x" * 99, "length"),
        ("x" * 100, None),
        (" " * 150, "blank"),
        ("\x01" + LONG, "binary"),
        ("a" * 1999 + "\x7f", "binary"),
        ("a" * 2000 + "\x7f", "binary"),
        ("<b>x</b> " * 30, "html"),
        (LONG + "<b>x</b>", None),
        ("short\n" * 40, "short_lines"),
        ("y" * 20 + "\n" + "z" * 20 + "\n\n\n" + "w" * 80, None),
        (("y" * 19 + "\n") * 10, "short_lines"),
        ("y" * 1_000_000, None),
        ("y" * 1_000_001, "length"),
    ],
)
def test_reason(spark, text, reason):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(ft.reject_reason(F.col("text")).alias("r")).first().r == reason
    assert ft.content_filter(df).count() == (reason is None)


def test_tag_ratio_is_strictly_above(spark):
    texts = [("<i> " + "w " * 9,), ("<i> " + "w " * 8,), ("<" + "a" * 101 + "> w",), ("",)]
    df = spark.createDataFrame(texts, "text string")
    got = [r.h for r in df.select(ft.tag_heavy(F.col("text")).alias("h")).collect()]
    assert got == [False, True, False, False]


def test_counters_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "ok boolean")
    row = counters.stage_counters(df, F.col("ok"), "filter").first()
    assert (row.docs_in, row.docs_out, row.percent) == (0, 0, 0.0)


@pytest.mark.parametrize("most", [1, 3, 20_000])
def test_common_lines_go_however_many_are_broadcast(spark, monkeypatch, most):
    """One line is in every document, some in a few; which of them are sent to
    all tasks changes nothing."""
    monkeypatch.setattr(boilerplate, "HOT_LINES", most)
    texts = {i: "\n".join(["all rights", f"own {i}", f"part {i % 20}", " ", f"part {i % 20}", "all rights "]) for i in range(100)}
    texts |= {100: None, 101: "", 102: "own\n\nown 2 "}
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    repeated = boilerplate.repeated_lines(df, 5)
    got = {r.id: (r.text, r.dropped_lines) for r in boilerplate.drop_repeated_lines(df, repeated, "id").collect()}
    want = {i: (f"own {i}\n ", 4) for i in range(100)}
    assert got == want | {i: (texts[i], 0) for i in (100, 101, 102)}


def test_lines_are_cut_once_for_all_verdicts(spark, tmp_path):
    from textloom.catalog import filters as cf

    texts = ["", " \n ", "short\nlines", "one line that is long enough\n\t\n", None, "a" * 20 + "\r\n" + "b" * 19]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    t = F.col("text")
    v = d.select("doc_id", ft.line_verdicts(t).alias("v")).select("doc_id", "v.*")
    one = d.select(
        "doc_id",
        ft.has_content_line(t).alias("has_line"),
        ft.mean_line_length(t).alias("mean_length"),
        F.when(t.isNotNull(), ft.lines_long_enough(t)).alias("long_enough"),
    )
    assert sorted(v.collect()) == sorted(one.collect())
    d.write.parquet(str(tmp_path / "documents.parquet"))
    plan = cf.line_length(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
