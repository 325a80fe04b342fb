import pytest
from pyspark.sql import functions as F

from textloom.functions import repair as rp
from textloom.operators import encoding as en


def fixed(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    row = en.recover_encoding(df, flag="changed").first()
    assert row.changed == (row.text != text)
    return row.text


@pytest.mark.parametrize(
    "text, want",
    [
        ("plain ASCII text", "plain ASCII text"),
        ("naïve café à la carte", "naïve café à la carte"),
        ("schÃ¶n", "schön"),
        ("Ã©tÃ© — naïve", "été — naïve"),
        ("naïve Ã© donâ€™t 漢", "naïve é don't 漢"),
        ("CAFÉ” naïve 漢", 'CAFÉ" naïve 漢'),
        ("itâ€™s", "it's"),
        ("ÃƒÂ©", "é"),
        ("ok ☃ line\ncafÃ©", "ok ☃ line\ncafé"),
        ("\u0080100", "€100"),
        ("a &amp; b &eacute;", "a & b é"),
        ("a &amp; b\n<b> &amp;", "a & b\n<b> &amp;"),
        ("ﬁnd the ﬂow", "find the flow"),
        ("Ｈｅｌｌｏ　ﾊﾛｰ", "Hello ハロー"),
        ("“a” ‘b’ „c”", "\"a\" 'b' \"c\""),
        ("a\r\nb\rc d e", "a\nb\nc\nd\ne"),
        ("a\x1b[31mb\x1b[0m\x07c﻿d￺e", "abcde"),
        ("é ậ", "é ậ"),
        ("tab\tstays\nnewline too", "tab\tstays\nnewline too"),
        ("", ""),
    ],
)
def test_recovery(spark, text, want):
    assert fixed(spark, text) == want


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "text string")
    row = en.recover_encoding(df, flag="changed").first()
    assert row.text is None and row.changed is False


def test_width_table_follows_the_rule():
    table = rp.width_table()
    assert table["Ａ"] == "A" and table["￥"] == "¥" and table["　"] == " " and len(table["￣"]) == 2


def test_long_lines_are_linear(spark):
    df = spark.createDataFrame([("x" * 500_000 + "<b>&amp;",)], "text string")
    out = df.select(rp.unescape_plain(F.col("text")).alias("t")).first().t
    assert out == "x" * 500_000 + "<b>&amp;"


def test_all_repairs_are_one_step_and_send_back_only_changes(spark, monkeypatch):
    monkeypatch.setattr(rp, "SLICE_BYTES", 40)
    texts = ["plain", None, "naïve à la carte", "", "schÃ¶n", "a &amp; b", "x" * 100, "\x00", "ÃƒÂ©\nok ☃", "é", "\x0c"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    got = {r.i: r.t for r in df.select("i", rp.changes(F.col("text"), *en.STEPS).alias("t")).collect()}
    changed = {4: "schön", 5: "a & b", 7: "", 8: "é\nok ☃", 9: "é"}
    assert got == {i: changed.get(i) for i in range(len(texts))}
    plan = en.recover_encoding(df, flag="changed")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "RLIKE" not in plan and "regexp_replace" not in plan
