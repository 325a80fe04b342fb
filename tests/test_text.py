from pyspark.sql import functions as F

from textloom.functions import text as tx

TRICKY = [
    "",
    " ",
    "a",
    " a  b ",
    "a\tb\nc\r\nd\re\x0bf\x0cg",
    "x\x1cy\x1dz\x1e w\x1f",
    "\x85one\xa0two　three three four five",
    "a b c d e",
    "\n\n \n",
    "line one\n\nline two\n",
    "​ zero width is no blank",
    "😀 é ñ",
    "a" + " " * 5000 + "b",
]


def run(spark, *columns):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "i int, t string")
    return rows.select("i", *columns).orderBy("i").collect()


def test_words_strip_and_lines_follow_unicode_rules(spark):
    t = F.col("t")
    out = run(
        spark,
        tx.words(t).alias("words"),
        tx.word_count(t).alias("n"),
        tx.strip(t).alias("strip"),
        tx.collapse(t).alias("flat"),
        tx.nonblank_lines(t).alias("lines"),
        tx.is_blank(t).alias("blank"),
        tx.chars(t).alias("chars"),
    )
    for row, text in zip(out, TRICKY):
        assert row.words == text.split()
        assert row.n == len(text.split())
        assert row.strip == text.strip()
        assert row.flat == " ".join(text.split())
        assert row.lines == [line for line in text.splitlines() if line.strip()]
        assert row.blank == (not text.strip())
        assert row.chars == list(text)


def test_head_counts_code_points(spark):
    out = run(spark, tx.head(F.col("t"), 3).alias("h"), tx.head(F.col("t"), None).alias("all"))
    for row, text in zip(out, TRICKY):
        assert row.h == text[:3]
        assert row.all == text
