"""Odd rows that every operator has to take: nulls, empty and long texts,
repeated rows, ties, and extra columns whose names clash with inner ones."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("n_tokens", "epoch", "_row", "severity", "key", "k", "n", "tkey", "digest", "_n", "part", "queue", "row", "id")

WORDS = [f"word{i}" for i in range(400)]


def prose(start: int, n: int) -> str:
    return " ".join(WORDS[(start * 7 + i * (start % 5 + 1)) % 400] for i in range(n))


ROWS = [
    (1, prose(1, 120), "en", "a", 1),
    (2, prose(1, 120), "en", "a", 1),
    (2, prose(1, 120), "en", "a", 1),
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, " \n\t ", "de", "b", 4),
    (None, prose(3, 90), None, None, 5),
    (6, prose(3, 90) + " tail", "de", "b", 5),
    (7, "x" * 30_000 + " " + prose(9, 3_000), "de", "c", 9),
    (8, "two words", "de", "c", 9),
    (8, "other words", "fr", "c", 9),
]


def documents(spark, rows=None):
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


def empty(spark):
    return documents(spark, [])
