"""Boilerplate lines: lines that many documents share are removed from all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as tx
from textloom.session import materialize


def line_key(line: Column) -> Column:
    return F.unhex(F.md5(F.encode(tx.strip(line), "UTF-8")))


def repeated_lines(df: DataFrame, min_docs: int, column: str = "text") -> DataFrame:
    """(key, docs): lines, ends trimmed, that at least min_docs documents have.

    A document counts a line once; counts combine before the shuffle, so a line
    that a third of the documents have costs a row per task.
    """
    keys = F.array_distinct(F.transform(tx.nonblank_lines(tx.or_empty(F.col(column))), line_key))
    counts = df.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("docs"))
    return counts.filter(F.col("docs") >= min_docs)


#: So many lines go to every task at most; each other one is a smaller share of all line places than this.
HOT_LINES = 20_000


def drop_repeated_lines(df: DataFrame, repeated: DataFrame, key: str, column: str = "text") -> DataFrame:
    """Documents (unique by `key`) without those lines, and `dropped_lines`.

    Only documents that have such a line take part in the join, by line keys
    alone; their texts stay where they are until one join by document. Lines
    that hold more than a share of 1 / HOT_LINES of the repeated lines' documents
    are at most HOT_LINES: they go to every task, and their places are marked
    without a shuffle. The others meet in a join, where no key is a hot one.
    """
    repeated = materialize(repeated.select("key", "docs"), "repeated-lines")
    total = repeated.agg(F.sum("docs").alias("n")).first()["n"] or 0
    is_hot = F.col("docs") > F.lit(total // HOT_LINES)
    hot = repeated.filter(is_hot).select("key", F.lit(True).alias("_hot"))
    lines = tx.lines(tx.or_empty(F.col(column)))
    places = df.select(key, F.posexplode(lines).alias("_at", "_line")).filter(~tx.is_blank(F.col("_line")))
    places = places.select(key, "_at", line_key(F.col("_line")).alias("key")).join(F.broadcast(hot), "key", "left")
    some = places.filter("_hot is null").join(repeated.filter(~is_hot).select("key"), "key")
    hit = places.filter("_hot").select(key, "_at").unionByName(some.select(key, "_at"))
    gone = hit.groupBy(key).agg(F.collect_set("_at").alias("_gone"))
    joined = df.join(gone, key, "left")
    kept = F.filter(lines, lambda line, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col(column)).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(column, text).withColumn(
        "dropped_lines", F.coalesce(F.size("_gone"), F.lit(0))
    ).drop("_gone")
