"""Quotas per group and exact seeded sampling, without moving the documents.

A document's place in its group is its rank by md5(seed, id). The rank is never
computed for all rows: documents are counted by the leading digits of the hash,
one bucket per group holds the quota's edge, and only that bucket is ranked. It
yields one cut value per group, and the sample is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.config import Settings
from textloom.session import discard, materialize

BUCKET_DIGITS = 4  # 65,536 buckets of the hash range
UNKNOWN = "unknown"


GROUPS = ("lang",)  # what a corpus is balanced by, unless said otherwise


def group_of(column: str = "lang") -> Column:
    return F.coalesce(F.col(column), F.lit(UNKNOWN))


def group_sizes(df: DataFrame, *groups: str) -> DataFrame:
    """(groups..., docs): one row per group, by language unless told."""
    return df.groupBy(*[group_of(c).alias(c) for c in groups or GROUPS]).agg(F.count(F.lit(1)).alias("docs"))


def groups_of(sizes: DataFrame) -> list[str]:
    return [c for c in sizes.columns if c not in ("docs", "quota")]


def quotas(sizes: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(groups..., docs, quota). Without a target every group is capped at a share of
    the corpus; with one, groups get log-smoothed shares of the target, capped.

    `sizes` has one row per group, so the window over all of it is small.
    Halves round to even.
    """
    everything = Window.partitionBy()
    if s.target_docs:
        weight = F.log1p("docs")
        share = F.least(weight / F.sum(weight).over(everything), F.lit(s.max_lang_fraction))
        quota = F.bround(share * s.target_docs)
    else:
        quota = F.bround(F.sum("docs").over(everything) * F.lit(s.max_lang_fraction))
    return sizes.withColumn("quota", F.least(quota.cast("bigint"), F.col("docs")))


def seeded_hash(seed: int, key: str = "id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def _cuts(hashed: DataFrame, quota: DataFrame, groups: list[str]) -> DataFrame:
    """(groups..., cut): the largest hash each group keeps. Groups without a row
    here keep nothing."""
    digits = F.substring("_hash", 1, BUCKET_DIGITS)
    counts = hashed.groupBy(*groups, digits.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # At most 65,536 rows per group in this window, however large the group.
    upto = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_bucket"))
    edge = (
        counts.withColumn("_upto", upto)
        .join(quota.select(*groups, "quota"), groups)
        .filter((F.col("_upto") - F.col("_n") < F.col("quota")) & (F.col("_upto") >= F.col("quota")))
        .select(*groups, "_bucket", (F.col("quota") - F.col("_upto") + F.col("_n")).alias("_need"))
    )
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_hash"))
    return (
        hashed.withColumn("_bucket", digits)
        .join(edge, [*groups, "_bucket"])
        .withColumn("_rank", rank)
        .filter("_rank = _need")
        .select(*groups, F.col("_hash").alias("cut"))
    )


def sample(df: DataFrame, quota: DataFrame, s: Settings = Settings(), key: str = "id") -> DataFrame:
    """Exactly `quota` documents per group (all of them where it is the size).

    The written tables of quotas and cuts have a row per group; Spark sends
    them to all tasks where their size allows it and shuffles otherwise, with
    the same rows. Documents without a group count as `unknown`.
    """
    groups = groups_of(quota)
    quota = materialize(quota, "quota")
    hashed = df.withColumns({c: group_of(c) for c in groups}).withColumn("_hash", seeded_hash(s.random_seed, key))
    cuts = materialize(_cuts(hashed.select(*groups, "_hash"), quota, groups), "cuts")
    discard(quota)
    picked = hashed.join(cuts, groups)
    return picked.filter(F.col("_hash") <= F.col("cut")).drop("_hash", "cut")


def shuffled(df: DataFrame, s: Settings = Settings(), key: str = "id") -> DataFrame:
    """Add `position` and `shard` of one seeded global order over all groups.

    A second hash gives the order. Its positions are an offset per hash bucket
    (a table of 65,536 rows at most) plus the rank inside the bucket, so no
    task ever numbers more than its own buckets.
    """
    hashed = df.withColumn("_hash", seeded_hash(s.random_seed + 1, key)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    counts = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_hash"))
    position = F.col("_before") + rank - 1
    return (
        hashed.join(F.broadcast(before), "_bucket")
        .withColumn("position", position)
        .withColumn("shard", F.floor(F.col("position") / s.shard_size))
        .drop("_hash", "_bucket", "_before")
    )


def balance_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """(groups..., docs, sampled) per group, before and after sampling."""
    groups = groups_of(before)
    kept = group_sizes(after, *groups).withColumnRenamed("docs", "sampled")
    return before.select(*groups, "docs").join(kept, groups, "left").fillna(0, ["sampled"])


def rebalance(df: DataFrame, s: Settings = Settings(), key: str = "id", groups: tuple[str, ...] = GROUPS) -> DataFrame:
    quota = quotas(group_sizes(df, *groups), s)
    return shuffled(sample(df, quota, s, key), s, key)
