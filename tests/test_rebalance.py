import math
from collections import Counter
from dataclasses import replace

import pytest

from textloom.config import Settings
from textloom.operators import ordering
from textloom.operators import rebalance as rb


def corpus(spark, sizes):
    rows = [(f"{lang}{i}", lang) for lang, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "id string, lang string")


def quota_of(sizes, target, share):
    total, logs = sum(sizes.values()), {k: math.log(n + 1) for k, n in sizes.items()}
    if target:
        return {k: min(round(min(logs[k] / sum(logs.values()), share) * target), n) for k, n in sizes.items()}
    return {k: min(n, round(total * share)) for k, n in sizes.items()}


@pytest.mark.parametrize("target", [0, 7, 40, 10_000])
@pytest.mark.parametrize("sizes", [{"a": 60, "b": 20, "c": 5}, {"a": 30}, {"a": 1, "b": 1, "c": 3}])
def test_quotas_and_exact_samples(spark, sizes, target):
    s = replace(Settings(), target_docs=target)
    df = corpus(spark, sizes)
    quota = rb.quotas(rb.group_sizes(df), s)
    want = quota_of(sizes, target, s.max_lang_fraction)
    assert {r.lang: r.quota for r in quota.collect()} == want
    got = Counter(r.lang for r in rb.sample(df, quota, s).collect())
    assert got == {k: v for k, v in want.items() if v}


def test_halves_round_to_even(spark):
    s = replace(Settings(), max_lang_fraction=0.5)
    assert rb.quotas(rb.group_sizes(corpus(spark, {"a": 5})), s).first().quota == 2
    assert rb.quotas(rb.group_sizes(corpus(spark, {"a": 7})), s).first().quota == 4


def test_missing_language_is_a_group(spark):
    df = spark.createDataFrame([("1", None), ("2", "a")], "id string, lang string")
    assert {r.lang for r in rb.group_sizes(df).collect()} == {"unknown", "a"}


def test_result_does_not_depend_on_partitions(spark):
    df = corpus(spark, {"a": 200, "b": 50})
    s = replace(Settings(), shard_size=10)
    results = [
        {(r.id, r.position, r.shard) for r in rb.rebalance(df.repartition(n), s).collect()} for n in (1, 7)
    ]
    assert results[0] == results[1]
    assert sorted(p for _, p, _ in results[0]) == list(range(len(results[0])))
    assert all(p // 10 == shard for _, p, shard in results[0])
    other = rb.rebalance(df, replace(s, random_seed=1))
    assert {r.id for r in other.collect()} != {i for i, _, _ in results[0]}


@pytest.mark.parametrize("n", [1, 5, 99, 100, 150])
def test_first_n_by_ranges(spark, n):
    df = spark.range(100).selectExpr("struct(id % 7 as a, id as b) as ord", "id")
    got = {r.id for r in ordering.first_n(df, "ord", n).collect()}
    assert got == set(sorted(range(100), key=lambda i: (i % 7, i))[:n])


def test_first_n_with_nulls_ties_and_repeats(spark):
    rows = [(None, "a"), (None, "b"), (3, "c"), (3, "d"), (3, "d"), (1, None), (5, "e")]
    df = spark.createDataFrame(rows, "ord int, text string").repartition(4)
    for n in range(1, 9):
        got = ordering.first_n(df, "ord", n)
        orders = sorted((r.ord is not None, r.ord or 0) for r in got.collect())
        want = sorted((o is not None, o or 0) for o, _ in rows)
        # Rows equal in every column stay or go together.
        assert orders in (want[:n], want[: n + 1]) and len(orders) >= min(n, 7)
        assert got.rdd.getNumPartitions() == df.rdd.getNumPartitions()
    assert ordering.first_n(df, "ord", 0) is df
