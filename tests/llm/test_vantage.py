import math

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import queries, vantage

DIR = "/root/testdata/sf0.01"


def brute(ids, points, query, k):
    away = np.sqrt(((points - points[query]) ** 2).sum(axis=1))
    away[ids == ids[query]] = np.inf
    order = [i for i in np.lexsort((ids, away)) if np.isfinite(away[i])][:k]
    return [(int(ids[i]), float(away[i])) for i in order]


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["query_row"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def same(got, want):
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-12, atol=0)


def test_recall_of_the_query(spark):
    rows = spark.read.parquet(f"{DIR}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    points = np.array([r["embedding"] for r in rows], np.float64)
    got = found(queries.op1_vantage_search(spark, DIR))
    asked = np.flatnonzero(ids % 100 == 0)
    assert set(got) == {int(ids[q]) for q in asked}
    hits = sum(len({v for v, _ in got[int(ids[q])]} & {v for v, _ in brute(ids, points, q, 10)}) for q in asked)
    assert hits >= 0.9 * 10 * len(asked)


def test_factor_one_is_exact_over_shards_and_blocks(spark):
    draw = np.random.default_rng(1)
    points = np.round(draw.normal(size=(1_500, 6)) * 3)  # whole numbers: exact sums
    points[200:700] = points[200]  # a third are one vector: ties
    ids = np.arange(1_500)
    df = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, points)], "vec_id long, embedding array<double>")
    got = found(vantage.search(df, F.col("id") % 50 == 0, k=5, factor=1.0, shard_rows=400))
    for q in range(0, 1_500, 50):
        same(got[q], brute(ids, points, q, 5))


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 1),
        (100, [1.0, 0.0], 1),
        (1, [0.0, 0.0], 1),
        (2, None, 1),
        (3, [math.nan, 1.0], 1),
        (4, [math.inf, 1.0], 1),
        (5, [None, 1.0], 1),
        (6, [], 1),
        (7, [1.0], 1),
        (8, [1e30, 1.0], 1),
        (None, [1.0, 1.0], 1),
        (9, [1.0, 2.0], 1),
        (9, [1.0, 2.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, shard int")
    got = found(vantage.search(df, F.col("id") % 100 == 0))
    assert [v for v, _ in got[0]] == [7, 100, 9, 9, 8]  # a shorter vector is padded
    assert [v for v, _ in got[100]] == [0, 7, 9, 9, 8]
    assert vantage.search(df.filter("false"), F.col("id") % 100 == 0).count() == 0


def test_repeated_query_rows_are_queries_of_their_own(spark):
    """Ranks stay 1 to k, a row leaves out itself alone, and equal ids are candidates."""
    draw = np.random.default_rng(4)
    points = np.round(draw.normal(size=(300, 4)) * 2)
    ids = np.concatenate([np.arange(297), [100, 100, 200]])
    points[297] = points[100]  # one with the same vector, one with another
    df = spark.createDataFrame([(int(i), p.tolist()) for i, p in zip(ids, points)], "vec_id long, embedding array<double>")
    rows = vantage.search(df.repartition(5), F.col("id") % 100 == 0, k=10, factor=1.0, shard_rows=64).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault((r["query_id"], r["query_row"]), []).append((r["rank"], r["vec_id"], r["score"]))
    asked = [i for i in range(300) if ids[i] % 100 == 0]
    assert len(got) == len(asked) == 6 and all([x[0] for x in v] == list(range(1, 11)) for v in got.values())
    want = []
    for q in asked:
        away = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        away[q] = np.inf
        order = [i for i in np.lexsort((ids, away))][:10]
        want.append((int(ids[q]), [int(ids[i]) for i in order], [round(float(away[i]), 9) for i in order]))
    assert sorted((k[0], [x[1] for x in v], [round(x[2], 9) for x in v]) for k, v in got.items()) == sorted(want)


def test_recall_over_shards(spark):
    """The query's own factor, over several shards and 100 queries of sf0.1."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    ids = np.array([r["vec_id"] for r in rows])
    points = np.array([r["embedding"] for r in rows], np.float64)
    asked = np.flatnonzero(ids % 20 == 0)
    got = found(vantage.search(df, F.col("id") % 20 == 0, k=10, factor=1.5, shard_rows=400))
    assert len(asked) >= 50 and len(rows) > 1_200
    hits = sum(len({v for v, _ in got[int(ids[q])]} & {v for v, _ in brute(ids, points, q, 10)}) for q in asked)
    assert hits >= 0.9 * 10 * len(asked)
