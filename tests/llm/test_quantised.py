import math

import numpy as np

from textloom.llm import groups, quantised


def brute(ids, points, threshold):
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    label = np.array(ids)
    while True:
        low = np.array([min([label[i], *label[near[i]]]) for i in range(len(ids))])
        if (low == label).all():
            return near.sum(axis=1), label
        label = low


def clusters(seed, spread):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(60, 64))
    points = [c + draw.normal(size=64) * s for c in centres for s in spread]
    return np.array(points)


def check(spark, points, least=1.0):
    ids = list(range(len(points)))
    df = spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, points)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in quantised.near_duplicates(df).collect()}
    links, label = brute(ids, points, 0.9)
    found = sum(got[i]["n_links"] for i in ids)
    assert least * links.sum() <= found <= links.sum()
    if least == 1.0:
        assert [(got[i]["n_links"], got[i]["component_id"]) for i in ids] == list(zip(links, label))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_close_copies(spark):
    check(spark, clusters(1, [0.05, 0.1, 0.1, 0.15]))


def test_recall_at_the_threshold(spark):
    check(spark, clusters(2, [0.3, 0.3, 0.32, 0.33]), 0.9)


def test_one_group_of_a_third(spark, monkeypatch):
    draw = np.random.default_rng(3)
    same = np.repeat(draw.normal(size=(1, 64)), 150, axis=0)
    near = draw.normal(size=(1, 64)) + draw.normal(size=(150, 64)) * 0.05
    monkeypatch.setattr(groups, "BLOCK", 32)
    check(spark, np.concatenate([same, near, clusters(4, [0.1, 0.1])]))


def test_odd_vectors(spark):
    rows = [
        (5, [1.0, 0.0]),
        (4, [1.0, 0.0]),
        (4, [1.0, 0.0]),
        (6, [2.0]),
        (7, [0.0, 0.0]),
        (8, None),
        (9, [math.nan, 1.0]),
        (10, [None, 1.0]),
        (11, [math.inf, 0.0]),
        (None, [1.0, 0.0]),
        (12, [1e300, 0.0]),
        (13, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, k string")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in quantised.near_duplicates(df).collect()), key=repr)
    linked = [(4, 4, 4, True), (4, 4, 4, True), (5, 4, 4, False), (6, 4, 4, False), (12, 4, 4, False)]
    lonely = [(i, 0, i, True) for i in (7, 8, 9, 10, 11, 13)]
    assert got == sorted([*linked, *lonely, (None, 0, None, False)], key=repr)
    assert quantised.near_duplicates(df.filter("false")).count() == 0


def test_rotation_balances_bits():
    points = quantised.unit_rows(clusters(5, [0.1] * 20))
    mean, projections = quantised.fit(points)
    bits = (points - mean) @ projections[0] >= 0
    assert abs(bits.mean() - 0.5) < 0.05 and np.abs(bits.mean(axis=0) - 0.5).max() < 0.35
    assert np.allclose(projections[0].T @ projections[0], np.eye(64))


def test_forest_and_pairs():
    moved, root = groups.forest(np.array([4, 2, 7]), np.array([2, 1, 8]), 10)
    assert dict(zip(moved.tolist(), root.tolist())) == {2: 1, 4: 1, 8: 7}


def test_table_entries_are_never_broadcast(spark, tmp_path):
    """Spark takes the entries of a few vectors for a few rows, as it does not see the step that makes them."""
    points = clusters(5, [0.05, 0.1])
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    spark.createDataFrame(rows, "k long, vector array<double>").write.parquet(f"{tmp_path}/vectors")
    df = spark.read.parquet(f"{tmp_path}/vectors")
    mean, turns = quantised.fit(quantised.unit_rows(points))
    entries = df.mapInArrow(quantised.coder(64, mean, turns), "key long, k long, c0 long, c1 long")
    shared = groups.sharing(entries, "key")
    assert shared.count() > 0
    assert "Broadcast" not in shared._jdf.queryExecution().executedPlan().toString()
