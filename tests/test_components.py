from textloom.operators.components import components


def test_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1_000, 1_300)] + [(5, i) for i in range(6, 60)] + [(3, 3), (2, 1), (1, 2), (None, 4)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1_000 for i in range(1_000, 1_301)}, **{i: 5 for i in range(5, 60)}, 1: 1, 2: 1}


def test_no_links(spark):
    none = spark.createDataFrame([], "u long, v long")
    assert components(none).columns == ["id", "component"] and components(none).count() == 0
