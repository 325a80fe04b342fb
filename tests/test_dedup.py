import random

import pytest
from pyspark.sql import functions as F

import models
from textloom.config import Settings
from textloom.operators import dedup as dd


def dropped(spark, bands, parts=4):
    df = spark.createDataFrame([(o, [k.encode() for k in ks]) for o, ks in bands], "ord bigint, keys array<binary>")
    return {r.ord for r in dd.dropped_documents(df.repartition(parts), "ord").collect()}


def random_bands(seed, docs=60, bands=4, values=25):
    draw = random.Random(seed)
    return [(o, [f"{b}:{draw.randrange(values)}" for b in range(bands)]) for o in draw.sample(range(1000), docs)]


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("most", [0, 40, 200_000])  # all in rounds, mixed, all walked
def test_same_as_the_walk(spark, monkeypatch, seed, most):
    monkeypatch.setattr(dd, "WALK_MOST", most)
    bands = random_bands(seed)
    assert dropped(spark, bands, 1 + seed) == {o for o, _ in bands} - set(models.first_kept(bands))


def test_hot_bands_are_salted_and_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(dd, "WALK_MOST", 0)
    monkeypatch.setattr(dd, "HOT_FLOOR", 3)
    bands = random_bands(9, values=6)
    assert dropped(spark, bands) == {o for o, _ in bands} - set(models.first_kept(bands))


def test_a_chain_keeps_both_ends(spark):
    assert dropped(spark, [(1, ["a", "x"]), (2, ["a", "b"]), (3, ["y", "b"])]) == {2}


def test_a_chain_of_a_thousand_takes_few_rounds(spark, monkeypatch):
    written = []
    real = dd.materialize
    monkeypatch.setattr(dd, "materialize", lambda df, name: written.append(name) or real(df, name))
    bands = [(i, [f"{i}", f"{i + 1}"]) for i in range(1_000)]
    assert dropped(spark, bands) == set(range(1, 1_000, 2))
    assert len(written) <= 8


def test_orders_that_are_structs(spark):
    rows = [((f, i), [f"{i}".encode(), f"{i + 1}".encode()]) for i in range(30) for f in "ab"]
    df = spark.createDataFrame(rows, "ord struct<file:string,place:int>, keys array<binary>")
    got = {(r.ord.file, r.ord.place) for r in dd.dropped_documents(df, "ord").collect()}
    want = {o for o, _ in rows} - set(models.first_kept(rows))
    assert got == want


def test_all_equal_and_empty(spark):
    df = spark.createDataFrame([(i, "same text here") for i in range(50)], "ord bigint, text string")
    assert [r.ord for r in dd.deduplicate(df, "ord").collect()] == [0]
    assert dd.deduplicate(df.limit(0), "ord").count() == 0


def test_deduplicating_twice_changes_nothing(spark):
    base = [f"w{i} " * 3 + " ".join(f"w{j}" for j in range(i, i + 40)) for i in range(0, 30, 3)]
    rows = [(i * 2 + k, t + " tail" * k) for i, t in enumerate(base) for k in (0, 1)]
    df = spark.createDataFrame(rows, "ord bigint, text string")
    once = dd.deduplicate(df, "ord").cache()
    assert 0 < once.count() < len(rows)
    assert dd.deduplicate(once, "ord").count() == once.count()


def test_shingles_of_short_and_empty_texts(spark):
    rows = [("a b c d e f",), ("a b",), ("",), ("a a a a a a a",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r.s for r in df.select(dd.shingles(F.col("t")).alias("s")).collect()]
    assert got == [["a b c d e", "b c d e f"], ["a b"], [""], ["a a a a a"]]


def test_signature_of_equal_word_lists_is_equal_and_long_texts_are_whole(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    df = spark.createDataFrame([(long,), (long.replace(" ", " \n"),), (long + " end",)], "t string")
    a, b, c = (r.s for r in df.select(dd.minhash(F.col("t")).alias("s")).collect())
    assert a == b and len(a) == 128 and a != [0] * 128
    assert sum(x != y for x, y in zip(a, c)) < 8


def test_banding_for_the_default_threshold():
    assert dd.banding(0.85, 128) == (8, 16)


def test_exact_copies(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "ord bigint, text string")
    assert {r.ord: r.is_copy for r in dd.exact_copies(df, "ord").collect()} == {1: False, 2: False, 3: True}


def near_corpus(seed, docs=50):
    """Texts around a few themes, so that buckets hold near and not so near ones."""
    draw = random.Random(seed)
    themes = [[f"t{t}w{i}" for i in range(60)] for t in range(5)]
    rows = []
    for o in draw.sample(range(1_000), docs):
        words = list(draw.choice(themes))
        for _ in range(draw.randrange(0, 5)):
            words[draw.randrange(60)] = f"x{draw.randrange(20)}"
        rows.append((o, " ".join(words[: draw.randrange(3, 61)] if draw.random() < 0.2 else words)))
    return rows + [(2_000 + i, None if i else "") for i in range(3)]


def shingle_set(text, size=5):
    w = (text or "").split()
    return {" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))}


def similarity(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b)


def bucketed(spark, rows, s):
    df = spark.createDataFrame(rows, "ord bigint, text string").repartition(3)
    return df, {r["ord"]: set(r["keys"]) for r in dd.with_band_keys(df, "ord", s).collect()}


LOOSE = Settings(minhash_threshold=0.4, minhash_perms=64)


@pytest.mark.parametrize("part", [3, 1_024])
def test_candidates_are_compared_with_the_first_of_each_bucket(spark, monkeypatch, part):
    monkeypatch.setattr(dd, "PART_MEMBERS", part)
    rows = near_corpus(1)
    df, keys = bucketed(spark, rows, LOOSE)
    text = dict(rows)
    firsts = {}
    for o in sorted(keys):
        for k in keys[o]:
            firsts.setdefault(k, o)
    want = {(firsts[k], o) for o in keys for k in keys[o] if firsts[k] != o}
    got = {(r["head"], r["ord"]): r["jaccard"] for r in dd.candidate_jaccard(df, "ord", LOOSE).collect()}
    assert got == {p: similarity(text[p[0]], text[p[1]]) for p in want} and len(want) > 50
    row = dd.lsh_precision(dd.candidate_jaccard(df, "ord", LOOSE), 0.4).first()
    near = sum(j >= 0.4 for j in got.values())
    assert (row.candidates, row.near, row.precision) == (len(got), near, near / len(got))
    assert 0 < near < len(got)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("most", [0, 400, 4_000_000])  # all in rounds, mixed, all walked
def test_verified_rule_is_the_walk_with_a_check(spark, monkeypatch, seed, most):
    monkeypatch.setattr(dd, "WALK_SHINGLES", most)
    rows = near_corpus(seed)
    df, keys = bucketed(spark, rows, LOOSE)
    text, kept = dict(rows), []
    for o in sorted(text):
        if not any(keys[o] & keys[k] and similarity(text[o], text[k]) >= 0.4 for k in kept):
            kept.append(o)
    got = {r.ord for r in dd.deduplicate(df, "ord", LOOSE, verify=True).collect()}
    assert got == set(kept) and 5 < len(kept) < len(rows)
    assert got >= {r.ord for r in dd.deduplicate(df, "ord", LOOSE).collect()}
    assert dd.deduplicate(df.limit(0), "ord", verify=True).count() == 0


def test_signatures_of_a_batch_are_those_of_each_text():
    import hashlib

    import numpy as np
    import pyarrow as pa

    texts = ["", " \n", "a", "a b c d", "a\u2003b\x85c d  e\tf g", "é " * 700, *(t or "" for _, t in near_corpus(3))]
    a, b = dd.coefficients(128)
    got = np.concatenate([dd._signatures(p, 5, a, b) for p in dd._slices(pa.array(texts, pa.large_string()))])
    for row, text in zip(got, texts):
        base = [int.from_bytes(hashlib.sha1(x.encode()).digest()[:4], "little") for x in shingle_set(text)]
        want = [min(((int(p) * h + int(q)) % (1 << 64)) % dd.PRIME & dd.MASK for h in base) for p, q in zip(a, b)]
        assert row.tolist() == want


def test_a_shingle_that_comes_again_in_a_slice_is_hashed_once(monkeypatch):
    import hashlib

    import pyarrow as pa

    hashed, sha1 = [], hashlib.sha1
    monkeypatch.setattr(hashlib, "sha1", lambda data: hashed.append(data) or sha1(data))
    text = "one two three four five six seven"
    digests, bounds = dd.shingle_digests(pa.array([text, text, text + " eight"]), 5)
    assert bounds.tolist() == [0, 3, 6, 10]
    assert len(hashed) == len(set(hashed)) == 4
    assert digests[:3].tolist() == digests[3:6].tolist() == digests[6:9].tolist()


def test_texts_are_hashed_a_bounded_part_of_a_batch_at_a_time():
    import pyarrow as pa

    texts = pa.array(["word " * 20_000] * 100)
    assert max(len(part) for part in dd._slices(texts)) <= 11


def test_candidates_are_compared_without_written_sets(spark, monkeypatch):
    names, materialize = [], dd.materialize
    monkeypatch.setattr(dd, "materialize", lambda df, name: names.append(name) or materialize(df, name))
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (2, text + " thirteen"), (3, None), (4, ""), (5, "something else in every word of it"), (2, text)]
    got = dd.candidate_jaccard(spark.createDataFrame(rows, "ord int, text string"), "ord", LOOSE)
    found = sorted((r.head, r.ord, r.common, r.total) for r in got.collect())
    assert found == [(1, 2, 8, 8), (1, 2, 8, 9), (3, 4, 1, 1)]
    assert "shingle-sets" not in names
