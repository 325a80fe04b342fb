import numpy as np

from tests.llm import odd
from textloom.llm import groups, ngram_join, queries


def shingles(text):
    words = (text or "").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, threshold=0.8):
    """(id, n_links, class_id, kept) of (id, text) rows, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    near = [[j for j in range(n) if j != i and sets[i] and sets[j] and
             len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])] for i in range(n)]
    low = lambda i: (-1 << 70) if rows[i][0] is None else rows[i][0]
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            best = min([label[i], *(label[j] for j in near[i])])
            changed |= best != label[i]
            label[i] = best
    smallest = {}
    for i in range(n):
        smallest[label[i]] = min(smallest.get(label[i], low(i)), low(i))
    ids = [None if smallest[label[i]] == -1 << 70 else smallest[label[i]] for i in range(n)]
    return [(r[0], len(near[i]), ids[i] if sets[i] else r[0]) for i, r in enumerate(rows)]


def found(df):
    return sorted(((r["doc_id"], r["n_links"], r["class_id"]) for r in df.collect()), key=repr)


def edited(text, seed, share):
    draw = np.random.default_rng(seed)
    return " ".join(f"new{seed}x{k}" if draw.random() < share else w for k, w in enumerate(text.split()))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(queries.op6_shingle_join(spark, sf)) == sorted(brute(rows), key=repr)


def test_edits_near_the_threshold(spark):
    rows = []
    for base in range(12):
        text = odd.prose(base + 1, 150)
        rows += [(base * 10 + k, edited(text, base * 10 + k, share), "en", "", 0) for k, share in enumerate((0, 0.01, 0.02, 0.03, 0.04))]
    got = found(ngram_join.join(odd.documents(spark, rows)))
    assert got == sorted(brute([r[:2] for r in rows]), key=repr)


def test_one_large_group_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(groups, "BLOCK", 16)
    text = odd.prose(3, 200)
    rows = [(i, edited(text, i, 0.005), "en", "", 0) for i in range(80)] + [(100 + i, text, "en", "", 0) for i in range(60)]
    got = found(ngram_join.join(odd.documents(spark, rows)))
    assert got == sorted(brute([r[:2] for r in rows]), key=repr)


def test_odd_rows_and_kept(spark):
    df = odd.documents(spark)
    rows = [r[:2] for r in odd.ROWS]
    assert found(ngram_join.join(df)) == sorted(brute(rows), key=repr)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 3, 4, 5, None, 7, 8, 8], key=repr)
    assert ngram_join.join(odd.empty(spark)).count() == 0
    assert ngram_join.keep_one(odd.empty(spark)).count() == 0


def test_posterior_bound():
    draw = np.random.default_rng(1)
    equal = draw.binomial(33, 0.8, 200_000)  # P(S >= t | m of 32) as a binomial tail
    m = ngram_join.needed(32, 0.8, 1e-3)
    assert (equal <= m).mean() > 0.8e-3 and (equal < m).mean() < 1.2e-3
    assert ngram_join.needed(160, 0.8, 1e-6) > 80


def test_minhash_estimates_the_similarity():
    hashes = np.sort(np.random.default_rng(2).integers(0, 1 << 62, 1_100).astype(np.uint64))
    both = np.concatenate([hashes[:1_000], hashes[100:]])
    rows = ngram_join.minhash(both, np.array([0, 1_000, 2_000]), 4_000)
    assert abs((rows[0] == rows[1]).mean() - 900 / 1_100) < 0.03
