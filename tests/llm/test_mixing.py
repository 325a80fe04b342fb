import hashlib
from collections import Counter, defaultdict

import pytest

from tests.llm import odd
from textloom.llm import mixing

LEVELS = ("domain", "lang", "source")


def water(budget, children):
    """(name, cap, weight) filled one after the other: the plain rule."""
    left, out, open_ = budget, {}, sorted(children, key=lambda c: (c[1] / c[2], c[0]))
    while open_:
        name, cap, weight = open_[0]
        if cap * sum(c[2] for c in open_) > left * weight:
            break
        out[name] = cap
        left -= cap
        open_.pop(0)
    total = sum(c[2] for c in open_)
    run = 0
    for name, _, weight in open_:
        out[name] = left * (run + weight) // total - left * run // total if total else 0
        run += weight
    return out


def plain(rows, share, epochs, weights, seed=42):
    """Rows (id, text, path) to the taken (id, epoch, tokens, start), one by one."""
    tokens = [len((t or "").split()) for _, t, _ in rows]
    leaves = Counter()
    for n, (_, _, path) in zip(tokens, rows):
        if n:
            leaves[path] += n
    total = sum(leaves.values())

    def give(prefix, budget):
        depth = len(prefix)
        if depth == 3:
            return {prefix: budget}
        caps = Counter()
        for path, n in leaves.items():
            if path[:depth] == prefix:
                caps[path[depth]] += n * epochs
        w = weights[depth]
        got = water(budget, [(c, cap, w.get(c, w.get("*", 1))) for c, cap in caps.items()])
        out = {}
        for child, b in got.items():
            out |= give((*prefix, child), b)
        return out

    out = []
    for path, budget in give((), min(total * share[0] // share[1], total * epochs)).items():
        mine = [(i, n) for (i, _, p), n in zip(rows, tokens) if p == path and n]
        at = 0
        for epoch in range(epochs):
            key = lambda x: (hashlib.md5(f"{seed}:{epoch}:{'(none)' if x[0] is None else x[0]}".encode()).hexdigest(), x[1])  # noqa: B023, E731
            for i, n in sorted(mine, key=key):
                if at < budget:
                    out.append((i, epoch, min(n, budget - at), at))
                at += n
    return out


def taken(df):
    return [(r["doc_id"], r["epoch"], r["take_tokens"], r["stream_start"]) for r in df.collect()]


@pytest.mark.parametrize("share,epochs", [((1, 2), 4), ((3, 1), 4), ((3, 4), 1), ((0, 1), 2)])
def test_against_the_plain_rule(spark, share, epochs):
    docs = [(i, odd.prose(i, 5 + i * 37 % 90), ["en", "de"][i % 3 == 0], f"s{i % 4}", 0) for i in range(300)]
    df = odd.documents(spark, docs).selectExpr("*", "concat('d', doc_id % 5 % 2) as domain")
    rows = [(d[0], d[1], (f"d{d[0] % 5 % 2}", d[2], d[3])) for d in docs]
    weights = ({"d1": 9}, {"en": 3, "*": 2}, {"s1": 5})
    got = mixing.mix(df, share, epochs, weights)
    assert sorted(taken(got)) == sorted(plain(rows, share, epochs, weights))
    for r in got.collect():
        words = r["text"].split()[: r["take_tokens"]]
        assert r["mixed_text"] == " ".join(words)


def test_odd_rows(spark):
    df = odd.documents(spark).selectExpr("*", "cast(null as string) as domain")
    rows = [(r[0], r[1], ("(none)", r[2] or "(none)", r[3] or "(none)")) for r in odd.ROWS]
    got = mixing.mix(df, (1, 1), 2)
    assert sorted(taken(got), key=repr) == sorted(plain(rows, (1, 1), 2, ({}, {}, {})), key=repr)
    assert set(df.columns) <= set(got.columns)
    assert mixing.mix(df.filter("false")).count() == 0


def test_prefix_keeps_the_blanks(spark):
    df = spark.createDataFrame([("  a\n\nb\tc  d ", 2), ("a", 1)], "t string, n long")
    got = [r[0] for r in df.select(mixing.token_prefix(df["t"], df["n"])).collect()]
    assert got == ["  a\n\nb", "a"]


def test_shortage_goes_to_siblings_first(spark):
    docs = [(i, odd.prose(i, 10), lang, source, 0) for i, (lang, source) in enumerate(
        [("en", "small")] * 1 + [("en", "large")] * 100 + [("de", "other")] * 100
    )]
    df = odd.documents(spark, docs).selectExpr("*", "'d' as domain")
    sums = defaultdict(int)
    for r in mixing.mix(df, (1, 2), 1).collect():
        sums[r["source"]] += r["take_tokens"]
    assert sums == {"small": 10, "large": 492, "other": 503} or sums == {"small": 10, "large": 493, "other": 502}


def test_rows_of_one_id_are_ordered_by_their_texts(spark):
    """The same rows in any order give the same prefix."""
    texts = ["a b c", "d e f", "g h i", "j k l", "m n o"]
    taken = set()
    for turn in range(3):
        rows = [(7, t, "en", "s", "d") for t in texts[turn:] + texts[:turn]]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")
        got = mixing.mix(docs.coalesce(1), share=(1, 3), epochs=1).collect()
        taken.add(tuple(sorted((r["mixed_text"], r["stream_start"]) for r in got)))
    first = sorted(texts, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert taken == {tuple(sorted([(first[0], 0), (first[1][:3], 3)]))}
