import hashlib
import re

import numpy as np
import pytest

from tests.llm import odd
from textloom.llm import queries, suffix


def brute(texts, length):
    """(n_removed, n_spans, sha256) of each text, by counting every window."""
    counts = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            counts[t[i : i + length]] = counts.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0]) if len(t) else 0
        out.append((int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df):
    return [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()]


def expected(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    return [(r[0], len(t), *b) for r, t, b in zip(rows, texts, brute(texts, length))]


def order(rows):
    return sorted(rows, key=repr)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert order(found(queries.op2_suffix_repeats(spark, sf))) == order(expected(docs, 400))


@pytest.mark.parametrize("length", [20, 400])
def test_odd_rows(spark, length):
    rows = [*odd.ROWS, (20, "a" * 1_000, "", "", 0), (21, "ab" * 600, "", "", 0), (22, "é" * 250, "", "", 0)]
    got = found(suffix.deduplicate(odd.documents(spark, rows), length))
    assert order(got) == order(expected(rows, length))


def test_many_contexts_of_one_anchor(spark, monkeypatch):
    """A passage in documents that differ around it, dealt over many parts."""
    draw = np.random.default_rng(2)
    passage = "".join(chr(97 + c) for c in draw.integers(0, 26, 90))
    rows = []
    for i in range(60):
        ends = ["".join(chr(97 + c) for c in draw.integers(0, 3, 40)) for _ in range(2)]
        rows.append((i, ends[0] + passage[i % 3 :] + ends[1], "", "", 0))
    monkeypatch.setattr(suffix, "SHARED_MOST", 4)
    assert order(found(suffix.deduplicate(odd.documents(spark, rows), 40))) == order(expected(rows, 40))


def hot(passages=2, texts=30):
    """Texts that share passages, each with its own surroundings; one text twice."""
    draw = np.random.default_rng(6)
    fresh = lambda n: "".join(chr(97 + c) for c in draw.integers(0, 26, n))
    shared = [fresh(60) for _ in range(passages)]
    rows = [(i, fresh(50) + shared[i % passages] + fresh(50), "", "", 0) for i in range(texts)]
    return [*rows, (900, rows[0][1], "", "", 0), (901, fresh(80), "", "", 0), (902, None, "", "", 0)]


def test_contexts_of_a_hot_anchor_move_once(spark, monkeypatch):
    """They are dealt by anchor and part, never brought together by the anchor alone."""
    plans, write = {}, suffix.stepped

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(suffix, "stepped", watched)
    monkeypatch.setattr(suffix, "SHARED_MOST", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = found(suffix.deduplicate(odd.documents(spark, hot()), 40))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert order(got) == order(expected(hot(), 40))
    by = re.findall(r"hashpartitioning\(([^)]*)\)", plans["found"])
    assert by and all("part#" in keys for keys in by), by


def test_shuffled_steps_are_stepped_and_settings_put_back(spark, monkeypatch):
    steps, write = [], suffix.stepped
    monkeypatch.setattr(suffix, "stepped", lambda df, name: steps.append(name) or write(df, name))
    before = spark.conf.getAll
    suffix.deduplicate(odd.documents(spark, hot()), 40).collect()
    assert {"texts", "anchors", "concerned", "pool", "found"} <= set(steps)
    assert spark.conf.getAll == before


def test_many_hot_anchors_are_joined(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SHARED_MOST", 4)
    monkeypatch.setattr(suffix, "BROADCAST_IDS", 0)
    assert order(found(suffix.deduplicate(odd.documents(spark, hot()), 40))) == order(expected(hot(), 40))


def test_windows_of_texts_side_by_side():
    """Anchors of texts in one buffer are those of each text alone."""
    draw = np.random.default_rng(7)
    texts = [draw.integers(0, 3, n).astype(np.uint8) for n in (0, 19, 20, 21, 0, 20, 60, 5, 20, 0)]
    bounds = np.cumsum([0, *map(len, texts)])
    got = list(zip(*(x.tolist() for x in suffix.anchors(np.concatenate(texts), bounds, 20))))
    want = []
    for i, t in enumerate(texts):
        _, *rest = suffix.anchors(t, np.array([0, len(t)]), 20)
        want += [(i, *r) for r in zip(*(x.tolist() for x in rest))]
    assert got == want
    starts = [(d, s) for d, _, first, last, _ in got for s in range(first, last + 1)]
    assert starts == [(i, s) for i, t in enumerate(texts) for s in range(len(t) - 19)]


@pytest.mark.parametrize("size", [100, 3_000, 1 << 21])
def test_suffix_order(size):
    """Sizes of which ranks go by nine, five and two side by side."""
    draw = np.random.default_rng(size)
    part = draw.integers(1, 4, 450)
    symbols = np.concatenate([np.tile(part, 3), draw.integers(1, 250, size)])[:size].astype(np.int16)
    symbols[-1] = 0
    rows = suffix.suffix_order(symbols, 400)
    assert (np.sort(rows) == np.arange(size)).all()
    raw = symbols.astype(np.uint8).tobytes()
    near = [raw[r : r + 400] for r in rows[: 20_000].tolist()]
    assert near == sorted(near)


def test_slices_of_long_texts(monkeypatch):
    monkeypatch.setattr(suffix, "SLICE", 1_000)
    raw = np.random.default_rng(3).integers(0, 4, 5_000).astype(np.uint8)
    whole = suffix.anchors(raw, np.array([0, len(raw)]), 50)
    starts = set()
    for piece, cuts, _, offset in suffix.slices(raw, np.array([0, len(raw)]), 50):
        doc, place, first, last, _ = suffix.anchors(piece, cuts, 50)
        starts |= {(int(s), int(p + offset)) for f, la, p in zip(first, last, place) for s in range(f + offset, la + offset + 1)}
    want = {(s, int(p)) for f, la, p in zip(whole[2], whole[3], whole[1]) for s in range(f, la + 1)}
    assert starts == want


def test_repeats_across_slice_edges(spark, monkeypatch):
    """Long texts whose repeated passages lie over, and start or end near, every edge."""
    monkeypatch.setattr(suffix, "SLICE", 1_000)
    draw = np.random.default_rng(5)
    fresh = lambda n: "".join(chr(97 + c) for c in draw.integers(0, 26, n))
    rows = []
    for i, size in enumerate((50, 60, 75, 90, 98, 120)):
        text, others = fresh(5_300), []
        for edge in (1_000, 2_000, 3_000, 4_000, 5_000):
            at = edge - size + int(draw.integers(0, size + 50))
            others.append(fresh(70) + text[at : at + size] + fresh(70))
        rows += [(100 * i, text, "", "", 0), *((100 * i + k + 1, t, "", "", 0) for k, t in enumerate(others))]
    rows.append((900, rows[0][1], "", "", 0))
    assert order(found(suffix.deduplicate(odd.documents(spark, rows), 50))) == order(expected(rows, 50))


def test_intervals_match_sorting():
    draw = np.random.default_rng(4)
    contexts = [bytes(draw.integers(97, 99, n).astype(np.uint8)) for n in (30, 40, 50, 60)]
    contexts.append(contexts[2][5:45])
    owner, offset, interval, total = suffix.repeats(contexts, np.ones(5, np.int64), 8)
    names = {}
    for o, at, i, n in zip(owner, offset, interval, total):
        names.setdefault(contexts[o][at : at + 8], []).append((i, n))
    assert all(len(set(v)) == 1 and v[0][1] == len(v) for v in names.values())
    assert len({v[0][0] for v in names.values()}) == len(names)


def test_texts_and_empty(spark):
    assert suffix.deduplicate(odd.empty(spark)).count() == 0
    cleaned = suffix.deduplicate(odd.documents(spark), 400, texts=True)
    assert {"kept_text", *odd.CLASHING} <= set(cleaned.columns)
    kept = {(r["doc_id"], r["text"]): r["kept_text"] for r in cleaned.collect()}
    assert kept[(3, None)] is None and kept[(8, "two words")] == "two words"
    assert kept[(1, odd.prose(1, 120))] == ""
