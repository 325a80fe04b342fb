import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import odd
from textloom.llm import packing
from textloom.llm.settings import tokenizer_paths
from textloom.llm.tokens import Encoder


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_paths()[0])


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, docs, window):
    """Pieces of (key -> ids), a key per row: gapless cover of documents and windows."""
    by, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        by[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
    assert set(by) == set(docs)
    for key, parts in by.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["start"]):
            ids = docs[key][p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(docs[key]) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
            at += p["length"]
        assert at == len(docs[key])
    for number, parts in windows.items():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or (number == max(windows) and at <= window)
        assert {p["sequence_tokens"] for p in parts} == {at}
    assert set(windows) == set(range(len(windows)))


@pytest.mark.parametrize("window,weights", [(64, None), (2_048, None), (64, {"a": 5, "*": 1})])
def test_packs_every_id_once(spark, whole, window, weights):
    docs = [(i, odd.prose(i, 3 + i * 13 % 200), "en", "abcde"[i * i % 5], 0) for i in range(200)]
    docs.append((1_000, "".join(chr(0x4E00 + i % 3_000) for i in range(4_000)), "zh", None, 0))
    df = odd.documents(spark, docs).repartition(5)
    pieces = packing.pack(df, *tokenizer_paths(), window=window, weights=weights).collect()
    check(pieces, {d[0]: ids_of(whole, d[1]) for d in docs}, window)


def test_windows_hold_the_proportions(spark):
    docs = [(i, odd.prose(i, 100), "en", "ab"[i % 4 == 0], 0) for i in range(400)]
    pieces = packing.pack(odd.documents(spark, docs), *tokenizer_paths(), window=256).collect()
    total = Counter()
    for p in pieces:
        total[p["queue"]] += p["length"]
    share = total["a"] / sum(total.values())
    for number in range(max(p["sequence_id"] for p in pieces)):
        a = sum(p["length"] for p in pieces if p["sequence_id"] == number and p["queue"] == "a")
        assert abs(a - 256 * share) <= 2


def test_odd_rows(spark, whole):
    pieces = packing.pack(odd.documents(spark), *tokenizer_paths(), window=128).collect()
    assert sum(p["length"] for p in pieces) == sum(len(ids_of(whole, r[1])) for r in odd.ROWS)
    assert sum(p["doc_id"] is None for p in pieces) > 0
    empty = [p for p in pieces if p["doc_id"] in (3, 4)]
    assert [(p["length"], p["doc_tokens"]) for p in empty] == [(1, 1), (1, 1)]
    assert packing.pack(odd.empty(spark), *tokenizer_paths()).count() == 0


def test_schedule_serves_tokens_that_fall_due_together():
    totals = np.array([7, 7, 7, 1, 50])
    schedule = packing.Schedule(totals, np.array([7.0, 7.0, 7.0, 7.0, 7.0]), 8)
    served = schedule.served(np.arange(11))
    assert (served.sum(axis=1) == np.minimum(np.arange(11) * 8, 72)).all()
    assert (np.diff(served, axis=0) >= 0).all() and (served[-1] == totals).all()


def test_ids_equal_the_tokenizers(whole):
    draw = np.random.default_rng(7)
    letters = list("ab1 2''''stvremld  \n\t!?.é  　日😀́²Ⅷ")
    texts = ["".join(draw.choice(letters, draw.integers(0, 50))) for _ in range(5_000)]
    texts += ["", None, "<|endoftext|> a", "x<|endoftext|>", "'s", "a's's ''s", "\n\n", " ", "don't I'll 'we've"]
    coder = Encoder(*tokenizer_paths())
    for _ in range(2):  # the second time from the cache
        ids, bounds = coder.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids
