import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import models
from textloom.operators import bpe_encode as be
from textloom.operators import bpe_train as bt
from textloom.operators import validate as vl
from textloom.operators import vocab as vb

DOCS = "/root/testdata/sf0.001/documents.parquet"


def counts_frame(spark, words):
    from textloom.session import materialize

    return materialize(spark.createDataFrame(list(words.items()), "word string, n bigint"), "words")


def random_words(seed):
    draw = random.Random(seed)
    letters = "ab" if seed % 2 else "abcd"
    return Counter("".join(draw.choices(letters, k=draw.randrange(1, 9))) for _ in range(60))


@pytest.mark.parametrize("seed, top, proposals", [(0, 8_192, (16, 512)), (1, 5, (16, 512)), (2, 3, (2, 2)), (3, 7, (64, 64))])
def test_same_as_one_merge_at_a_time(spark, monkeypatch, seed, top, proposals):
    """Ties, runs of one letter, pairs that spell a token already, recounts."""
    monkeypatch.setattr(bt, "PROPOSALS", proposals)
    monkeypatch.setattr(bt, "HEAD_WORDS", 10)
    monkeypatch.setattr(bt, "REBASE_MERGES", 20)
    words = random_words(seed)
    got = bt.train_from_counts(counts_frame(spark, words), 45, 2, top=top)
    ids = vb.byte_ids({b for w in words for b in w.encode()})
    tokens, merges = models.train(words, ids, vb.SPECIALS, 45, 2)
    assert got.tokens == tokens
    assert got.merges == merges


def swapped(monkeypatch, mix):
    """Proposals of older symbols only, all but the first in the order `mix` gives."""
    propose = bt.propose

    def proposed(ranking, head, spell, *rest):
        base = len(spell)
        old = [p for p in propose(ranking, head, spell, *rest) if max(p[:2]) < base]
        if old[0][2] < base:
            return old
        return [(left, right, base + i) for i, (left, right, _) in enumerate(old[:1] + mix(old[1:]))]

    monkeypatch.setattr(bt, "propose", proposed)


@pytest.mark.parametrize("seed", range(4))
def test_proposals_in_any_order_lead_to_the_same_merges(spark, monkeypatch, seed):
    draw = random.Random(seed)
    swapped(monkeypatch, lambda old: draw.sample(old, len(old)))
    words = random_words(seed)
    got = bt.train_from_counts(counts_frame(spark, words), 35, 2)
    ids = vb.byte_ids({b for w in words for b in w.encode()})
    assert (got.tokens, got.merges) == models.train(words, ids, vb.SPECIALS, 35, 2)


def test_merges_that_do_not_meet_change_places_within_a_round(spark, monkeypatch):
    swapped(monkeypatch, lambda old: old[::-1])
    rounds, changes = [], bt._changes
    monkeypatch.setattr(bt, "_changes", lambda *a: rounds.append(1) or changes(*a))
    got = bt.train_from_counts(counts_frame(spark, {"ab": 9, "cd": 8, "ef": 7, "gh": 6}), 100, 2)
    assert [m[3] for m in got.merges] == [9, 8, 7, 6]
    assert len(rounds) == 1


def test_runs_of_merges_apply_as_in_sequence():
    draw = random.Random(5)
    for _ in range(300):
        words = [[draw.randrange(4) for _ in range(draw.randrange(1, 12))] for _ in range(8)]
        merges = [(draw.randrange(4 + i), draw.randrange(4 + i), 4 + i) for i in range(8)]
        flat = np.array([s for w in words for s in [*w, -1]], dtype=np.int64)
        for run in bt.together(merges):
            flat = bt.merge_all(flat, run)
        expected = []
        for w in words:
            for left, right, new in merges:
                w = models.merge_once(w, (left, right), new)
            expected += [*w, -1]
        assert flat.tolist() == expected


def test_reported_changes_are_the_difference_of_counts():
    draw = random.Random(6)
    for _ in range(300):
        words = [[draw.randrange(3) for _ in range(draw.randrange(1, 10))] for _ in range(6)]
        weight = np.array([draw.randrange(1, 9) for _ in words], dtype=np.int64)
        w = bt.Words.of(np.array([s for x in words for s in [*x, -1]], dtype=np.int64), weight)

        def count():
            return Counter(dict(zip(*(x.tolist() for x in w.totals()))))

        spelled = [list(x) for x in words]
        for new in range(3, 9):  # pairs of merged symbols are found through the index as well
            left, right = draw.randrange(new), draw.randrange(new)
            before, spare = count(), w.copy()
            changes = Counter(dict(zip(*(x.tolist() for x in w.merge(left, right, new)))))
            after = count()
            assert {k: after[k] - before[k] for k in before | after if after[k] != before[k]} == {
                k: v for k, v in changes.items() if v
            }
            spelled = [models.merge_once(x, (left, right), new) for x in spelled]
            want = Counter()
            for x, n in zip(spelled, weight.tolist()):
                for pair in zip(x, x[1:]):
                    want[pair[0] * bt.PAIR + pair[1]] += n
            assert after == want and Counter(dict(zip(*(x.tolist() for x in spare.totals())))) == before


@pytest.mark.parametrize("seed", range(4))
def test_ranking_is_cut_and_counted_again(spark, monkeypatch, seed):
    monkeypatch.setattr(bt, "RANKED", 1)
    monkeypatch.setattr(bt, "FEW_RUNS", 0)
    monkeypatch.setattr(bt, "HEAD_WORDS", 2)
    words = random_words(seed)
    got = bt.train_from_counts(counts_frame(spark, words), 40, 2, top=4)
    ids = vb.byte_ids({b for w in words for b in w.encode()})
    assert (got.tokens, got.merges) == models.train(words, ids, vb.SPECIALS, 40, 2)


def test_packed_words_merge_as_before():
    draw = random.Random(8)
    for _ in range(200):
        words = [[draw.randrange(3) for _ in range(draw.randrange(1, 10))] for _ in range(6)]
        weight = np.array([draw.randrange(1, 9) for _ in words], dtype=np.int64)
        w = bt.Words(np.array([s for x in words for s in [*x, -1]], dtype=np.int64), weight)
        for new in range(3, 9):
            pair = draw.randrange(new), draw.randrange(new)
            p = w.packed()
            changes = [dict(zip(*(x.tolist() for x in v.merge(*pair, new)))) for v in (w, p)]
            assert changes[0] == changes[1]
            assert [dict(zip(*(x.tolist() for x in v.totals()))) for v in (w, p)][0] == dict(
                zip(*(x.tolist() for x in p.totals()))
            )


def test_words_are_drawn_with_weights_that_stand_for_all(spark):
    n = np.array([1_000, 50, 3, 1])
    symbols = np.array([10, 400, 3_000, 90_000])
    assert bt._least_weight(n, symbols, 100_000) == 0
    least = bt._least_weight(n, symbols, 2_000)
    assert abs((symbols * np.minimum(1, n / least)).sum() - 2_000) < 1
    rows = [([i % 7, i], 1 + i % 5) for i in range(8_000)] + [([9, 9, 9], 70_000)]
    words = spark.createDataFrame(rows, "symbols array<int>, n bigint")
    head = bt._head(words, 4_000)
    drawn = np.bincount(np.cumsum(head.flat == -1) - (head.flat == -1))
    assert 3_000 < drawn.sum() - len(drawn) < 5_000 and 9 * bt.PAIR + 9 in head.totals()[0]
    assert abs(head.weight[head.flat == -1].sum() - sum(r[1] for r in rows)) < 3_000
    assert len(bt._head(words, 20_000).weight) == 3 * 8_000 + 4


def test_a_round_gains_many_merges(spark, docs, monkeypatch):
    """Proposals are right for most of a round, and those left over tell what they change."""
    rounds, changes = [], bt._changes
    monkeypatch.setattr(bt, "_changes", lambda *a: rounds.append(1) or changes(*a))
    got = bt.train(docs, 1_500)
    assert len(got.tokens) == 1_500 and len(rounds) <= 12, len(rounds)


def test_merging_a_word_is_best_rank_first():
    draw = random.Random(7)
    for _ in range(300):
        merges, pairs = [], set()
        for i in range(10):
            pair = (draw.randrange(3 + i), draw.randrange(3 + i))
            if pair not in pairs:
                pairs.add(pair)
                merges.append((*pair, 3 + len(merges), 1))
        symbols = [draw.randrange(3) for _ in range(draw.randrange(1, 20))]
        ranks = {(a, b): (r, new) for r, (a, b, new, _) in enumerate(merges)}
        assert be.merge_word(list(symbols), ranks) == models.encode(list(symbols), merges)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS).select("doc_id", "text").repartition(8).cache()


@pytest.fixture(scope="module")
def model(docs):
    return bt.train(docs, 400)


@pytest.fixture(scope="module")
def full(docs):
    return bt.train(docs, 300, full_alphabet=True)


def test_same_vocabulary_and_ids_as_a_public_trainer(spark, docs, model):
    tk = pytest.importorskip("tokenizers")
    other = tk.Tokenizer(tk.models.BPE(unk_token="<unk>"))
    other.pre_tokenizer = tk.pre_tokenizers.ByteLevel(add_prefix_space=False)
    other.post_processor = tk.processors.TemplateProcessing(
        single="<s> $A </s>", pair="<s> $A </s> $B:1 </s>:1", special_tokens=[("<s>", 1), ("</s>", 2)]
    )
    trainer = tk.trainers.BpeTrainer(
        vocab_size=400, min_frequency=2, special_tokens=list(vb.SPECIALS), show_progress=False
    )
    other.train_from_iterator((r.text.strip() for r in docs.collect()), trainer)
    assert {r.token: r.id for r in model.vocab_table(spark).collect()} == other.get_vocab()

    extra = ["", " ", "漢字 and 😀", "a <s> b</s><mask>x  ", "tab\tand  two\n\n lines", "it's we'll", "\x85\xa0 x"]
    rows = [(i, t) for i, t in enumerate([*extra, *(r.text for r in docs.collect())])]
    df = spark.createDataFrame(rows, "i int, text string")
    for r in be.encode_documents(df, model).collect():
        assert list(r.ids) == other.encode(r.text).ids, r.text[:80]

    pair = df.filter("i < 5").select("text", be.encode_pair(F.col("text"), F.lit("the end"), model).alias("p"))
    for r in pair.collect():
        want = other.encode(r.text, "the end")
        assert list(r.p.ids) == want.ids and list(r.p.type_ids) == want.type_ids
    shown = df.filter("i = 4").select(be.token_strings(be.encode(F.col("text"), model), model).alias("t")).first().t
    assert list(shown) == other.encode(rows[4][1]).tokens


def test_four_thousand_tokens_are_those_of_a_public_trainer(spark, docs):
    """Past the alphabet and the short pairs: merges of merges, many ties."""
    tk = pytest.importorskip("tokenizers")
    other = tk.Tokenizer(tk.models.BPE(unk_token="<unk>"))
    other.pre_tokenizer = tk.pre_tokenizers.ByteLevel(add_prefix_space=False)
    trainer = tk.trainers.BpeTrainer(vocab_size=4_000, min_frequency=2, special_tokens=list(vb.SPECIALS), show_progress=False)
    other.train_from_iterator((r.text.strip() for r in docs.collect()), trainer)
    got = bt.train(docs, 4_000)
    assert {r.token: r.id for r in got.vocab_table(spark).collect()} == other.get_vocab()


def test_the_larger_query_asks_for_the_size_of_the_job(spark, monkeypatch):
    from textloom.catalog import vocabulary
    from textloom.config import Settings

    asked = []
    stop = lambda spark, sf_dir, size: asked.append(size) or bt.Vocabulary([])
    monkeypatch.setattr(vocabulary, "_trained", stop)
    monkeypatch.setattr(bt.Vocabulary, "merge_table", lambda self, spark: None)
    vocabulary.train_larger(spark, "")
    assert asked == [Settings().vocab_size]


def test_roundtrip_of_the_probes(spark, model, full):
    probes = vl.probe_texts(spark)
    assert all(r.ok for r in vl.roundtrip(probes, full).collect())
    failed = {r.label for r in vl.roundtrip(probes, model).collect() if not r.ok}
    assert "chinese" in failed and "english" not in failed  # bytes the corpus lacks


def test_save_and_load(spark, model, tmp_path):
    model.save(spark, str(tmp_path / "v"))
    assert bt.Vocabulary.load(spark, str(tmp_path / "v")) == model


def test_metrics_pool_all_texts(spark, full):
    df = spark.createDataFrame([("a b c",), ("dd",)], "text string")
    row = vl.text_metrics(df, full).first()
    tokens = [len(r.ids) for r in be.encode_documents(df, full).collect()]
    assert (row.chars, row.words, row.tokens, row.docs) == (7, 4, sum(tokens), 2)
    assert row.compression_ratio == 7 / sum(tokens) and row.fertility == sum(tokens) / 4


def test_validation_without_a_sample(spark, full):
    df = spark.createDataFrame([(1, "  ")], "ord bigint, text string")
    row = vl.validation_results(df, "ord", full).first()
    assert (row.docs_sampled, row.compression_ratio, row.fertility) == (0, None, None)
    assert (row.vocab_size, row.roundtrip_failures) == (300, 0)


def test_empty_corpus(spark):
    model = bt.train(spark.createDataFrame([], "text string"), 300)
    assert len(model.tokens) == 5 and model.merges == []


def test_decoding_nulls_cut_characters_and_empty_lists(spark, full):
    ids = {r.i: list(r.ids) for r in be.encode_documents(
        spark.createDataFrame([(0, "é x"), (1, "")], "i int, text string"), full).collect()}
    rows = [(0, ids[0]), (1, ids[1]), (2, None), (3, []), (4, ids[0][:2]), (5, [0, 1, 2, 3, 4])]
    df = spark.createDataFrame(rows, "i int, ids array<int>").repartition(1)
    got = {r.i: r.t for r in df.select("i", be.decode(F.col("ids"), full).alias("t")).collect()}
    assert (got[0], got[1], got[2], got[3], got[5]) == ("é x", "", None, "", "") and "\ufffd" in got[4]
    assert be.encode_documents(df.select(F.lit("a").alias("text")).limit(0), full).count() == 0


def test_batches_are_coded_in_bounded_slices(spark, full, monkeypatch):
    monkeypatch.setattr(be, "SLICE_ITEMS", 10)
    texts = pa.array([["a", "b", "c"], None, [], *[["x"] * 4] * 30, ["y"] * 50])
    assert [x for part in be._slices(texts) for x in part.to_pylist()] == texts.to_pylist()
    assert max(len(p.flatten()) for p in be._slices(texts) if len(p) > 1) < 20
    df = spark.createDataFrame([(t,) for t in ["one two three", None, "", *["four five six"] * 40, "z " * 90]], "text string")
    ids = df.coalesce(1).select("text", be.encode(F.col("text"), full).alias("ids"))
    assert all(r.back == (r.text or "") for r in ids.select("text", be.decode(F.col("ids"), full).alias("back")).collect())


def test_specials_are_found(spark, model):
    assert {r.token for r in vl.special_tokens(model.vocab_table(spark)).collect()} == set(vb.SPECIALS)


def test_metrics_from_the_counts_of_training(spark):
    """Words cut once for both: the same as encoding every text, special tokens included."""
    texts = ["a low lower lowest  low", "say <s> or <unk>, <s>", " ", None, "\u3000it's lower's  \n\n end ", "a low lower lowest  low", "x<mask>"]
    rows = [(i, lang, t) for lang in ("en", None, "de") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    for groups in ((), ("lang",)):
        model, cut, counts = vl.train_counted(df, 60, *groups)
        assert model == bt.train(df, 60) and len(model.merges) > 3
        plain = vl.text_metrics(cut, model, *groups)
        counted = vl.text_metrics(cut, model, *groups, counts=counts)
        assert sorted(map(str, counted.collect())) == sorted(map(str, plain.collect()))
        assert counted.dtypes == plain.dtypes
        # Texts that spell no special token do not go to the encoder again.
        assert counts.filter("_special").count() > 0
    nothing = vl.train_counted(df.filter("false"), 60)
    assert vl.text_metrics(nothing[1], nothing[0], counts=nothing[2]).first()["docs"] == 0
