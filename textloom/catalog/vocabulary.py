"""Queries over vocabulary training, encoding and validation."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.catalog.common import documents, sql_strip, sql_words
from textloom.config import Settings
from textloom.functions import text as tx
from textloom.operators import bpe_encode as be
from textloom.operators import bpe_train as bt
from textloom.operators import validate as vl
from textloom.session import scratch_root

VOCAB = 256  # tokens the queries train
LARGER = Settings().vocab_size  # 32,000, the size of the job
BASE = 0x4E00  # SQL writes symbol k as the character BASE + k


def _trained(spark: SparkSession, sf_dir: str, size: int = VOCAB, full: bool = False) -> bt.Vocabulary:
    return bt.train(documents(spark, sf_dir), size, full_alphabet=full)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bt.word_counts(documents(spark, sf_dir))


def byte_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bt.byte_counts(bt.word_counts(documents(spark, sf_dir)))


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bt.pair_counts(bt.word_counts(documents(spark, sf_dir)))


def vocab_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary before any merge: specials and single bytes."""
    return _trained(spark, sf_dir, 0).vocab_table(spark)


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir).merge_table(spark)


def train_larger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir, LARGER).merge_table(spark)


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = bt.training_stats(spark, _trained(spark, sf_dir), VOCAB, 2, "run_001")
    return row.withColumn("special_tokens", F.array_join("special_tokens", " "))


def saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of a vocabulary that was written and read back."""
    path = f"{scratch_root(spark)}/vocabulary-{uuid.uuid4().hex}"
    _trained(spark, sf_dir).save(spark, path)
    return bt.Vocabulary.load(spark, path).vocab_table(spark)


def special_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vl.special_tokens(_trained(spark, sf_dir).vocab_table(spark))


def _joined(ids: Column) -> Column:
    return F.md5(F.array_join(ids.cast("array<string>"), ","))


def encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    model = bt.train(d, VOCAB)
    coded = d.select("doc_id", be.encode(tx.strip(F.col("text")), model).alias("ids"))
    return coded.select("doc_id", F.size("ids").alias("n_tokens"), _joined(F.col("ids")).alias("ids_md5"))


def encode_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and its language, with type ids."""
    d = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = bt.train(d, VOCAB)
    pair = be.encode_pair(tx.strip(F.col("text")), F.col("lang"), model)
    coded = d.select("doc_id", pair.alias("p"))
    types = _joined(F.col("p.type_ids")).alias("type_ids_md5")
    return coded.select("doc_id", _joined(F.col("p.ids")).alias("ids_md5"), types)


def probe_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of the fixed sentence, one row each."""
    model = bt.train(documents(spark, sf_dir), VOCAB)
    return vl.probe_tokens(spark, model)


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, whole."""
    d = documents(spark, sf_dir)
    model = bt.train(d, VOCAB)
    coded = d.select("doc_id", be.encode(F.col("text"), model).alias("ids"))
    return coded.select("doc_id", F.md5(be.decode(F.col("ids"), model)).alias("text_md5"))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed probes and every document, by a vocabulary of all bytes."""
    d = documents(spark, sf_dir)
    model = bt.train(d, 300, full_alphabet=True)
    texts = vl.probe_texts(spark).unionByName(d.select(F.concat(F.lit("doc"), "doc_id").alias("label"), "text"))
    return vl.roundtrip(texts, model).select("label", "ok")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, texts, counts = vl.train_counted(documents(spark, sf_dir), VOCAB)
    m = vl.text_metrics(texts, model, counts=counts)
    return m.withColumns({c: F.round(c, 6) for c in ("compression_ratio", "fertility")})


def metrics_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same metrics for every language of the corpus."""
    d = documents(spark, sf_dir, "doc_id", "text", "lang")
    model, texts, counts = vl.train_counted(d, VOCAB, "lang")
    m = vl.text_metrics(texts, model, "lang", counts=counts)
    return m.withColumns({c: F.round(c, 6) for c in ("compression_ratio", "fertility")})


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    return vl.validation_results(d, "doc_id", bt.train(d, VOCAB))


#: Documents that the sampled validation looks at, the first in order.
FIRST_DOCS = 500


def validation_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation on the first documents with a text; training sees them all."""
    d = documents(spark, sf_dir)
    return vl.validation_results(d, "doc_id", bt.train(d, VOCAB), Settings(validation_docs=FIRST_DOCS))


# -- SQL ----------------------------------------------------------------------

_SP = r"\t-\r\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_WORD = rf"''s|''t|''re|''ve|''m|''ll|''d| ?\pL+| ?\pN+| ?[^{_SP}\pL\pN\x01]+|[{_SP}]+"


def _cut(text: str) -> str:
    """Words. RE2 has no lookahead: a mark goes before the last blank of a run
    that a word follows, and ends the run's own match there."""
    marked = rf"regexp_replace({text}, '([{_SP}])([^{_SP}])', chr(1) || '\1\2', 'g')"
    return f"regexp_extract_all({marked}, '{_WORD}')"


TEXTS = f"""texts AS (SELECT doc_id, t FROM (SELECT doc_id, {sql_strip("text")} AS t FROM documents) WHERE t <> '')"""
WORDS = f"""{TEXTS},
    places AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos
               FROM (SELECT doc_id, {_cut("t")} AS ws FROM texts)),
    words AS (SELECT word, count(*) AS n FROM places GROUP BY word)"""
BYTES = """bytes AS (SELECT word, n, unnest(bs) AS byte, generate_subscripts(bs, 1) AS pos FROM (
    SELECT word, n, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::INT) AS bs
    FROM words))"""
# Printable Latin-1 stands for itself, the other bytes for U+0100 and on.
VISIBLE = """visible AS (
    SELECT b AS byte, CASE WHEN own THEN chr(b) ELSE chr(CAST(256 + sum(CAST(NOT own AS INT)) OVER (ORDER BY b) - 1
                                                               AS INT)) END AS token
    FROM (SELECT CAST(range AS INT) AS b,
                 range BETWEEN 33 AND 126 OR range BETWEEN 161 AND 172 OR range >= 174 AS own FROM range(256)))"""
ALPHABET = """alphabet AS (
    SELECT byte, token, CAST(4 + row_number() OVER (ORDER BY unicode(token)) AS INT) AS id
    FROM visible WHERE byte IN (SELECT byte FROM bytes))"""


def _walk(size: int) -> str:
    """One merge at a time: a word is a string of one character per symbol, and
    a merge replaces two characters by a new one."""
    pairs = "list_transform(range(1, length(w)), lambda i: w[i:i + 1])"
    return f"""{WORDS}, {BYTES}, {VISIBLE}, {ALPHABET},
    spelled AS (SELECT word, n, string_agg(chr({BASE} + id), '' ORDER BY pos) AS w
                FROM bytes JOIN alphabet USING (byte) GROUP BY word, n),
    walk(step, word, w, n, p, c) AS (
      SELECT 0, word, w, n, '', 0::BIGINT FROM spelled
      UNION ALL
      SELECT step + 1, word, replace(w, top.p, chr(CAST({BASE} + 5 + (SELECT count(*) FROM alphabet) + step AS INT))),
             n, top.p, top.c
      FROM walk, (SELECT p, CAST(sum(n) AS BIGINT) AS c FROM (SELECT n, unnest({pairs}) AS p FROM walk)
                  GROUP BY p ORDER BY c DESC, p LIMIT 1) top
      WHERE step + 5 + (SELECT count(*) FROM alphabet) < {size} AND top.c >= 2)"""


def _merges(size: int) -> str:
    return f"""WITH RECURSIVE {_walk(size)}
        SELECT DISTINCT step - 1 AS rank, unicode(p[1]) - {BASE} AS left_id, unicode(p[2]) - {BASE} AS right_id,
               CAST(step + 4 + (SELECT count(*) FROM alphabet) AS INT) AS new_id, c AS n
        FROM walk WHERE step > 0"""


_FINAL = """final AS (SELECT word, w FROM walk WHERE step = (SELECT max(step) FROM walk)),
    coded AS (SELECT doc_id, string_agg(w, '' ORDER BY pos) AS w FROM places JOIN final USING (word) GROUP BY doc_id)"""
# Words of given strings by the merges found, one merge after the other.
_STRINGS = f"""found_merges AS (SELECT DISTINCT step, p FROM walk WHERE step > 0),
    string_bytes AS (SELECT label, word, pos, unnest(bs) AS byte, generate_subscripts(bs, 1) AS place FROM (
        SELECT label, ws[pos] AS word, pos,
               list_transform(regexp_extract_all(hex(encode(ws[pos])), '..'), lambda h: ('0x' || h)::INT) AS bs
        FROM (SELECT label, ws, unnest(range(1, len(ws) + 1)) AS pos FROM strings))),
    applied(step, label, pos, w) AS (
      SELECT 0, label, pos, string_agg(chr({BASE} + coalesce(id, 0)), '' ORDER BY place)
      FROM string_bytes LEFT JOIN alphabet USING (byte) GROUP BY label, pos
      UNION ALL
      SELECT a.step + 1, label, pos,
             replace(w, p, chr(CAST({BASE} + 4 + (SELECT count(*) FROM alphabet) + a.step + 1 AS INT)))
      FROM applied a JOIN found_merges m ON m.step = a.step + 1),
    string_ids AS (SELECT label, string_agg(w, '' ORDER BY pos) AS w FROM applied
                   WHERE step = (SELECT max(step) FROM applied) GROUP BY label)"""
# The visible form of every token: a merged one is its two parts joined.
_TOKENS = f"""made AS MATERIALIZED (SELECT DISTINCT step, p FROM walk WHERE step > 0),
    built(step, tokens) AS (
      SELECT 0, ['<unk>', '<s>', '</s>', '<pad>', '<mask>'] || (SELECT list(token ORDER BY id) FROM alphabet)
      UNION ALL
      SELECT b.step + 1, list_append(tokens, tokens[unicode(p[1]) - {BASE} + 1] || tokens[unicode(p[2]) - {BASE} + 1])
      FROM built b JOIN made m ON m.step = b.step + 1),
    vocabulary AS (SELECT CAST(unnest(range(len(tokens))) AS INT) AS id, unnest(tokens) AS token FROM built
                   WHERE step = (SELECT max(step) FROM built))"""


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_HEAD = "SELECT 0 AS id, '<unk>' AS token UNION ALL VALUES (1, '<s>'), (2, '</s>'), (3, '<pad>'), (4, '<mask>')"
_SYMBOLS = f"list_transform(string_split(w, ''), lambda s: unicode(s) - {BASE})"


def _validation(chosen: str) -> str:
    return f"""WITH RECURSIVE {_walk(VOCAB)}, {_FINAL},
    probes AS (SELECT unnest([{", ".join(map(_sql_text, vl.PROBES.values()))}]) AS t),
    lost AS (SELECT count(DISTINCT t) AS n FROM (
        SELECT t, unnest(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda h: ('0x' || h)::INT))
        AS byte FROM probes) ANTI JOIN alphabet USING (byte))
    SELECT CAST(5 + (SELECT count(*) FROM alphabet) + (SELECT max(step) FROM walk) AS INT) AS vocab_size,
           CAST((SELECT n FROM lost) AS INT) AS roundtrip_failures,
           round(sum(length(t)) / greatest(sum(length(w) + 2), 1), 3) AS compression_ratio,
           round(sum(length(w) + 2) / greatest(sum(len({sql_words("t")})), 1), 3) AS fertility,
           CAST(count(*) AS INT) AS docs_sampled
    FROM {chosen} JOIN coded USING (doc_id)"""


QUERIES = {
    "word_counts": (word_counts, f"WITH {WORDS} SELECT word, n FROM words"),
    "byte_alphabet": (
        byte_alphabet,
        f"WITH {WORDS}, {BYTES} SELECT byte, CAST(sum(n) AS BIGINT) AS n FROM bytes GROUP BY byte",
    ),
    "pair_counts": (
        pair_counts,
        f"""WITH {WORDS}, {BYTES} SELECT a.byte AS l, b.byte AS r, CAST(sum(a.n) AS BIGINT) AS n
            FROM bytes a JOIN bytes b ON a.word = b.word AND b.pos = a.pos + 1 GROUP BY ALL""",
    ),
    "bpe_vocab_head": (
        vocab_head,
        f"WITH {WORDS}, {BYTES}, {VISIBLE}, {ALPHABET} {_HEAD} UNION ALL SELECT id, token FROM alphabet",
    ),
    "bpe_train": (train, _merges(VOCAB)),
    # One merge at a time over all words is too slow in SQL at this size.
    "bpe_train_larger": (train_larger, None),
    "training_stats": (
        stats,
        f"""SELECT {VOCAB} AS vocab_size, {VOCAB} AS vocab_size_requested, 2 AS min_frequency,
                   '<unk> <s> </s> <pad> <mask>' AS special_tokens, 'run_001' AS run_id""",
    ),
    "vocabulary_saved": (saved, f"WITH RECURSIVE {_walk(VOCAB)}, {_TOKENS} SELECT id, token FROM vocabulary"),
    "probe_sentence": (
        probe_sentence,
        f"""WITH RECURSIVE {_walk(VOCAB)}, {_TOKENS},
            strings AS (SELECT 'probe' AS label, {_cut(_sql_text(vl.PROBE_SENTENCE))} AS ws), {_STRINGS},
            ids AS (SELECT [1] || {_SYMBOLS} || [2] AS ids FROM string_ids)
            SELECT CAST(i - 1 AS INT) AS place, CAST(ids[i] AS INT) AS id, token
            FROM (SELECT ids, unnest(range(1, len(ids) + 1)) AS i FROM ids) JOIN vocabulary ON id = ids[i]""",
    ),
    "special_tokens": (special_tokens, _HEAD),
    "encode_corpus": (
        encode,
        f"""WITH RECURSIVE {_walk(VOCAB)}, {_FINAL}
            SELECT doc_id, length(w) + 2 AS n_tokens,
                   md5('1,' || array_to_string({_SYMBOLS}, ',') || ',2') AS ids_md5 FROM coded""",
    ),
    "encode_pairs": (
        encode_pairs,
        f"""WITH RECURSIVE {_walk(VOCAB)}, {_FINAL},
            strings AS (SELECT DISTINCT lang AS label, {_cut("lang")} AS ws FROM documents), {_STRINGS},
            sides AS (SELECT doc_id, [1] || {_SYMBOLS.replace("(w,", "(coalesce(c.w, ''),")} || [2] AS a,
                             {_SYMBOLS.replace("(w,", "(s.w,")} || [2] AS b
                      FROM documents LEFT JOIN coded c USING (doc_id) JOIN string_ids s ON s.label = lang)
            SELECT doc_id, md5(array_to_string(a || b, ',')) AS ids_md5,
                   md5(array_to_string(list_transform(a, lambda x: 0) || list_transform(b, lambda x: 1), ','))
                   AS type_ids_md5 FROM sides""",
    ),
    "decode_roundtrip": (decoded, "SELECT doc_id, md5(text) AS text_md5 FROM documents"),
    "probe_roundtrip": (
        probes,
        "SELECT 'doc' || doc_id AS label, true AS ok FROM documents UNION ALL VALUES "
        + ", ".join(f"('{label}', true)" for label in vl.PROBES),
    ),
    "compression_fertility": (
        metrics,
        f"""WITH RECURSIVE {_walk(VOCAB)}, {_FINAL}
            SELECT count(*) AS docs, CAST(sum(length(t)) AS BIGINT) AS chars,
                   CAST(sum(len({sql_words("t")})) AS BIGINT) AS words, CAST(sum(length(w) + 2) AS BIGINT) AS tokens,
                   round(sum(length(t)) / greatest(sum(length(w) + 2), 1), 6) AS compression_ratio,
                   round(sum(length(w) + 2) / greatest(sum(len({sql_words("t")})), 1), 6) AS fertility
            FROM texts JOIN coded USING (doc_id)""",
    ),
    "fertility_by_lang": (
        metrics_by_lang,
        f"""WITH RECURSIVE {_walk(VOCAB)}, {_FINAL}
            SELECT lang, count(*) AS docs, CAST(sum(length(t)) AS BIGINT) AS chars,
                   CAST(sum(len({sql_words("t")})) AS BIGINT) AS words, CAST(sum(length(w) + 2) AS BIGINT) AS tokens,
                   round(sum(length(t)) / greatest(sum(length(w) + 2), 1), 6) AS compression_ratio,
                   round(sum(length(w) + 2) / greatest(sum(len({sql_words("t")})), 1), 6) AS fertility
            FROM texts JOIN coded USING (doc_id) JOIN documents USING (doc_id) GROUP BY lang""",
    ),
    # A probe comes back whole exactly if the alphabet has all of its bytes.
    "validation_results": (validation, _validation("texts")),
    "validation_first": (
        validation_first,
        _validation(f"(SELECT doc_id, t FROM texts ORDER BY doc_id LIMIT {FIRST_DOCS})"),
    ),
}
