"""DuckDB SQL that the registered queries are checked against, where SQL can say it."""

from __future__ import annotations

from textloom.llm.settings import MIX_WEIGHTS

WORD = r"[^\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
_VALUE = "('0x' || x[5 * i + 1:5 * i + 5])::INT"
_QUAD = " || ".join(f"{LETTERS}[(({_VALUE} >> {s}) & 31) + 1]" for s in (15, 10, 5, 0))

WARC = f"""
    WITH found AS (SELECT page_id, strlen(h) AS n, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS best
                   FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(8), lambda i: {_QUAD}), '') AS payload_digest,
           CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> best THEN best END AS refers_to
    FROM found"""

#: (i, j) links to (i, component): the smallest id that links lead to.
_REACH = """reach(i, j) AS (SELECT i, j FROM links UNION SELECT r.i, l.j FROM reach r JOIN links l ON r.j = l.i),
    classes AS (SELECT i, least(i, min(j)) AS component FROM reach GROUP BY i)"""

COSINE = f"""
    WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT a.vec_id AS i, b.vec_id AS j FROM v a, v b
              WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9), {_REACH}
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id,
           coalesce(component, vec_id) = vec_id AS kept
    FROM embeddings LEFT JOIN classes ON i = vec_id
    LEFT JOIN (SELECT i, count(*) AS n FROM links GROUP BY i) s ON s.i = vec_id"""

SHINGLES = f"""
    WITH RECURSIVE texts AS (SELECT text, min(doc_id) AS k, count(*) AS n FROM documents GROUP BY text),
    words AS (SELECT k, regexp_extract_all(text, '{WORD}') AS ws FROM texts),
    grams AS (SELECT DISTINCT k, unnest(list_transform(range(1, greatest(len(ws) - 4, 1) + 1),
                                                       lambda i: array_to_string(ws[i:i + 4], ' '))) AS s
              FROM words WHERE len(ws) > 0),
    sizes AS (SELECT k, count(*) AS size FROM grams GROUP BY k),
    pairs AS (SELECT a.k AS i, b.k AS j, count(*) AS common FROM grams a JOIN grams b ON a.s = b.s AND a.k <> b.k
              GROUP BY ALL),
    links AS (SELECT i, j FROM pairs JOIN sizes a ON a.k = i JOIN sizes b ON b.k = j
              WHERE common >= 0.8::DOUBLE * (a.size + b.size - common) - 1e-9), {_REACH},
    counted AS (SELECT t.k, CASE WHEN s.k IS NULL THEN 0 ELSE t.n - 1 + coalesce(m, 0) END AS n_links,
                       s.k IS NULL AS wordless, coalesce(component, t.k) AS class_id
                FROM texts t LEFT JOIN sizes s ON s.k = t.k LEFT JOIN classes ON i = t.k
                LEFT JOIN (SELECT l.i, sum(n) AS m FROM links l JOIN texts ON k = l.j GROUP BY l.i) q ON q.i = t.k)
    SELECT doc_id, CAST(n_links AS BIGINT) AS n_links, CASE WHEN wordless THEN doc_id ELSE class_id END AS class_id,
           wordless OR doc_id = class_id AS kept
    FROM documents d JOIN texts t ON t.text IS NOT DISTINCT FROM d.text JOIN counted c ON c.k = t.k"""


def _weight(values: dict[str, int], name: str) -> str:
    arms = "".join(f" WHEN '{k}' THEN {w}" for k, w in values.items() if k != "*")
    return f"CASE {name}{arms} ELSE {values.get('*', 1)} END" if arms else str(values.get("*", 1))


def _level(depth: int, names: tuple[str, ...], weights, epochs: int, above: str) -> str:
    """CTEs that end in `level{depth}`: every node's part of its family's budget."""
    level, parents = names[depth], list(names[:depth])
    keys = ", ".join([*parents, level])
    part = f"PARTITION BY {', '.join(parents)}" if parents else ""
    order = f"{part} ORDER BY cap / weight, {level}"
    budget = f"(SELECT b FROM {above})" if not parents else "budget"
    source = "leaves" if not parents else f"leaves JOIN {above} USING ({', '.join(parents)})"
    group = keys if not parents else f"{keys}, budget"
    return f"""
    nodes{depth} AS (SELECT {keys}, sum(tokens) * {epochs} AS cap, {budget} AS budget,
                            {_weight(weights[depth], level)} AS weight FROM {source} GROUP BY {group}),
    marked{depth} AS (SELECT *, cap * heavier <= (budget - fuller) * weight AS whole FROM (
        SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fuller,
               sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavier
        FROM nodes{depth})),
    shared{depth} AS (SELECT *, budget - coalesce(sum(cap) FILTER (whole) OVER ({part}), 0) AS rest,
                             sum(weight) FILTER (NOT whole) OVER ({part}) AS open,
                             sum(weight) FILTER (NOT whole) OVER ({order}) AS run FROM marked{depth}),
    level{depth} AS (SELECT {keys}, CASE WHEN whole THEN cap ELSE rest * run // open - rest * (run - weight) // open END
                            AS budget FROM shared{depth})"""


def mix_sql(weights=MIX_WEIGHTS, share: tuple[int, int] = (1, 2), epochs: int = 4, seed: int = 42) -> str:
    names = ("domain", "lang", "source")
    blanks = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    levels = ",".join(_level(d, names, weights, epochs, f"level{d - 1}" if d else "total") for d in range(3))
    return f"""
    WITH stats AS (SELECT doc_id, text, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
               'family' || (coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT), 0) % 4) AS domain,
               len(regexp_extract_all(text, '[^ \\t\\n\\v\\f\\r]+')) AS n FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n) AS tokens FROM stats WHERE n > 0 GROUP BY ALL),
    total AS (SELECT least(sum(tokens) * {share[0]} // {share[1]}, sum(tokens) * {epochs}) AS b FROM leaves), {levels},
    plan AS (SELECT domain, lang, source, tokens, budget // tokens AS whole, budget % tokens AS last
             FROM leaves JOIN level2 USING (domain, lang, source) WHERE budget > 0),
    streams AS (
        SELECT s.*, tokens, epoch, CASE WHEN epoch < whole THEN tokens WHEN epoch = whole THEN last ELSE 0 END AS upto,
               coalesce(sum(n) OVER (PARTITION BY domain, lang, source, epoch
                   ORDER BY md5('{seed}:' || epoch || ':' || doc_id), n
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM stats s JOIN plan USING (domain, lang, source), range({epochs}) e(epoch) WHERE n > 0),
    taken AS (SELECT *, least(n, upto - start) AS take,
                     string_split(translate(text, {blanks}, '     '), ' ') AS cut FROM streams WHERE start < upto)
    SELECT doc_id, domain, lang, source, CAST(epoch AS INT) AS epoch, CAST(n AS BIGINT) AS n_tokens,
           CAST(take AS BIGINT) AS take_tokens, CAST(start + epoch * tokens AS BIGINT) AS stream_start,
           md5(CASE WHEN take = n THEN text ELSE text[1:length(array_to_string(cut[1:list_filter(
               range(1, len(cut) + 1), lambda i: cut[i] <> '')[CAST(take AS INT)]], ' '))] END) AS text_md5
    FROM taken"""


_CODED = "coalesce(strlen({0}) || ':' || {0}, '-')"
_CHECKSUM = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ord(x))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def _grown(name: str, height: int) -> str:
    """CTEs name1 ... name{height}: runs of 16 nodes become one; a lone node stays."""
    return "".join(f""",
    {name}{k + 1} AS (SELECT tree, idx // 16 AS idx, (n + 15) // 16 AS n, n AS below, list(digest ORDER BY idx) AS children,
        CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY idx)) END AS digest
        FROM {name}{k} GROUP BY tree, idx // 16, n)""" for k in range(height))


def _folded(name: str, height: int, source: str, given: str) -> str:
    """CTEs given1 ... given{height}: one path segment more each."""
    out, above = "", source
    for k in range(1, height + 1):
        out += f""",
    {given}{k} AS (SELECT d.* EXCLUDE (idx, cur, sib), d.idx // 16 AS idx,
        CASE WHEN below = 1 THEN cur ELSE sha256(array_to_string(children[1:d.idx % 16], '') || cur
            || array_to_string(children[d.idx % 16 + 2:], '')) END AS cur,
        sib || CASE WHEN below = 1 THEN '' ELSE array_to_string(children[1:d.idx % 16], '')
            || array_to_string(children[d.idx % 16 + 2:], '') END AS sib
        FROM {above} d JOIN {name}{k} g ON g.tree = d.tree AND g.idx = d.idx // 16)"""
        above = f"{given}{k}"
    return out


def merkle_sql(lower: int = 5, upper: int = 4) -> str:
    """For at most 16 ** lower rows a source and 16 ** upper sources."""
    fields = [_CODED.format(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = lambda text: f"sha256({' || '.join([*fields, _CODED.format(text)])})"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH hashed AS (SELECT *, {leaf('text')} AS leaf, {leaf(low)} AS lowered, {_CHECKSUM} % 5 = 0 AS picked FROM documents),
    leaves AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                      count(*) OVER (PARTITION BY source) AS n,
                      row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM hashed),
    lower0 AS (SELECT tree, idx, n, leaf AS digest FROM leaves){_grown('lower', lower)},
    upper0 AS (SELECT 0 AS tree, tree AS idx, count(*) OVER () AS n, digest FROM lower{lower}){_grown('upper', upper)},
    asked AS (SELECT doc_id, leaf, tree, idx, CASE WHEN picked THEN lowered ELSE leaf END AS cur, '' AS sib FROM leaves)
    {_folded('lower', lower, 'asked', 'a')},
    entered AS (SELECT a.* EXCLUDE (tree, idx), 0 AS tree, a.tree AS idx, g.digest AS subroot
                FROM a{lower} a JOIN lower{lower} g ON g.tree = a.tree){_folded('upper', upper, 'entered', 'b')}
    SELECT doc_id, leaf, subroot, g.digest AS root, sha256(sib) AS proof_sha256, cur AS folded_root, cur = g.digest AS verified
    FROM b{upper} b JOIN upper{upper} g ON g.tree = b.tree"""


_SPACE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"

RULES = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
                 list_filter(string_split(text, chr(10)), lambda x: translate(x, {_SPACE}, '') <> '') AS ls FROM d),
    grams AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, unnest(list_transform(range(1, len(ws) - 6),
                  lambda i: array_to_string(ws[i:i + 7], ' '))) AS g FROM w WHERE len(ws) >= 8),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
    reached AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY r),
    m AS (SELECT doc_id, len(ws) AS n_words, length(translate(text, {_SPACE}, '')) AS word_chars,
                 length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
                 len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
                 length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) AS n_upper,
                 len(list_filter(ls, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis,
                 len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•][\\x20\\x09-\\x0D]'))) AS n_bullets,
                 len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_echoes
          FROM w LEFT JOIN reached USING (r)),
    f AS (SELECT *, (n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
        + 8 * (2 * word_chars < 5 * n_words)::INT + 16 * (word_chars > 12 * n_words)::INT
        + 32 * (100 * n_dup_lines > 30 * n_lines)::INT + 64 * (100 * n_upper > 15 * word_chars)::INT
        + 128 * (100 * n_ellipsis > 30 * n_lines)::INT + 256 * (100 * n_bullets > 90 * n_lines)::INT
        + 512 * (100 * n_echoes > 20 * n_words)::INT AS failed FROM m)
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
           CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
           CAST(n_repeat_words AS BIGINT) AS n_repeat_words, CAST(failed AS BIGINT) AS failed,
           failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKING = f"""
    WITH d AS (SELECT r, doc_id, unnest(ts) AS t, len(ts)::BIGINT AS n
               FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents)),
    q AS (SELECT item, item_id, unnest(ts) AS t
          FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS ts FROM benchmark)),
    tf AS (SELECT r, doc_id, t, n, count(*) AS tf FROM d GROUP BY ALL),
    total AS (SELECT count(DISTINCT r) AS nd, count(*) AS l FROM d),
    df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
    weights AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
    times AS (SELECT item, item_id, t, count(*) AS times FROM q GROUP BY ALL),
    scored AS (SELECT item, item_id, r, doc_id, CAST(sum(times * w * ((1000000000 * tf)
                   // (1000 * tf + 8 * (25 + (75 * n * nd) // l)))) AS BIGINT) AS score
               FROM times JOIN tf USING (t) JOIN weights USING (t), total GROUP BY ALL),
    placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, r) AS INT) AS rank
               FROM scored WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10"""
