"""Quality rules as a ledger of bits: every rule looks at a document once.

`ledger` takes the measurements of a text and turns each rule into one bit,
set where the rule fails. Policies are named versions: which rules count, and
how many of them a document may fail. `apply` and `ablations` read only
measurements and bits, never texts: changing a policy costs no second look, and
the effect of leaving a rule out is a bitwise aggregation over the distinct
failure masks, of which there are at most 2 ** rules whatever the rows.

All of it is built-in functions over one row, without a shuffle before the
aggregates. The repeat rule counts the words that lie in windows of
`WINDOW` words found twice or more in the text: windows are hashed, and only a
text with equal hashes has its windows sorted and compared as they are. The
memory of a row goes with its own text, about a hundred bytes a word.

Words are runs without ASCII blanks; lines are parted by line feeds. Defined
cases: a null or empty text has no words, so all measurements are 0 and it
fails `few_words`; echoes are words equal to the one before; a text of fewer words than a window has no repeats; lines
without a word are not compared; rows that repeat an id are judged apart;
an empty table gives no rows, and an empty report; other columns are kept,
whatever their names, as measurements travel in two structs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"  # fixed value

#: Every measurement, in the order of the ledger's struct.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_ellipsis_lines",
    "n_bullet_lines",
    "n_echoes",
)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def size_of(chars: Column) -> Column:
    return F.length(chars).cast("long")


def words_of(text: Column) -> Column:
    flat = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(flat, " ", -1), "")


def repeat_words(words: Column) -> Column:
    """Words that lie in windows of WINDOW words that stand twice or more."""

    def doubled(hashes: Column) -> Column:
        return F.size(F.array_distinct(hashes)) < F.size(hashes)

    def window_hashes(w: Column) -> Column:
        """Hashes of 2, 4 and 8 words in a row, each from two of the one before."""
        pair = lambda a, b: F.xxhash64(a, b)
        one = F.transform(w, lambda x: F.xxhash64(x))
        two = bind(one, lambda h: F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h)), pair))
        four = bind(two, lambda h: F.zip_with(F.slice(h, 1, F.size(h) - 2), F.slice(h, 3, F.size(h)), pair))
        return bind(four, lambda h: F.zip_with(F.slice(h, 1, F.size(h) - 4), F.slice(h, 5, F.size(h)), pair))

    def covered(w: Column, hashes: Column) -> Column:
        """Windows whose hash stands twice, as they are, sorted: equal neighbours repeat."""
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = bind(
            placed,
            lambda p: F.filter(
                p,
                lambda x, j: x["h"].eqNullSafe(F.get(p, j - 1)["h"]) | x["h"].eqNullSafe(F.get(p, j + 1)["h"]),
            ),
        )
        text = F.transform(same, lambda x: F.struct(F.array_join(F.slice(w, x["i"] + 1, WINDOW), " ").alias("t"), x["i"].alias("i")))

        def repeated(p: Column) -> Column:
            equal = F.filter(
                p,
                lambda x, j: x["t"].eqNullSafe(F.get(p, j - 1)["t"]) | x["t"].eqNullSafe(F.get(p, j + 1)["t"]),
            )
            return F.sort_array(F.transform(equal, lambda x: x["i"]))

        starts = bind(F.sort_array(text), repeated)
        # A window adds the words beyond the one before it, at most all of its own.
        new = lambda s: F.transform(
            s, lambda x, j: F.least(F.lit(WINDOW), x - F.coalesce(F.get(s, j - 1), x - WINDOW))
        )
        return F.aggregate(bind(starts, new), F.lit(0).cast("long"), lambda a, x: a + x)

    def count(w: Column) -> Column:
        hashes = window_hashes(w)
        return bind(hashes, lambda h: F.when(doubled(h), covered(w, h)).otherwise(F.lit(0).cast("long")))

    return bind(words, lambda w: F.when(F.size(w) > WINDOW, count(w)).otherwise(F.lit(0).cast("long")))


def measures(text: Column) -> Column:
    """A struct of MEASURES, all long. `text` has to be a plain column."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    visible = size_of(F.translate(text, BLANKS, ""))
    words = words_of(text)

    def of_lines(lines: Column) -> list[Column]:
        count = lambda test: F.size(F.filter(lines, test)).cast("long")
        return [
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            count(lambda x: x.endswith("...") | x.endswith("…")).alias("n_ellipsis_lines"),
            count(lambda x: F.ltrim(x).rlike(r"^[-*•]\s")).alias("n_bullet_lines"),
        ]

    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, BLANKS, "") != "")
    by_line = bind(lines, lambda x: F.struct(*of_lines(x)))
    by_word = bind(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x, i: x.eqNullSafe(F.get(w, i - 1)))).cast("long").alias("n_echoes"),
        ),
    )
    parts = {
        "word_chars": visible,
        "n_symbols": size_of(text) - size_of(F.translate(text, SYMBOLS, "")),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    }
    pair = F.struct(by_word.alias("w"), by_line.alias("l"))

    def joined(p: Column) -> Column:
        of = {c: p["w"][c] for c in ("n_words", "n_repeat_words", "n_echoes")}
        of |= {c: p["l"][c] for c in ("n_dup_lines", "n_lines", "n_ellipsis_lines", "n_bullet_lines")}
        return F.struct(*[(of | parts)[c].alias(c) for c in MEASURES])

    return bind(pair, joined)


@dataclass(frozen=True)
class Rule:
    """`fails`: a condition on the measurements, given as a struct column."""

    name: str
    fails: Callable[[Column], Column]


#: One bit each, in this order; new rules go to the end, so that old ledgers keep their meaning.
RULES = (
    Rule("few_words", lambda m: m["n_words"] < 20),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("short_words", lambda m: 2 * m["word_chars"] < 5 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 12 * m["n_words"]),
    Rule("duplicate_lines", lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"]),
    Rule("upper_case", lambda m: 100 * m["n_upper"] > 15 * m["word_chars"]),
    Rule("ellipsis_lines", lambda m: 100 * m["n_ellipsis_lines"] > 30 * m["n_lines"]),
    Rule("bullet_lines", lambda m: 100 * m["n_bullet_lines"] > 90 * m["n_lines"]),
    Rule("echoes", lambda m: 100 * m["n_echoes"] > 20 * m["n_words"]),
)


@dataclass(frozen=True)
class Policy:
    """Documents that fail more than `most` of the named rules go."""

    rules: tuple[str, ...]
    most: int = 0

    def mask(self) -> int:
        names = [r.name for r in RULES]
        return sum(1 << names.index(r) for r in self.rules)


POLICIES: Mapping[str, Policy] = {
    "base": Policy(("few_words", "repeated_words")),
    "1": Policy(tuple(r.name for r in RULES)),
    "1-lenient": Policy(tuple(r.name for r in RULES), most=1),
}


def ledger(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """`documents` with `_measures` (a struct of MEASURES) and `_failed`, a bit
    per rule in the order of RULES."""
    measured = documents.select("*", measures(F.col(text_col)).alias("_measures"))
    m = F.col("_measures")
    bits = [F.when(rule.fails(m), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, rule in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.select("*", failed.alias("_failed"))


def keeps(policy: Policy, failed: Column) -> Column:
    """Whether documents with these failure bits stay."""
    return F.bit_count(failed.bitwiseAND(policy.mask())) <= policy.most


def ablations(rows: DataFrame, policies: Mapping[str, Policy] = POLICIES) -> DataFrame:
    """(policy, rule, failed, kept, kept_without, without_fails): per policy and
    rule of it, how many documents fail the rule, how many the policy keeps,
    how many it would keep without the rule, and how many without it still go.

    `rows` is a ledger; its rows are counted by mask, and the rest is bit
    arithmetic on those counts.
    """
    masks = rows.groupBy("_failed").agg(F.count(F.lit(1)).alias("n"))
    names = [r.name for r in RULES]
    cases = [
        F.struct(
            F.lit(version).alias("policy"),
            F.lit(rule).alias("rule"),
            F.lit(1 << names.index(rule)).cast("long").alias("bit"),
            F.lit(policy.mask()).cast("long").alias("mask"),
            F.lit(policy.most).alias("most"),
        )
        for version, policy in policies.items()
        for rule in policy.rules
    ]
    spread = masks.select("_failed", "n", F.explode(F.array(*cases)).alias("c")).select("_failed", "n", "c.*")
    fits = lambda mask: F.bit_count(F.col("_failed").bitwiseAND(mask)) <= F.col("most")
    without = F.col("mask").bitwiseAND(F.bitwise_not("bit"))
    total = lambda test: F.sum(F.when(test, F.col("n")).otherwise(F.lit(0).cast("long")))
    return spread.groupBy("policy", "rule").agg(
        total(F.col("_failed").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        total(fits(F.col("mask"))).alias("kept"),
        total(fits(without)).alias("kept_without"),
        total(~fits(without)).alias("without_fails"),
    )


def judge(documents: DataFrame, version: str = "1", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, the measurements of the base rules, failed (the bits), base_failed
    and kept, under the named version of the policies."""
    rows = ledger(documents.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text")
    base = ~keeps(POLICIES["base"], F.col("_failed"))
    return rows.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_measures.{c}").alias(c) for c in MEASURES[:5]],
        F.col("_failed").alias("failed"),
        base.alias("base_failed"),
        (~base & keeps(POLICIES[version], F.col("_failed"))).alias("kept"),
    )
