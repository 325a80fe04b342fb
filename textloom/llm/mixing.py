"""Mixing sources to target weights: a token budget sent down a tree of groups.

The tree is domain, language, source (or any other columns). Every node's share
of its parent goes by weight. A child that can not use its share, because its
leaves hold too few tokens even when repeated `epochs` times, leaves the rest
to its siblings; only what a whole family can not use reaches the parents'
siblings. Then each leaf takes a prefix of its own token stream: its documents
in a seeded order, epoch after epoch in orders of their own, the last document
cut where the budget ends.

All of it is DataFrame work. Shares are integers (a node's children get
differences of rounded running shares, so they always sum up). A leaf's stream
is never sorted in one task: documents fall into buckets by the seeded order,
bucket totals place each bucket in the stream, and only rows of one bucket are
ranked together.

Defined cases: null group values are a group of their own; a null or empty text
has no tokens and is never taken; rows that repeat an id are rows of their own,
in the order of their token counts, then of their texts' MD5; ties can not matter beyond equal rows; an empty
table or budget 0 gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import written

LEVELS = ("domain", "lang", "source")
BUCKET_ROWS = 512
NONE = "(none)"


def pieces(text: Column) -> Column:
    """The text split at each single blank; empty where blanks meet."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "), " ", -1)


def token_count(text: Column) -> Column:
    return F.size(F.array_remove(pieces(text), "")).cast("long")


def token_prefix(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th token."""

    def cut(parts: Column) -> Column:
        full = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.get(parts, i) != "")
        last = F.get(full, (n - 1).cast("int"))
        return F.substring(text, F.lit(1), F.length(F.array_join(F.slice(parts, F.lit(1), last + 1), " ")))

    return F.transform(F.array(pieces(text)), cut)[0]


def weight_of(values: Mapping[str, int], name: Column) -> Column:
    """A group's integer weight; groups that are not named weigh `*`, or 1."""
    out = F.lit(int(values.get("*", 1))).cast("long")
    for key, weight in values.items():
        if key != "*":
            out = F.when(name == key, F.lit(int(weight)).cast("long")).otherwise(out)
    return out


def share_out(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Nodes with `budget`, `cap` and `weight`: add `got`: each node's part of its family's `budget`, by `weight`, at
    most its `cap`.

    Filled in the order of cap per weight, a child is full exactly if its cap
    is at most its part of what fuller ones left; the others share the rest.
    """
    order = F.col("cap") / F.col("weight")
    family = Window.partitionBy(*parents).orderBy(order, name)
    before = family.rowsBetween(Window.unboundedPreceding, -1)
    after = family.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    ranked = nodes.select(
        "*",
        F.coalesce(F.sum("cap").over(before), zero).alias("_left"),
        F.sum("weight").over(after).alias("_weights"),
    )
    full = F.col("cap") * F.col("_weights") <= (F.col("budget") - F.col("_left")) * F.col("weight")
    marked = ranked.withColumn("_full", full)
    all_of = Window.partitionBy(*parents)
    rest = marked.select(
        "*",
        (F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(all_of), zero)).alias("_rest"),
        F.sum(F.when(~F.col("_full"), F.col("weight"))).over(all_of).alias("_open"),
        F.sum(F.when(~F.col("_full"), F.col("weight"))).over(family).alias("_run"),
    )
    until = F.expr("_rest * _run div _open")
    since = F.expr("_rest * (_run - weight) div _open")
    got = F.when(F.col("_full"), F.col("cap")).otherwise(until - since)
    return rest.withColumn("got", got).drop("_left", "_weights", "_full", "_rest", "_open", "_run")


def leaf_budgets(
    leaves: DataFrame, budget: int, epochs: int, weights: Sequence[Mapping[str, int]], levels: Sequence[str]
) -> DataFrame:
    """(levels..., tokens, docs, got) per leaf, from (levels..., tokens, docs)."""
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    above, parents = None, []
    for depth, level in enumerate(levels):
        keys = [*parents, level]
        nodes = leaves.groupBy(*keys).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("budget", F.lit(budget).cast("long")) if above is None else nodes.join(above, parents)
        nodes = nodes.withColumn("weight", weight_of(weights[depth], F.col(level)))
        above = share_out(nodes, parents, level).select(*keys, F.col("got").alias("budget"))
        parents = keys
    return leaves.join(above, parents).drop("cap").withColumnRenamed("budget", "got")


def mix(
    documents: DataFrame,
    share: tuple[int, int] = (1, 2),
    epochs: int = 4,
    weights: Sequence[Mapping[str, int]] = ({}, {}, {}),
    levels: Sequence[str] = LEVELS,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`documents` with `epoch` (from 0), `n_tokens`, `take_tokens`, `stream_start`
    (tokens of its leaf's stream before it) and `mixed_text` for every taken
    row (columns of these names are replaced); a document comes once per epoch
    that takes it.

    The budget is share[0] / share[1] of all tokens. weights: per level, integer
    weights by group name.
    """
    names = {c: f"_g{i}" for i, c in enumerate(levels)}
    groups = list(names.values())
    added = ("epoch", "n_tokens", "take_tokens", "stream_start", "mixed_text")
    counted = documents.select(F.struct("*").alias("doc"), token_count(F.col(text_col)).alias("n_tokens"))
    rows = counted.filter("n_tokens > 0").withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "counted")
    stats = rows.select(
        "_row",
        "n_tokens",
        *[F.coalesce(F.col(f"doc.`{c}`").cast("string"), F.lit(NONE)).alias(g) for c, g in names.items()],
        F.coalesce(F.col(f"doc.`{id_col}`").cast("string"), F.lit(NONE)).alias("_id"),
        F.unhex(F.md5(F.encode(F.col(f"doc.`{text_col}`").cast("string"), "UTF-8"))).alias("_text"),
    )
    leaves = stats.groupBy(*groups).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    leaves = written(leaves, "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    budget = min(total * share[0] // share[1], total * epochs)
    plan = leaf_budgets(leaves, budget, epochs, weights, groups).filter("got > 0")

    # Every leaf takes `whole` epochs in full and a prefix of one more.
    plan = plan.withColumn("whole", F.expr("cast(got div tokens as int)"))
    plan = plan.withColumn("last", F.expr("got - whole * tokens"))
    plan = written(plan.withColumn("buckets", F.ceil(F.col("docs") / BUCKET_ROWS).cast("long")), "budgets")
    placed = stats.join(plan, groups)
    turns = F.sequence(F.lit(0), F.col("whole") - F.when(F.col("last") == 0, 1).otherwise(0))
    placed = placed.withColumn("epoch", F.explode(turns))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), F.col("_id")))
    placed = placed.withColumn("_key", key)
    first = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    placed = placed.withColumn("_bucket", F.shiftright(first * F.col("buckets"), 32))

    bucket = [*groups, "epoch", "_bucket"]
    sums = placed.groupBy(*bucket).agg(F.sum("n_tokens").alias("_sum"))
    running = Window.partitionBy(*groups, "epoch").orderBy("_bucket")
    sums = sums.select(*bucket, (F.sum("_sum").over(running) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy(*bucket).orderBy("_key", "n_tokens", "_text", "_row").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.join(sums, bucket)
    start = F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    limit = F.when(F.col("epoch") < F.col("whole"), F.col("tokens")).otherwise(F.col("last"))
    taken = (
        placed.withColumn("_start", start)
        .filter(F.col("_start") < limit)
        .select(
            "_row",
            "epoch",
            "n_tokens",
            F.least(F.col("n_tokens"), limit - F.col("_start")).alias("take_tokens"),
            (F.col("_start") + F.col("epoch") * F.col("tokens")).alias("stream_start"),
        )
    )
    text = F.col(f"doc.`{text_col}`")
    cut = F.when(F.col("take_tokens") < F.col("n_tokens"), token_prefix(text, F.col("take_tokens")))
    out = rows.drop("n_tokens").join(taken, "_row").withColumn("mixed_text", cut.otherwise(text))
    own = [F.col(f"doc.`{c}`").alias(c) for c in documents.columns if c not in added]
    return out.select(*own, *added)
