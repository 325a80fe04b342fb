"""A Merkle manifest of a table: one hash stands for all rows, and a short proof
shows that a row belongs to it.

Every row is a leaf. The leaves of one group (a source) ascend by id; runs of
`ARITY` neighbours become one node, level by level, until one node is left, the
group's subroot. Subroots, in the order of their groups, become the root the
same way. H is SHA-256 in lower-case hex over its inputs one after the other,
digests as hex text.

Nodes are kept content-addressed, as records digest -> children, one table a
level. A leaf's request goes down from the root by the digits of its rank to
base `ARITY`: at every level the record of the digest at hand is looked up, the
digit selects the child to go on with, and the others are collected as a path
segment. Requests travel as one row as long as their digits agree, so a node is
looked up once however many leaves ask for it, and the root is no hot key. In
the end the segments are reversed: a proof reads from the leaf up.

How it holds at scale: ranks come from a range-partitioned sort and one offset
per task, so a group that holds a third of the rows is many tasks' work; a
level is one shuffle of digests, a sixteenth of the one below; a request's
shared segments are joined to runs of sixteen leaves, never to single ones.

Defined cases: a null field counts as `-` and differs from an empty one; null
groups come first and are one group; leaves of one id are ordered by digest
(null ids first), so equal rows are neighbours and their proofs are equal; a
group of one row has its leaf as subroot; an empty table has no root and no
rows; only the named columns are looked at, whatever others are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import written

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha256(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def coded(value: Column) -> Column:
    """A value so that it can not run into its neighbours: `-`, or size, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return sha256(*[coded(v) for v in values])


def ranked(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with `g`, their place (from 0) in the order of `keys`, nulls first.

    Tasks sort ranges of the keys; a task's offset is the number of rows in the
    tasks before it, one small row a task.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = written(placed.select("*", F.spark_partition_id().alias("_task"), inside.alias("_at")), name)
    sizes = placed.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    offset = (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_base")  # as many rows as tasks
    placed = placed.join(F.broadcast(sizes.select("_task", offset)), "_task")
    return placed.withColumn("g", F.col("_base") + F.col("_at")).drop("_base", "_at")


@dataclass(frozen=True)
class Tree:
    """levels[k]: (tree, idx, n, digest, children) of the nodes at height k + 1;
    `n` nodes stand at that height in the tree. tops: (tree, height, digest)."""

    levels: list[DataFrame]
    tops: DataFrame
    height: int


def grow(leaves: DataFrame, name: str) -> Tree:
    """(tree, idx, n, digest), idx from 0 to n - 1 in each tree, to its nodes."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels, height, below = [], 0, leaves
    tops = leaves.filter("n = 1").select("tree", F.lit(0).alias("height"), "digest")
    while most > 1:
        height += 1
        run = F.sort_array(F.collect_list(F.struct("idx", "digest")))
        nodes = below.filter("n > 1").groupBy("tree", F.floor(F.col("idx") / ARITY).alias("up"))
        nodes = nodes.agg(F.ceil(F.first("n") / ARITY).alias("n"), run.alias("run"))
        children = F.col("run.digest").alias("children")
        nodes = nodes.select("tree", F.col("up").alias("idx"), "n", children)
        nodes = nodes.select("tree", "idx", "n", F.sha2(F.array_join("children", ""), 256).alias("digest"), "children")
        below = written(nodes, f"{name}-{height}")
        levels.append(below)
        tops = tops.unionByName(below.filter("n = 1").select("tree", F.lit(height).alias("height"), "digest"))
        most = -(-most // ARITY)
    return Tree(levels, written(tops, f"{name}-tops"), height)


@dataclass(frozen=True)
class Manifest:
    """leaves: the given leaf rows with `tree` (place of the group), `idx`
    (place in it) and `n` (its leaves). upper: the one tree over the subroots."""

    leaves: DataFrame
    lower: Tree
    upper: Tree
    root: str | None


def build(leaves: DataFrame) -> Manifest:
    """leaves: (group, id, digest, ...), written, one row per leaf."""
    placed = ranked(leaves, ["group", "id", "digest"], "leaves")
    groups = placed.groupBy("group").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written(ranked(groups, ["group"], "groups").select("group", "first", "n", F.col("g").alias("tree")), "trees")
    # A group's rows of one task meet its place there, so no task gets a large group whole.
    parts = placed.select("_task", "group").distinct().withColumnRenamed("group", "_group")
    known = groups["group"].eqNullSafe(parts["_group"])
    parts = parts.join(groups, known).select(F.col("_task").alias("_t"), "_group", "first", "n", "tree")
    mine = (placed["_task"] == parts["_t"]) & placed["group"].eqNullSafe(parts["_group"])
    placed = placed.join(parts, mine).withColumn("idx", F.col("g") - F.col("first"))
    placed = written(placed.drop("_task", "g", "_t", "_group", "first"), "placed")
    lower = grow(placed.select("tree", "idx", "n", "digest"), "nodes")
    count = lower.tops.count()
    roots = lower.tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "digest")
    upper = grow(roots.withColumn("n", F.lit(count).cast("long")), "upper")
    top = upper.tops.first()
    return Manifest(placed, lower, upper, top["digest"] if top else None)


SEGMENTS = "array<struct<left:string,right:string>>"


def siblings(children: Column, at: Column) -> Column:
    """A path segment: the digests left and right of the selected child."""
    left = F.array_join(F.slice(children, F.lit(1), at), "")
    right = F.array_join(F.slice(children, at + 2, F.lit(ARITY)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def step(asked: DataFrame, records: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """Requests (idx, digest, path, ...) one level down: every child that a
    request selects, with its idx and the other children as one more segment."""
    records = records.select("digest", "children").dropDuplicates(["digest"])
    kept = [c for c in asked.columns if c not in ("idx", "digest", "path")]
    found = asked.join(records, "digest").select(*kept, "idx", "path", "children", F.posexplode("children").alias("at", "child"))
    segment = F.concat("path", F.array(siblings(F.col("children"), F.col("at"))))
    down = (F.col("idx") * ARITY + F.col("at")).alias("idx")
    found = found.select(*kept, down, F.col("child").alias("digest"), segment.cast(SEGMENTS).alias("path"))
    return found if wanted is None else found.join(wanted, [c for c in wanted.columns], "left_semi")


def prefixes(requests: DataFrame, digits: int) -> DataFrame:
    """The distinct (tree, idx) that are left of requests without their last digits."""
    return requests.select("tree", F.floor(F.col("idx") / ARITY**digits).alias("idx")).distinct()


def descend(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """(tree, run, subroot, path, digest, children): the runs of leaves that
    requests (tree, idx) end in, all of them by default.

    `path` holds the segments from the root to the run, `children` the run's
    leaves; a subroot that is a leaf itself has no children.
    """
    if manifest.root is None:
        return manifest.leaves.selectExpr(
            "tree", "idx as run", "digest as subroot", f"cast(null as {SEGMENTS}) as path", "digest", "array(digest) as children"
        ).filter("false")
    if requests is not None:
        requests = written(requests.select("tree", "idx").distinct(), "requests")
    spark = manifest.leaves.sparkSession
    asked = spark.range(1).select(
        F.lit(0).cast("long").alias("idx"), F.lit(manifest.root).alias("digest"), F.array().cast(SEGMENTS).alias("path")
    )
    asked = written(asked, "asked")
    for k in reversed(range(manifest.upper.height)):
        wanted = None
        if requests is not None:
            wanted = requests.select(F.floor(F.col("tree") / ARITY**k).alias("idx")).distinct()
        asked = written(step(asked, manifest.upper.levels[k], wanted), "asked")
    entries = asked.withColumnRenamed("idx", "tree").join(manifest.lower.tops.select("tree", "height"), "tree")
    entries = entries.select(
        "tree", F.lit(0).cast("long").alias("idx"), F.col("digest").alias("subroot"), "digest", "path", "height"
    )
    entries = written(entries, "entries")
    runs = entries.filter("height = 0").withColumn("children", F.lit(None).cast("array<string>"))
    now = None
    for k in reversed(range(manifest.lower.height)):
        start = entries.filter(F.col("height") == k + 1)
        now = start if now is None else now.unionByName(start)
        records = manifest.lower.levels[k]
        if k == 0:
            records = records.select("digest", "children").dropDuplicates(["digest"])
            runs = runs.unionByName(now.join(records, "digest").select(*runs.columns))
            break
        wanted = None if requests is None else prefixes(requests, k)
        now = written(step(now, records, wanted), "asked")
    return runs.select("tree", F.col("idx").alias("run"), "subroot", "path", "digest", "children")


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaf rows of `requests` (tree, idx; all by default) with `subroot`
    and `proof`: the segments (left, right) from the leaf up to the root."""
    leaves = manifest.leaves.withColumn("run", F.floor(F.col("idx") / ARITY))
    if requests is not None:
        leaves = leaves.join(requests.select("tree", "idx").distinct(), ["tree", "idx"], "left_semi")
    found = leaves.join(descend(manifest, requests).drop("digest"), ["tree", "run"])
    at = (F.col("idx") % ARITY).cast("int")
    last = F.when(F.col("children").isNotNull(), F.array(siblings(F.col("children"), at))).otherwise(F.array().cast(SEGMENTS))
    path = F.reverse(F.concat("path", last.cast(SEGMENTS)))
    return found.select("*", path.alias("proof")).drop("run", "children", "path")


def proof_digest(proof: Column) -> Column:
    """H of all siblings, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(digest: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to."""
    return F.aggregate(proof, digest, lambda acc, s: sha256(s["left"], acc, s["right"]))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text with A to Z in lower case where 5 divides the id's checksum."""
    picked = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0
    return F.when(picked, F.translate(text, UPPER, LOWER)).otherwise(text)


def audit(documents: DataFrame, tamper=tampered) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified per
    document: the manifest of `documents`, and whether each row, tampered with
    as `tamper` (id and text to a text) says, still folds to its root."""
    docs = documents.select(*[F.col(c) for c in FIELDS])
    changed = tamper(F.col("doc_id"), F.col("text"))
    altered = F.when(~changed.eqNullSafe(F.col("text")), leaf_digest([*map(F.col, FIELDS[:-1]), changed]))
    leaves = docs.select(
        F.col("source").alias("group"),
        F.col("doc_id").alias("id"),
        leaf_digest([F.col(c) for c in FIELDS]).alias("digest"),
        altered.alias("altered"),
    )
    manifest = build(written(leaves, "leaf-digests"))
    root = F.lit(manifest.root).cast("string")
    proved = prove(manifest).withColumn("folded_root", fold(F.coalesce("altered", "digest"), F.col("proof")))
    return proved.select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        root.alias("root"),
        proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        F.col("folded_root").eqNullSafe(root).alias("verified"),
    )
