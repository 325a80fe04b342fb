"""Pairs inside groups without listing them.

Rows that share a key are compared inside tasks. A key that many rows share is
dealt into blocks of about `BLOCK` rows, and each two blocks are one unit of
work, so no unit grows with its key. Units give back counts and the edges of a
spanning forest, at most one fewer than their rows, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import group_starts
from textloom.operators.components import components  # noqa: F401  used through this module

BLOCK = 2_048
UNIT = ("_key", "_a", "_b")


def by_shuffle(df: DataFrame) -> DataFrame:
    """df to be joined by a shuffle of both sides. Spark guesses the size of rows
    that a Python step makes from those that go in, and that of a written table
    from its compressed files: either may be far too low for a broadcast."""
    return df.hint("merge")


def sharing(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key at least two rows have, with the key's count as `_n`."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return rows.join(by_shuffle(counts), key)


def units(rows: DataFrame, key: str, row_id: str, n: str = "_n", block: int = BLOCK) -> DataFrame:
    """Rows once per unit of work, sorted by unit, then side, then id.

    `_side` tells the blocks of a unit apart; a block paired with itself has
    only side 0.
    """
    blocks = F.ceil(F.col(n) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.col(row_id), F.lit(7)), F.col("_blocks")).cast("int")
    dealt = rows.withColumn("_blocks", blocks).withColumn("_own", own)
    spread = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return (
        spread.withColumn("_key", F.col(key))
        .withColumn("_a", F.least("_own", "_other"))
        .withColumn("_b", F.greatest("_own", "_other"))
        .withColumn("_side", (F.col("_own") != F.col("_a")).cast("int"))
        .drop("_blocks", "_own", "_other", n)
        .repartition(*UNIT)
        .sortWithinPartitions(*UNIT, "_side", row_id)
    )


def pairs(table: pa.Table, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers (i, j) of all pairs within the units of a sorted table, at
    most about `most` at a time: across sides, or i < j where there is one."""
    starts = group_starts(table, list(UNIT))
    n = table.num_rows
    ends = np.append(starts[1:], n)
    unit = np.repeat(np.arange(len(starts)), ends - starts)
    side = table.column("_side").to_numpy()
    self_unit = (table.column("_a").to_numpy() == table.column("_b").to_numpy())[starts]
    ones = np.add.reduceat(side, starts) if n else side
    second = ends - ones
    row = np.arange(n)
    begin = np.where(self_unit[unit], row + 1, second[unit])
    count = np.where(self_unit[unit] | (side == 0), ends[unit] - begin, 0)
    total = np.cumsum(count)
    at = 0
    while at < n:
        done = total[at - 1] if at else 0
        to = max(int(np.searchsorted(total, done + most, "right")), at + 1)
        c = count[at:to]
        i = np.repeat(row[at:to], c)
        if len(i):
            yield i, begin[i] + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        at = to


def forest(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node that an edge moves below another one; the root
    is the smallest node of its component."""
    root = np.arange(n)
    while len(i):
        a, b = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        live = a != b
        i, j, a, b = i[live], j[live], a[live], b[live]
        if not len(i):
            break
        np.minimum.at(root, b, a)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]
