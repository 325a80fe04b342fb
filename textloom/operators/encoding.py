"""Encoding recovery: every repair in its fixed order, no document dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import repair as rp

STEPS = (
    rp.REFERENCES,
    rp.MOJIBAKE,
    rp.MOJIBAKE,  # text may have been damaged twice
    rp.LIGATED,
    rp.WIDTH,
    rp.QUOTED,
    rp.BROKEN,
    rp.CONTROLS,
    rp.APART,
)


def recover_encoding(df: DataFrame, column: str = "text", flag: str | None = None) -> DataFrame:
    """Replace `column` by its repaired form; `flag` names an optional boolean
    column that says whether anything changed. Narrow: no shuffle.

    All repairs are one step over Arrow batches, and only the texts that change
    come back from it.
    """
    t = F.col(column)
    work = df.withColumn("_repair", rp.changes(t, *STEPS))
    if flag:
        work = work.withColumn(flag, F.col("_repair").isNotNull())
    return work.withColumn(column, F.coalesce("_repair", t)).drop("_repair")
