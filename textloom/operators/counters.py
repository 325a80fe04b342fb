"""Stage counters: how many documents came in and how many went on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def stage_counters(df: DataFrame, went_on: Column, stage: str) -> DataFrame:
    """One row (stage, docs_in, docs_out, percent) from a single aggregate."""
    counts = df.agg(F.count(F.lit(1)).alias("docs_in"), F.count_if(went_on).alias("docs_out"))
    return counts.select(
        F.lit(stage).alias("stage"),
        "docs_in",
        "docs_out",
        (100 * F.col("docs_out") / F.greatest("docs_in", F.lit(1))).alias("percent"),
    )


class Counters:
    """Documents per stage, counted while a stage is computed for its own sake:
    no job of theirs. Stages are reported in the order they were named."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation | int] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        """df, its rows being counted by the first job that computes it whole."""
        seen = self._seen[stage] = Observation()
        return df.observe(seen, F.count(F.lit(1)).alias("docs"))

    def known(self, stage: str, docs: int) -> None:
        self._seen[stage] = docs

    def docs(self, stage: str) -> int:
        """Waits for that job."""
        seen = self._seen[stage]
        return seen if isinstance(seen, int) else seen.get["docs"]

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, docs_in, docs_out, percent) of all stages after the first."""
        names = list(self._seen)
        steps = [(b, self.docs(a), self.docs(b)) for a, b in zip(names, names[1:])]
        rows = [(stage, n_in, n_out, 100 * n_out / max(n_in, 1)) for stage, n_in, n_out in steps]
        return spark.createDataFrame(rows, "stage string, docs_in long, docs_out long, percent double")
