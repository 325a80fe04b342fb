"""Shards: directories of gzip JSON-lines files, one document per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = "id string, text string, source string, meta map<string,string>"
TAGGED = f"{DOCUMENT}, lang string, lang_confidence double, domain string"


def write_shards(df: DataFrame, path: str, shard_size: int = 10_000) -> None:
    """At most shard_size documents a file; every task writes its own files."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", shard_size).json(path)


def write_numbered_shards(df: DataFrame, path: str) -> None:
    """Exact shards from a `shard` column, in the order of `position`: shard k
    is the directory shard=k."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartition(parts, "shard").sortWithinPartitions("shard", "position")
    ordered.drop("position").write.mode("overwrite").partitionBy("shard").option("compression", "gzip").json(path)


def read_shards(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    """Declared schema: no pass over the data to find it. Gzip files can not be
    split, so a shard is a task."""
    return spark.read.schema(schema).json(path)


def list_shards(spark: SparkSession, path: str, schema: str = DOCUMENT, counts: bool = False) -> DataFrame:
    """Shards by file name; `docs` of each only with counts=True, which has to
    read the shards, while the names come from the file listing."""
    if not counts:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json.gz").load(path)
        return files.select(F.col("path").alias("shard"), "length").orderBy("shard")
    named = read_shards(spark, path, schema).select(F.col("_metadata.file_path").alias("shard"))
    return named.groupBy("shard").agg(F.count(F.lit(1)).alias("docs")).orderBy("shard")
