"""Corpus source: files to documents (id, text, source, meta)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import text as tx
from textloom.operators.ordering import first_n
from textloom.session import materialize

# Supported formats, and the columns a text may sit in.
FORMATS = ("parquet", "json", "text", "orc", "csv")
TEXT_COLUMNS = ("text", "content", "passage")
SCALARS = (T.StringType, T.BooleanType, T.NumericType)


def read_raw(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options: str
) -> DataFrame:
    """The files as they are, plus `ord`: file name and row number in the file,
    the same however a file is split. CSV files have a header unless
    header="false" is given."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported source format: {fmt}")
    reader = spark.read.format(fmt).options(**({"header": "true"} | options if fmt == "csv" else options))
    if schema:
        reader = reader.schema(schema)
    df = reader.load(path)
    if fmt == "text":
        df = df.withColumnRenamed("value", "text")
    file = F.col("_metadata.file_path").alias("file")
    if fmt == "parquet":
        return df.withColumn("ord", F.struct(file, F.col("_metadata.row_index").alias("place")))
    return _numbered(df.withColumn("_file", file).withColumn("_block", F.col("_metadata.file_block_start")))


def _numbered(df: DataFrame) -> DataFrame:
    """Number the rows of each file: rows of the blocks before, plus the place in
    the block. Written once, so that numbers stay with their rows; what is
    joined is a row per block."""
    rows = materialize(df.withColumn("_seen", F.monotonically_increasing_id()), "raw")
    blocks = rows.groupBy("_file", "_block").agg(F.min("_seen").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_block")) - F.col("_n")
    blocks = blocks.select("_file", "_block", "_first", before.alias("_before"))
    place = F.col("_seen") - F.col("_first") + F.col("_before")
    ord_ = F.struct(F.col("_file").alias("file"), place.alias("place"))
    joined = rows.join(blocks, ["_file", "_block"]).withColumn("ord", ord_)
    return joined.drop("_file", "_block", "_seen", "_first", "_before")


def choose_text(df: DataFrame) -> Column:
    """The first text column that is not empty; blanks alone are not empty."""
    present = [F.nullif(F.col(c), F.lit("")) for c in TEXT_COLUMNS if c in df.columns]
    if not present:
        raise ValueError(f"no text column: one of {', '.join(TEXT_COLUMNS)} is needed, found {', '.join(df.columns)}")
    return F.coalesce(*present, F.lit(""))


def document_id(source: Column, order: Column) -> Column:
    """A repeatable id from where the document comes from: no two documents
    share a place, exact copies included, and no shuffle is needed to see to it."""
    return F.sha2(F.concat_ws(":", source, order.cast("string")), 256)


def meta_of(df: DataFrame) -> Column:
    """All scalar columns but the text as a map of strings; nulls left out."""
    names = [f.name for f in df.schema.fields if f.name != "text" and isinstance(f.dataType, SCALARS)]
    if not names:
        return F.create_map().cast("map<string,string>")
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def ingest(df: DataFrame, source: str | Column, order: str = "ord", max_docs: int = 0) -> DataFrame:
    """Rows to documents, blank ones dropped, capped at max_docs (0: no cap)."""
    tag = F.lit(source) if isinstance(source, str) else source
    docs = df.select(
        F.col(order),
        choose_text(df).alias("_text"),
        tag.alias("source"),
        meta_of(df).alias("meta"),
    ).filter(~tx.is_blank(F.col("_text")))
    return first_n(docs, order, max_docs).select(
        order, document_id(F.col("source"), F.col(order)).alias("id"), F.col("_text").alias("text"), "source", "meta"
    )


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out to all cores when the files give fewer splits than there
    are cores (single small files, gzip). Big inputs pass unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
