"""Saved stages: a folder per stage, with a manifest that says what it holds.

A stage's key is a digest of its input's key, its name and the settings it
looks at, so that a changed setting makes that stage and all later ones new,
and leaves the earlier ones alone. The manifest is written after the data and
goes with them when they are overwritten: a stage that was cut off has none.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.config import Settings
from textloom.operators.counters import Counters
from textloom.session import materialize

MANIFEST = "_manifest.json"


def digest(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def content_key(df: DataFrame) -> str:
    """A digest of a table's schema and rows, whatever their order: one pass."""
    row = F.xxhash64(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    sums = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s")).first()
    return digest(df.schema.jsonValue(), sums["n"], str(sums["s"]))


class Folder:
    """Files of one stage, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        root = self._hadoop.Path(path)
        self._fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        self._root, self._manifest = root, self._hadoop.Path(f"{path}/{MANIFEST}")

    def extent(self) -> list[int]:
        """Files and bytes, the manifest left out."""
        all_ = self._fs.getContentSummary(self._root)
        files, size = all_.getFileCount(), all_.getLength()
        if self._fs.exists(self._manifest):
            files, size = files - 1, size - self._fs.getFileStatus(self._manifest).getLen()
        return [files, size]

    def sign(self, manifest: dict) -> None:
        out = self._fs.create(self._manifest, True)
        try:
            out.write(bytearray(json.dumps(manifest | {"extent": self.extent()}, indent=1).encode()))
        finally:
            out.close()

    def manifest(self, key: str) -> dict | None:
        """The manifest, if the folder holds the whole of what `key` names."""
        if not self._fs.exists(self._manifest):
            return None
        stream = self._fs.open(self._manifest)
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except json.JSONDecodeError:  # cut off while it was written
            return None
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "ChecksumException":
                raise
            return None
        finally:
            stream.close()
        return found if found.get("key") == key and found.get("extent") == self.extent() else None


class Stages:
    """Stages one after the other: each is taken from its folder if that is
    valid, else computed and, with a folder to save to, written there. Documents
    are counted only for `counters` or for manifests."""

    def __init__(
        self,
        docs: DataFrame,
        s: Settings,
        save_dir: str | None = None,
        input_key: str = "",
        counters: Counters | None = None,
    ) -> None:
        self.spark, self.s, self.save_dir, self.key = docs.sparkSession, s, save_dir, input_key
        self.counters = counters or (Counters() if save_dir else None)
        self.last = "input"
        self.docs = self.counters.watch(docs, "input") if self.counters else docs

    def step(
        self, stage: str, uses: tuple[str, ...], make: Callable[[], DataFrame], cut: bool = False, more: str = ""
    ) -> DataFrame:
        """`uses`: the settings it looks at; `more`: keys of what else it reads;
        `cut`: its output is read more than once, so it is written in any case."""
        settings = {name: asdict(self.s)[name] for name in uses}
        self.key = digest(self.key, stage, settings, more)
        before, self.last = self.last, stage
        if self.save_dir is None:
            made = self.counters.watch(make(), stage) if self.counters else make()
            return materialize(made, stage) if cut else made
        folder = Folder(self.spark, f"{self.save_dir}/{stage}")
        found = folder.manifest(self.key)
        if found is None:
            made = self.counters.watch(make(), stage)
            made.write.mode("overwrite").parquet(folder.path)
            docs = {"docs_in": self.counters.docs(before), "docs_out": self.counters.docs(stage)}
            found = {"stage": stage, "key": self.key, "settings": settings, **docs, "schema": made.schema.json()}
            folder.sign(found)
        self.counters.known(before, found["docs_in"])
        self.counters.known(stage, found["docs_out"])
        return self.spark.read.schema(StructType.fromJson(json.loads(found["schema"]))).parquet(folder.path)
