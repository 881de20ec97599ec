"""The manifest of loaded files (A9, A11): what has been read, known by content, not by name.

A file is known by its path, size and time of change, so a corrected file under an old name is a new
one. The manifest is an ordinary table of one row per file and load, and one row per finished load.
Which files are new is an anti join with it; only those come to the driver. A load is written down
before it begins: one that failed is found there without its end, and is repeated under its name with
its own files, whose rows then take the place of what it had written.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lodgeflow.sources.sinks import table_exists

SCHEMA = "load string, path string, size long, modified timestamp_ntz"
FILE = ["path", "size", "modified"]


def listing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, size, modified) of all files at or below ``paths``; their content is not read."""
    if not paths:
        return spark.createDataFrame([], "path string, size long, modified timestamp_ntz")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return found.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"))


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """One row per file and load, and one without a file per load that ended."""
        if not table_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def fresh(self, files: DataFrame) -> DataFrame:
        """Those of ``files`` that no load has taken."""
        return files.join(self.rows().filter(F.col("path").isNotNull()).select(*FILE), FILE, "left_anti").select(*FILE)

    def unfinished(self, files: DataFrame) -> DataFrame:
        """(load, path) of the loads without an end, for those of their files that are still there."""
        open_loads = self.rows().groupBy("load").agg(F.count_if(F.col("path").isNull()).alias("ends")).filter("ends = 0").select("load")
        return self.rows().join(open_loads, "load").join(files, FILE).select("load", "path")

    def begin(self, load: str, files: Sequence[Row]) -> list[str]:
        """Write down that ``load`` takes ``files`` (path, size, modified); their paths."""
        self._append(self.spark.createDataFrame([(load, *f) for f in files], SCHEMA))
        return [unquote(f["path"]) for f in files]

    def end(self, load: str) -> None:
        self._append(self.spark.createDataFrame([(load, None, None, None)], SCHEMA))

    def _append(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(self.path)


def paths_of(files: DataFrame) -> list[str]:
    return sorted(unquote(r["path"]) for r in files.select("path").collect())
