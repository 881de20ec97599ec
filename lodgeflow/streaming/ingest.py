"""Incremental month-file ingest (L1) and snapshot apply per micro-batch (L2).

The reference's loader is an incremental file ingester: each new month file
is cleaned, appended once, and archived. Here that is a file-stream source
with a checkpoint (each file is taken exactly once) whose rows are the paths of
new files; each micro-batch reads its files by their own headers and appends the
rows whose key is new, so a month may come in many batches. A batch is a load of its own
name, which a replay after a lost executor or driver overwrites, its quarantine included.
``trigger(availableNow=True)`` processes what is there and stops, as one run of the
reference's job does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodgeflow.operators.history import VALID_FROM, VALID_TO, scd2_step
from lodgeflow.sources.csv_ingest import (
    blank_as_null,
    clean_fact_text,
    read_aligned,
    split_valid,
)
from lodgeflow.sources.schemas import FACT_KEYS, LISTING_SCHEMA
from lodgeflow.sources.sinks import LOAD, list_names, load_new_rows, overwrite_partitions


# The columns of Spark's binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def month_file_stream(spark: SparkSession, src_dir: str, archive_dir: str | None = None,
                      max_files: int | None = None, glob: str = "*.csv") -> DataFrame:
    """L1 source: the paths of listing files under ``src_dir`` as a stream (column ``path``).

    Only names travel: the binary file source reads no content when just the
    path is asked for. With ``archive_dir`` processed files are moved there by
    the source (``cleanSource=archive``); the move happens when a later batch
    is planned, and ``pathGlobFilter`` keeps other files out.
    """
    reader = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", glob)
              .option("recursiveFileLookup", "true"))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(src_dir).select("path")


def read_batch(batch: DataFrame) -> DataFrame:
    """The rows of a micro-batch's files (A1, A4, A10); ``max_files`` bounds the paths."""
    files = sorted(r["path"] for r in batch.select("path").collect())
    return read_aligned(batch.sparkSession, files, LISTING_SCHEMA)


def stream_months(spark: SparkSession, src_dir: str, checkpoint: str, sink: str,
                  archive_dir: str | None = None, max_files: int | None = None,
                  quarantine: str | None = None) -> StreamingQuery:
    """L1: clean each micro-batch and append the rows whose key is not yet in ``sink``.

    Rows with a blank natural key go to ``quarantine`` when given (K21), rows
    whose key another row holds to ``<quarantine>_keys``.
    """
    stream = month_file_stream(spark, src_dir, archive_dir, max_files)

    own_id: list[str] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if not own_id:
            # the stream's own id, which a lost checkpoint loses too: its batches are never taken for others
            own_id.append(session.read.json(f"{checkpoint}/metadata").first()["id"])
        name = f"s{own_id[0]}-{batch_id}"
        cleaned = clean_fact_text(read_batch(batch))
        # Only month files are facts: rows without a MM_YYYY month are not loaded.
        valid, bad = split_valid(cleaned.withColumn(
            "MONTH_YEAR", F.when(F.col("MONTH_YEAR").rlike(r"^\d{2}_\d{4}\z"),
                                 F.col("MONTH_YEAR")).otherwise(F.lit(""))),
            [*FACT_KEYS, "MONTH_YEAR"])
        load_new_rows(session, blank_as_null(valid), sink, FACT_KEYS,
                      quarantine=f"{quarantine}_keys" if quarantine else None, load=name)
        if quarantine:
            overwrite_partitions(bad.withColumn(LOAD, F.lit(name)), quarantine, [LOAD])

    return (stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


class SnapshotTable:
    """A snapshot of which one apply reads and writes the newest version of each key only.

    Two ordinary tables, partitioned by the number of the apply (``batch``). ``closed`` has the
    versions that an apply closed; it is written once and never read by an apply. ``state`` has, after
    each apply, the open version of every key and, for keys that have none (hard deletes), their last
    closed one: no more is needed to tell a row that is new from one that a closed version covers. So
    an apply's work is one row per key and the batch, whatever the length of the history.

    ``state`` is written last, as one partition, which Spark publishes as a whole: it is the apply's
    commit. Closed versions of an apply without its state are not read, and the repeated apply
    overwrites them. Old states stay as they are.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        done = [int(n.partition("=")[2]) for n in list_names(spark, f"{self.base}/state") if n.startswith("batch=")]
        self.version = max(done, default=-1)

    def state(self) -> DataFrame | None:
        """The newest version of every key after the last apply."""
        return self.spark.read.parquet(f"{self.base}/state/batch={self.version}") if self.version >= 0 else None

    def open_versions(self) -> DataFrame | None:
        state = self.state()
        return state.filter(F.col(VALID_TO).isNull()) if state is not None else None

    def closed_versions(self) -> DataFrame | None:
        """Closed history of the applies that ended."""
        path = f"{self.base}/closed"
        if self.version < 0 or not any(n.startswith("batch=") for n in list_names(self.spark, path)):
            return None
        return self.spark.read.parquet(path).filter(F.col("batch") <= self.version).drop("batch")

    def current(self) -> DataFrame | None:
        closed, open_v = self.closed_versions(), self.open_versions()
        return open_v if closed is None else closed.unionByName(open_v)

    def changes(self, apply: int, key: str) -> tuple[DataFrame, DataFrame | None]:
        """What an apply did: the versions it began, and those it closed that were open before (None at
        the first). Read are its own rows and the state before it."""
        step = self.spark.read.parquet(f"{self.base}/step/batch={apply}")
        if not apply:
            return step, None
        before = (self.spark.read.parquet(f"{self.base}/state/batch={apply - 1}").filter(F.col(VALID_TO).isNull())
                  .select(F.col(key).alias("_bk"), F.col(VALID_FROM).alias("_bf")))
        same = (F.col(key) == F.col("_bk")) & (F.col(VALID_FROM) == F.col("_bf"))
        return step.join(before, same, "left_anti"), step.filter(F.col(VALID_TO).isNotNull()).join(before, same, "left_semi")

    def apply(self, batch: DataFrame, key: str, updated_at: str, check_cols=None,
              close_missing: bool = False) -> None:
        """One apply (``scd2_step``); a batch that was applied before changes nothing."""
        state, nxt = self.state(), self.version + 1
        gone = state.filter(F.col(VALID_TO).isNotNull()) if state is not None else None
        step = scd2_step(self.open_versions(), batch, key, updated_at, check_cols, close_missing, closed=gone)
        step = self._written("step", step, nxt)
        overwrite_partitions(step.filter(F.col(VALID_TO).isNotNull()).withColumn("batch", F.lit(nxt)), f"{self.base}/closed", ["batch"])
        # of each key its open version, or its last closed one
        newest = F.struct(F.col(VALID_TO).isNull().alias("is_open"), VALID_TO, VALID_FROM)
        last = step.groupBy(F.col(key).alias("_k")).agg(F.max(newest).alias("_newest"))
        after = (step.join(last, (F.col(key) == F.col("_k")) & newest.eqNullSafe(F.col("_newest"))).select(*step.columns))
        if gone is not None:
            after = after.unionByName(gone.join(last, F.col(key) == F.col("_k"), "left_anti"))
        overwrite_partitions(after.withColumn("batch", F.lit(nxt)), f"{self.base}/state", ["batch"])
        if f"batch={nxt}" in list_names(self.spark, f"{self.base}/state"):     # not after empty batches alone
            self.version = nxt

    def _written(self, name: str, rows: DataFrame, nxt: int) -> DataFrame:
        path = f"{self.base}/{name}/batch={nxt}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)


def stream_snapshot(spark: SparkSession, stream: DataFrame, table: SnapshotTable,
                    to_rows, key: str, updated_at: str, checkpoint: str,
                    check_cols=None, close_missing: bool = False) -> StreamingQuery:
    """L2: apply each micro-batch to a snapshot table (J4, ``SnapshotTable.apply``).

    ``to_rows`` maps the batch's raw rows to snapshot source rows (one per key and
    ``updated_at``). Batches are applied in arrival order; rows older than a
    key's newest version are ignored, as a snapshot run would.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply(to_rows(read_batch(batch)), key, updated_at, check_cols, close_missing)

    return (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
