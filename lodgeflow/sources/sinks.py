"""Table sinks and catalog helpers.

Tables are parquet directories (or catalog tables). The raw fact table is
partitioned by month and load: trailing windows are partition filters, and a load that is
repeated overwrites its own partitions. Beside it stands a narrow index of its keys by bucket,
so that a batch is compared with the keys that can be its own, not with the table.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.session import scratch_path

log = logging.getLogger(__name__)

#: The load that wrote a row: the second partition column of the raw table.
LOAD = "LOAD_ID"
#: Parts of a key index; a table keeps the number it began with.
KEY_BUCKETS = 16
#: Files that are moved at a time.
MOVERS = 8
#: Keys of a load up to which they are sent to all tasks, and its rows stay where they are.
FEW_KEYS = 250_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on any Hadoop file system (local, HDFS, object stores)."""
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def path_size(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (file or folder)."""
    p, fs = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def move_files(spark: SparkSession, files: Sequence[str], folder: str) -> list[str]:
    """Move loaded files below ``folder``, each under the name of its own folder. Nothing there is
    overwritten: where the name is taken, the time of the move is added to it. Returns the files that
    could not be moved, with a warning each; they stay where they are."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def move(file: str) -> bool:
        p, fs = _fs(spark, file)
        name, target = p.getName(), hadoop(folder, p.getParent().getName())
        try:
            fs.mkdirs(target)
            to, n = hadoop(target, name), 0
            while fs.exists(to):
                base, dot, ext = name.rpartition(".")
                at = datetime.now(UTC).strftime("%Y%m%dT%H%M%SZ") + (f"-{n}" if n else "")
                to, n = hadoop(target, f"{base}_{at}.{ext}" if dot else f"{name}_{at}"), n + 1
            if fs.rename(p, to):
                return True
        except Exception as e:  # the rows are loaded; the next load tries the move again
            log.warning("could not archive %s: %s", file, e)
            return False
        log.warning("could not archive %s", file)
        return False

    with ThreadPoolExecutor(MOVERS) as pool:
        return [f for f, done in zip(files, pool.map(move, files)) if not done]


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries directly under ``folder``."""
    p, fs = _fs(spark, folder)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def overwrite_table(df: DataFrame, path: str, check=None) -> None:
    """Full refresh of one table. The new rows are written beside the table and, once
    ``check(rows)`` has passed, take its place, so that a refresh that fails leaves the old table. Where
    a refresh ended between the two renames, the next one puts the old table back first."""
    spark = df.sparkSession
    path = path.rstrip("/")
    new, old = f"{path}__new-{uuid.uuid4().hex[:12]}", f"{path}__old"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p, fs = _fs(spark, path)
    if not fs.exists(p) and fs.exists(hadoop(old)):
        fs.rename(hadoop(old), p)
    try:
        df.write.parquet(new)
        if check:
            check(spark.read.schema(df.schema).parquet(new))
    except Exception:
        fs.delete(hadoop(new), True)
        raise
    if fs.exists(p):
        fs.delete(hadoop(old), True)
        fs.rename(p, hadoop(old))
    fs.mkdirs(p.getParent())
    if not fs.rename(hadoop(new), p):
        raise OSError(f"could not publish {path}")
    fs.delete(hadoop(old), True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], in_place: bool = False) -> None:
    """Write ``df`` in place of the partitions it has rows of; a repeated write changes nothing.

    Rows are first rebalanced on the partition columns: AQE then splits large partitions and merges
    small ones, so each month gets files of a sensible size at any scale (neither one task per month
    nor thousands of tiny files). Rows that lie by partition already are written ``in_place``."""
    laid = df if in_place else df.hint("rebalance", *partition_by)
    (laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def table_exists(spark: SparkSession, path_or_name: str) -> bool:
    """A catalog table or a readable parquet directory."""
    if "/" not in path_or_name:
        return spark.catalog.tableExists(path_or_name)
    p, fs = _fs(spark, path_or_name)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():         # up to the first data file
        name = it.next().getPath().getName()
        if name.endswith(".parquet") and not name.startswith(("_", ".")):
            return True
    return False


def _bucket(key: str) -> Column:
    return F.pmod(F.hash(key), F.lit(KEY_BUCKETS))


def keys_held(rows: DataFrame, index: str, keys: Sequence[str], load: str) -> DataFrame:
    """(keys, _held): what the index has in the parts and range of dates that the keys of ``rows`` are
    in, but for what ``load`` itself wrote. Of the rows one aggregated row comes to the driver."""
    lo, hi, parts = rows.agg(F.min(keys[-1]), F.max(keys[-1]), F.collect_set(_bucket(keys[0]))).first()
    kind = T.StructType([*(rows.schema[k] for k in keys), T.StructField("_row", T.LongType()),
                         T.StructField("_part", T.IntegerType()), T.StructField(LOAD, T.StringType())])
    spark = rows.sparkSession
    there = set(list_names(spark, index))
    paths = [f"{index}/{p}" for p in (f"_part={i}" for i in parts) if p in there]      # other parts aren't even listed
    if not paths:
        return spark.createDataFrame([], T.StructType([*kind.fields[:len(keys)], T.StructField("_held", T.LongType())]))
    near = (F.col(LOAD) != load) & F.col(keys[-1]).between(F.lit(lo), F.lit(hi))
    return spark.read.schema(kind).option("basePath", index).parquet(*paths).filter(near).groupBy(*keys).agg(F.first("_row").alias("_held"))


def lie_by(rows: DataFrame, column: str) -> bool:
    """Whether the tasks that read ``rows`` have few values of ``column`` each, so that a write by it makes
    no more than a few files for each value and task without moving rows. One aggregated row comes to the driver."""
    pairs = rows.select(F.col(column).alias("_v"), F.spark_partition_id().alias("_p")).distinct()
    n, values, tasks = pairs.agg(F.count(F.lit(1)), F.count_distinct("_v"), F.count_distinct("_p")).first()
    return n <= 4 * (values + tasks)


def rows_apart(spark: SparkSession, rows: DataFrame, odd: DataFrame, keys: Sequence[str], n_odd: int, n_apart: int) -> DataFrame:
    """``rows`` but for those of the ``n_odd`` keys of ``odd``, which are unique; a key with a null is none of them.

    The shorter list of keys goes to the tasks that have the rows: of those left out or, where ``n_apart``
    rows are fewer, of those left, which is made of keys alone. A delivery that is there already moves
    no row, however long it is; only where both lists are long do whole rows meet keys by a shuffle."""
    if n_odd > FEW_KEYS and not n_apart:
        return rows.filter(F.lit(False))
    if n_odd > FEW_KEYS >= n_apart:
        apart = materialize(spark, rows.select(*keys).join(odd.select(*keys), list(keys), "left_anti"), "load-apart")
        here = apart.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)))
        return rows.join(F.broadcast(here), [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left_semi")
    gone = odd.select(*keys)
    return rows.join(F.broadcast(gone) if n_odd <= FEW_KEYS else gone, list(keys), "left_anti")


def load_new_rows(spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str],
                  month_col: str = "MONTH_YEAR", quarantine: str | None = None, load: str | None = None,
                  staged: bool = False) -> DataFrame:
    """Append the rows whose primary key is not in the table yet.

    A month may come in any number of files and batches: what is there stays, what is missing is
    added. Of several rows with one key in ``df`` the first by all columns is kept. Rows that are kept
    out and differ from the row that holds their key go to ``quarantine`` (a table path), with a
    reason. Returns the rows this load added.

    ``load`` names the load. Table, index and quarantine are partitioned by it, so a load that failed
    anywhere and is repeated under its name takes the place of what it had written; under another
    name it adds only what is missing.

    ``df`` is written once and read several times, unless it is ``staged`` already, with a hash of each row
    in ``_row``. It meets ``<path>_index``: the keys and a hash of every row, in ``KEY_BUCKETS`` parts by
    the first key. Read are the parts that the batch's keys fall in, and in them the files whose range
    of the last key (the date) meets the batch's, as every load writes files of its own dates. The
    batch's wide rows are shuffled only where a key is twice or held by a row that differs, where the
    tasks that read them have many months each, as files that hold parts of many months give, or where
    both the new rows and the other keys are more than ``FEW_KEYS`` (``rows_apart``).
    """
    columns, index = [c for c in df.columns if c != "_row"], f"{path}_index"
    load = load or f"l{uuid.uuid4().hex[:12]}"
    row = F.struct(*columns)
    rows = df if staged else materialize(spark, df.withColumn("_row", F.xxhash64(*columns)), "load")
    own = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_least"), F.max("_row").alias("_most"))
    held = keys_held(rows, index, keys, load) if table_exists(spark, index) else None
    known = own.join(held, list(keys), "left") if held is not None else own.withColumn("_held", F.lit(None).cast("long"))
    # keys with more to them than one new row; most loads have none
    odd = materialize(spark, known.filter((F.col("_n") > 1) | F.col("_held").isNotNull()).select(
        *keys, "_n", "_held", (F.col("_held").eqNullSafe(F.col("_least")) & F.col("_held").eqNullSafe(F.col("_most"))).alias("_same")), "load-keys")
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    n_odd, n_care, n_taken = odd.agg(F.count(F.lit(1)), F.count_if(whole & ~F.col("_same")), F.sum(F.when(whole, F.col("_n")))).first()
    # rows whose key is new and theirs alone, or has a null; counted where the keys alone don't tell that rows stay
    n_apart = rows.count() - (n_taken or 0) if n_odd > FEW_KEYS else None
    few_care, few_apart = n_care <= FEW_KEYS, n_apart is None or n_apart <= FEW_KEYS
    in_place = few_care and few_apart and n_apart != 0 and lie_by(rows, month_col)
    new, care = rows_apart(spark, rows, odd, keys, n_odd, n_apart) if n_odd else rows, None
    if n_care:
        differ = odd.filter(~F.col("_same")).drop("_same", "_n")
        care = rows.join(F.broadcast(differ) if few_care else differ, list(keys))
        # the first by all columns, which tell its hash too; written, as the table, the index and the quarantine read it
        first = materialize(spark, care.groupBy(*keys).agg(F.min(F.struct(*columns, "_row")).alias("_first"), F.first("_held").alias("_held"))
                            .select("_first", "_held"), "load-first")
        kept = first.filter(F.col("_held").isNull()).select("_first.*")
        new = new.select(*columns, "_row").unionByName(kept.hint("rebalance", month_col) if in_place else kept)
    overwrite_partitions(new.select(*columns, F.lit(load).alias(LOAD)), path, [month_col, LOAD], in_place)
    overwrite_partitions(new.select(*keys, "_row", _bucket(keys[0]).alias("_part"), F.lit(load).alias(LOAD)), index, ["_part", LOAD])
    if quarantine and care is not None:
        one = F.struct(*(F.col(f"_first.{c}").alias(c) for c in columns))
        firsts = first.select(*(F.col(f"_first.{k}").alias(f"_k{i}") for i, k in enumerate(keys)), one.alias("_first"))
        # row by row: a held key is one difference, a row that differs from the first of its key another
        twice = (care.join(firsts, [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)])
                 .filter(~row.eqNullSafe(F.col("_first"))).select(*columns, F.lit("key twice").alias("_reason")))
        in_table = first.filter(F.col("_held").isNotNull()).select("_first.*", "_held").filter(
            F.col("_row") != F.col("_held")).select(*columns, F.lit("key in table").alias("_reason"))
        overwrite_partitions(twice.unionByName(in_table).withColumn(LOAD, F.lit(load)), quarantine, [LOAD])
    return new.select(*columns)


def ensure_tables(spark: SparkSession, specs: dict[str, T.StructType], base: str) -> list[str]:
    """Create empty parquet tables for the given schemas when absent."""
    made = []
    for name, schema in specs.items():
        path = f"{base.rstrip('/')}/{name}"
        if not table_exists(spark, path):
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
            made.append(path)
    return made


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy model as a temporary view and return the view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_named(df: DataFrame, name: str, partition_by=None, columns=None) -> DataFrame:
    """Write a model as a named catalog table (full refresh), refresh its
    statistics (A12), those of ``columns`` too, and return it. Sessions that share the catalog read it by name."""
    w = df.write.mode("overwrite").format("parquet")
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    analyze(df.sparkSession, name, columns)
    return df.sparkSession.table(name)


def analyze(spark: SparkSession, table: str, columns=None) -> None:
    """Refresh catalog statistics of a catalog table: rows and bytes or, for ``columns``, also their
    range, nulls, distinct values and equi-height histogram. Scans the table; numbers come back, no rows."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if not columns:
        return
    setting = "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in columns)}")
    finally:
        spark.conf.set(setting, before)


def plan_by_statistics(spark: SparkSession, on: bool = True) -> None:
    """Let this session estimate rows from catalog statistics and order inner joins by them."""
    for setting in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled", "spark.sql.cbo.planStats.enabled"):
        spark.conf.set(setting, str(on).lower())


def month_key(c) -> F.Column:
    """``MM_YYYY`` text of a date column."""
    return F.date_format(c, "MM_yyyy")


def materialize(spark: SparkSession, df: DataFrame, name: str,
                partition_by=None) -> DataFrame:
    """Write a model as a parquet table in the shared checkpoint folder
    and read it back.

    This cuts the lineage (a lost executor recomputes from the table, not
    from the sources), lets later plans prune columns and push filters into
    the scan, and gives the optimizer file statistics for join planning.
    """
    path = scratch_path(spark, name)
    if partition_by:
        (df.hint("rebalance", *partition_by).write.mode("overwrite")
         .partitionBy(*partition_by).parquet(path))
    else:
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select(*df.columns)
