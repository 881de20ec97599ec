"""The end-to-end jobs on real inputs: CSV files -> bronze -> silver/star -> marts.

* ``load_dimensions`` (N1): the four reference files, full refresh per table.
* ``load_facts`` (N2): month files that the manifest doesn't have, aligned by header, cleaned,
  key-guarded, appended once per key, checked and archived; ``register_tables`` makes the raw
  tables catalog tables and refreshes their statistics, in the load where it is asked to.
* ``Warehouse``: the model frames (silver, snapshots, star, marts) over the
  bronze tables, with the same interface the analyses use on the driver data.
"""

from __future__ import annotations

import logging
import re
import uuid
from functools import cached_property
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodgeflow.operators.quality import check_schema, check_tables_exist, sample_values
from lodgeflow.plans import models as M
from lodgeflow.plans.context import Domain
from lodgeflow.sources.csv_ingest import (
    IngestError,
    align_columns,
    assert_width,
    blank_as_null,
    clean_fact_text,
    list_month_files,
    keys_present,
    read_aligned,
    read_raw_csv,
    take_first,
)
from lodgeflow.sources.manifest import Manifest, listing, paths_of
from lodgeflow.sources.schemas import (
    DIM_SPECS,
    FACT_FILE_PATTERN,
    FACT_KEYS,
    FACT_TABLE,
    LISTING_SCHEMA,
)
from lodgeflow.sources.sinks import (
    LOAD,
    analyze,
    list_names,
    load_new_rows,
    materialize,
    move_files,
    overwrite_partitions,
    overwrite_table,
    path_exists,
    save_named,
    table_exists,
)

log = logging.getLogger(__name__)


def load_dimensions(spark: SparkSession, dim_dir: str, bronze_base: str) -> dict[str, int]:
    """Load each dimension file present; a missing one is skipped with a warning.

    Every table is refreshed as a whole or, where its file fails, left as it was. Returns rows loaded
    per bronze table.
    """
    loaded = {}
    for fname, (table, schema, first_n) in DIM_SPECS.items():
        path = f"{dim_dir.rstrip('/')}/{fname}"
        if not path_exists(spark, path):     # a file, or a folder of CSV parts
            log.warning("dimension file missing: %s", path)
            continue
        raw = read_raw_csv(spark, path)
        if first_n:
            raw = take_first(raw, [f.name for f in schema.fields][:first_n])
        df = assert_width(raw, len(schema.fields), fname)
        df = blank_as_null(align_columns(df.toDF(*[f.name for f in schema.fields]), schema))
        counts = Observation(table)
        overwrite_table(df.observe(counts, F.count(F.lit(1)).alias("rows")),
                        f"{bronze_base}/{table}", check=lambda rows: assert_width(rows, len(schema.fields), fname))
        loaded[table] = int(counts.get["rows"])
    if not loaded:
        log.warning("no dimension files in %s", dim_dir)
    return loaded


class LoadReport(dict):
    """``files``, ``loaded`` and ``quarantined`` rows of a load; ``samples`` has some dates and prices
    of the table (V6), ``not_archived`` the files that could not be moved."""

    samples: dict[str, list]
    not_archived: list[str]


def load_facts(spark: SparkSession, facts_dir: str, bronze_base: str,
               pattern: str = FACT_FILE_PATTERN, archive_dir: str | None = None,
               multi_line: bool = False, register: bool = False) -> LoadReport:
    """Every month file not loaded yet, in one parallel scan per header.

    Inputs are files named ``MM_YYYY.csv`` or folders ``MONTH_YEAR=MM_YYYY``
    (``pattern`` decides which names are accepted). Files that the manifest ``<table>_manifest`` has
    are not read again (A9); a file that changed is another file. The rest is aligned by its own
    headers, cleaned and key-guarded. Rows without a key (B18) go to ``<table>_quarantine``, rows
    whose key another row holds (V3) to ``<table>_quarantine_keys``; new keys are appended. A load that
    failed is repeated first, under its own name, and takes the place of what it had written.
    With ``archive_dir`` all loaded files are then moved there (A11), and with ``register`` the raw
    table's catalog statistics are refreshed (A12).
    """
    table = f"{bronze_base}/{FACT_TABLE}"
    folder = facts_dir.rstrip("/")
    found = listing(spark, [f"{folder}/{n}" for n in list_month_files(list_names(spark, facts_dir), pattern)])
    manifest = Manifest(spark, f"{table}_manifest")
    report = LoadReport(files=0, loaded=0, quarantined=0)
    report.samples, report.not_archived = {}, []
    loads = start_loads(spark, manifest, found, table, multi_line)
    for name, (files, rows, refused) in loads.items():
        manifest.end(name)
        report["files"] += files
        report["loaded"] += rows
        report["quarantined"] += refused
    if loads:
        report.samples = check_load(spark, bronze_base)
        if register:
            register_tables(spark, bronze_base, [FACT_TABLE])
    if archive_dir:
        report.not_archived = move_files(spark, paths_of(found), archive_dir)
    return report


def start_loads(spark: SparkSession, manifest: Manifest, found: DataFrame, table: str,
                multi_line: bool = False) -> dict[str, tuple[int, int, int]]:
    """All of a load but its end: loads without one again, then one of the files that none has taken.
    By name: files, rows added, rows without a key."""
    todo: dict[str, list[str]] = {}
    for r in manifest.unfinished(found).collect():
        todo.setdefault(r["load"], []).append(unquote(r["path"]))
    fresh = manifest.fresh(found).collect()     # the reader takes paths
    if fresh:
        name = f"l{uuid.uuid4().hex[:12]}"
        todo[name] = manifest.begin(name, fresh)
    return {name: (len(files), *_load(spark, sorted(files), table, name, multi_line)) for name, files in todo.items()}


def _load(spark: SparkSession, files: list[str], table: str, load: str, multi_line: bool) -> tuple[int, int]:
    """One load: rows added, and rows without a key."""
    text = clean_fact_text(read_aligned(spark, files, LISTING_SCHEMA, multi_line))
    counts = Observation(load)
    hashed = F.xxhash64(*(F.nullif(F.col(c), F.lit("")) for c in text.columns))     # of the row as it is loaded
    keyed = text.select("*", hashed.alias("_row"), keys_present(FACT_KEYS).alias("_ok")).observe(
        counts, F.count_if(~F.col("_ok")).alias("refused"))
    staged = materialize(spark, keyed, "facts")
    refused = int(counts.get["refused"])
    if refused:
        overwrite_partitions(staged.filter(~F.col("_ok")).drop("_ok", "_row").withColumn(LOAD, F.lit(load)), f"{table}_quarantine", [LOAD])
    load_new_rows(spark, blank_as_null(staged.filter("_ok").drop("_ok")), table, FACT_KEYS,
                  quarantine=f"{table}_quarantine_keys", load=load, staged=True)
    # counted in the load's own partitions, whose files know their rows
    written = table_exists(spark, table)
    return (spark.read.parquet(table).filter(F.col(LOAD) == load).count() if written else 0), refused


def check_load(spark: SparkSession, bronze_base: str) -> dict:
    """The load job's own checks on the raw listing table: it is there (V5), its dates are text
    (V4), and some dates and prices for the report (V6). Raises where a check fails."""
    table = f"{bronze_base}/{FACT_TABLE}"
    missing = check_tables_exist(spark, [table])
    if missing:
        raise IngestError(f"missing tables: {missing}")
    df = spark.read.parquet(table)
    wrong = check_schema(spark, df, {"SCRAPED_DATE": "string", "HOST_SINCE": "string"}).collect()
    if wrong:
        raise IngestError(f"dates must be text in the raw layer: {wrong}")
    return {c: sample_values(df, c) for c in ("SCRAPED_DATE", "PRICE")}


#: Columns that joins, filters and groups of the models and analyses use: their statistics plan them.
PLANNED_BY = frozenset((
    "listing_id", "host_id", "month_date", "month_start", "scraped_date", "listing_neighbourhood", "host_neighbourhood",
    "LGA_CODE", "LGA_NAME", "SUBURB_NAME", "LGA_CODE_2016", "LISTING_ID", "MONTH_YEAR",
))


def planned_by(df: DataFrame) -> list[str]:
    """Not time stamps without a zone (a version's validity): the estimator fails on filters over their
    statistics, and without these assumes that all rows pass."""
    return [c for c in df.columns if c in PLANNED_BY]


def register_tables(spark: SparkSession, bronze_base: str, names=None, prefix: str = "", columns: bool = False) -> list[str]:
    """The raw tables as catalog tables over their folders, named ``prefix`` and table, statistics
    refreshed; with ``columns`` those of the columns that plans use."""
    names = names or [FACT_TABLE, *(t for t, _, _ in DIM_SPECS.values())]
    made = [n for n in names if table_exists(spark, f"{bronze_base}/{n}")]
    for n in made:
        full = f"{prefix}{n}"
        if not spark.catalog.tableExists(full):
            spark.catalog.createTable(full, path=f"{bronze_base}/{n}", source="parquet")
        spark.catalog.refreshTable(full)
        if n == FACT_TABLE:
            spark.sql(f"MSCK REPAIR TABLE {full}")
        analyze(spark, full, planned_by(spark.table(full)) if columns else None)
    return made


class Warehouse(Domain):
    """Model frames over bronze tables written by ``load_dimensions``/``load_facts``.

    With ``catalog`` (a prefix such as ``lodge.``) raw tables, snapshots, the monthly fact and the marts are
    catalog tables of that prefix, written once by this object, with column statistics (A12, A14);
    after ``sinks.plan_by_statistics`` joins are ordered by them. Other sessions read them by name.
    """

    def __init__(self, spark: SparkSession, bronze_base: str, boundary: str = "overlap",
                 horizon=None, materialize: bool = False, catalog: str | None = None):
        super().__init__(spark, bronze_base, boundary=boundary, horizon=horizon,
                         materialize=materialize)
        self.base = bronze_base.rstrip("/")
        self.catalog = catalog
        self._named: dict[str, DataFrame] = {}
        if catalog is not None:
            register_tables(spark, self.base, prefix=catalog, columns=True)

    def _bronze(self, table: str) -> DataFrame:
        if self.catalog is not None:
            return self.spark.table(f"{self.catalog}{table}")
        return self.spark.read.parquet(f"{self.base}/{table}")

    def _table(self, build, name: str, partition_by=None) -> DataFrame:
        if self.catalog is None:
            return super()._table(build, name, partition_by)
        if name not in self._named:
            df = build()
            full = self.catalog + re.sub(r"\W", "_", name)
            self._named[name] = save_named(df, full, partition_by, planned_by(df)).select(*df.columns)
        return self._named[name]

    @cached_property
    def stg(self) -> DataFrame:
        return M.stg_listing(self._bronze(FACT_TABLE))

    @cached_property
    def stg_lga_code(self) -> DataFrame:
        return M.stg_lga_code(self._bronze("r_d_nsw_lga_code"))

    @cached_property
    def stg_lga_suburb(self) -> DataFrame:
        return M.stg_lga_suburb(self._bronze("r_d_nsw_lga_suburb"))

    @cached_property
    def g01(self) -> DataFrame:
        return M.stg_census_g01(self._bronze("r_d_2016census_g01_nsw_lga"))

    @cached_property
    def g02(self) -> DataFrame:
        return M.stg_census_g02(self._bronze("r_d_2016census_g02_nsw_lga"))

    @cached_property
    def obs(self) -> DataFrame:
        raise AttributeError("a Warehouse reads bronze tables, not driver observations")

