"""Lazily built domain frames over one input folder.

``Domain`` wires the models of ``plans.models`` onto the driver tables; every
attribute is a lazy DataFrame, built once per ``Domain`` instance.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.functions import asc_pg
from lodgeflow.operators.lookup import lga_name_lookup
from lodgeflow.plans import models as M
from lodgeflow.sources import driver_tables as D
from lodgeflow.session import scratch_path
from lodgeflow.sources.csv_ingest import CSV_OPTIONS, blank_as_null, clean_fact_text, split_valid
from lodgeflow.sources.schemas import G01_SCHEMA, LISTING_SCHEMA
from lodgeflow.sources.sinks import materialize


class Domain:
    """Model frames over one input folder (lazy plans; nothing is cached in memory).

    ``Domain.of`` returns one instance per (application, folder, options), so
    queries in one session resolve each shared model once, as a model registry
    resolves each reference once per run.
    """

    _instances: dict = {}
    _tables: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, boundary: str = "overlap",
           horizon=None, materialize: bool = True):
        key = (cls, spark.sparkContext.applicationId, id(spark), sf_dir, boundary,
               horizon and tuple(horizon), materialize)
        if key not in cls._instances:
            cls._instances[key] = cls(spark, sf_dir, boundary=boundary, horizon=horizon,
                                      materialize=materialize)
        return cls._instances[key]

    def __init__(self, spark: SparkSession, sf_dir: str, boundary: str = "overlap",
                 horizon=None, materialize: bool = True):
        """``horizon`` (first and last month of the marts) defaults to the twelve months that end
        at the newest listing version."""
        self.spark = spark
        self.sf_dir = sf_dir
        self.boundary = boundary
        self._horizon = horizon
        self.materialize = materialize
        self._marts: dict = {}

    @cached_property
    def horizon(self):
        found = self._horizon or M.newest_horizon(self.snap_listing)
        return found or (dt.date(1970, 1, 1), dt.date(1970, 1, 1))  # no versions, no rows

    def _table(self, build, name: str, partition_by=None) -> DataFrame:
        """Tables of the reference (raw layer, snapshots, monthly fact) are written
        once per session and input folder as parquet in the shared checkpoint
        folder; everything else (month validity, marts) stays a lazy view.
        ``build`` is only called when the table is not there yet."""
        if not self.materialize:
            return build()
        key = (self.spark.sparkContext.applicationId, id(self.spark), self.sf_dir, name)
        if key not in Domain._tables:
            Domain._tables[key] = materialize(self.spark, build(), name, partition_by)
        return Domain._tables[key]

    # bronze-equivalent inputs
    @cached_property
    def obs(self) -> DataFrame:
        return self._table(lambda: D.listing_observations(self.spark, self.sf_dir), "obs")

    @cached_property
    def raw_text(self) -> DataFrame:
        """The monthly files' content: every listing field as text (lazy)."""
        return D.bronze_listing_text(self.obs)

    @cached_property
    def month_files(self) -> str:
        """The raw text written once as CSV, one folder per month, as the monthly
        deliveries arrive (input of the loader and of the stream queries)."""
        key = (self.spark.sparkContext.applicationId, id(self.spark), self.sf_dir, "files")
        if key not in Domain._tables:
            path = scratch_path(self.spark, "month-files")
            (D.monthly_text(self.obs).write.partitionBy("MONTH_YEAR")
             .options(header="true", quote='"', escape='"').csv(path))
            Domain._tables[key] = path
        return Domain._tables[key]

    @cached_property
    def dimension_files(self) -> str:
        """The four reference dimension files, as CSV written from the driver
        tables once per session (tiny: bounded by the number of areas)."""
        key = (self.spark.sparkContext.applicationId, id(self.spark), self.sf_dir, "dims")
        if key not in Domain._tables:
            path = scratch_path(self.spark, "dimensions")
            g01 = D.bronze_census_g01(self.spark, self.sf_dir)
            for f in G01_SCHEMA.fields:          # full-width file, unused measures 0
                if f.name not in g01.columns:
                    g01 = g01.withColumn(f.name, F.lit(0))
            files = {
                "NSW_LGA_CODE.csv": D.bronze_lga_codes(self.spark, self.sf_dir)
                .withColumn("NOTE", F.lit("x")),
                "NSW_LGA_SUBURB.csv": D.bronze_lga_suburbs(self.spark, self.sf_dir),
                "2016Census_G01_NSW_LGA.csv": g01.select(*[f.name for f in G01_SCHEMA.fields]),
                "2016Census_G02_NSW_LGA.csv": D.bronze_census_g02(self.spark, self.sf_dir),
            }
            for name, df in files.items():
                df.coalesce(1).write.options(header="true").csv(f"{path}/{name}")
            Domain._tables[key] = path
        return Domain._tables[key]

    @cached_property
    def loaded_text(self) -> DataFrame:
        """The month files read back (A1) and cleaned by the loader."""
        files = (self.spark.read.schema(LISTING_SCHEMA).options(**CSV_OPTIONS)
                 .csv(self.month_files))
        return clean_fact_text(files)

    @cached_property
    def bronze_listing(self) -> DataFrame:
        """Raw layer as the loader writes it: rows with a blank natural key left
        out (B18), empty text as NULL; written once as a table."""
        def build():
            valid, _ = split_valid(self.loaded_text, ["LISTING_ID", "SCRAPED_DATE"])
            return blank_as_null(valid)
        return self._table(build, "bronze_listing")

    @cached_property
    def quarantine(self) -> DataFrame:
        """Rows the loader's key guard drops."""
        _, bad = split_valid(self.loaded_text, ["LISTING_ID", "SCRAPED_DATE"])
        return bad

    # silver
    @cached_property
    def stg(self) -> DataFrame:
        return M.silver_from_observations(self.obs)

    @cached_property
    def stg_lga_code(self) -> DataFrame:
        return M.stg_lga_code(D.bronze_lga_codes(self.spark, self.sf_dir))

    @cached_property
    def stg_lga_suburb(self) -> DataFrame:
        return M.stg_lga_suburb(D.bronze_lga_suburbs(self.spark, self.sf_dir))

    @cached_property
    def g01(self) -> DataFrame:
        return M.stg_census_g01(D.bronze_census_g01(self.spark, self.sf_dir))

    @cached_property
    def g02(self) -> DataFrame:
        return M.stg_census_g02(D.bronze_census_g02(self.spark, self.sf_dir))

    # star
    @cached_property
    def snap_listing(self) -> DataFrame:
        return self._table(lambda: M.snap_listing(self.stg), "snap_listing")

    @cached_property
    def snap_host(self) -> DataFrame:
        return self._table(lambda: M.snap_host(self.stg), "snap_host")

    @cached_property
    def dim_listing(self) -> DataFrame:
        return M.dim_snap_listing(self.snap_listing, self.boundary)

    @cached_property
    def dim_host(self) -> DataFrame:
        return M.dim_snap_host(self.snap_host, self.boundary)

    @cached_property
    def fact(self) -> DataFrame:
        # Partitioned by month: trailing windows become partition pruning.
        return self._table(lambda: M.dim_listing_monthly(self.stg), "dim_listing_monthly",
                           partition_by=["month_date"])

    @cached_property
    def dim_lga(self) -> DataFrame:
        return M.dim_lga(self.stg_lga_code)

    @cached_property
    def dim_suburb(self) -> DataFrame:
        return M.dim_suburb(self.stg_lga_suburb)

    @cached_property
    def dim_census_g01(self) -> DataFrame:
        return M.dim_census_g01(self.g01)

    @cached_property
    def dim_census_g02(self) -> DataFrame:
        return M.dim_census_g02(self.g02)

    @cached_property
    def lookup(self) -> DataFrame:
        """Area name -> LGA over the three reference paths (direct, dim_suburb, staged
        suburbs), one row per name."""
        return lga_name_lookup(self.dim_lga, [self.dim_suburb, self.stg_lga_suburb])

    # marts
    def report(self, kind: str) -> DataFrame:
        """A mart in its final order (G1): by group, then month. Few rows are left to sort."""
        l_groups, h_groups, _ = M.MART_KINDS[kind]
        return self.mart(kind).orderBy(*[asc_pg(c) for c in (*l_groups, *h_groups, "month_start")])

    def mart_base(self, how: str) -> DataFrame:
        """Listing-months with their hosts, written once and read by every mart of a join type."""
        name = f"mart_base_{how}_{self.boundary}_{self.horizon[0]}_{self.horizon[1]}"
        return self._table(lambda: M.kpi_base(self.dim_listing, self.dim_host, self.horizon, how), name)

    def mart(self, kind: str, extra: bool = False) -> DataFrame:
        """KPI mart; the neighbourhood mart feeds three analyses, so it is written
        once (per boundary and horizon) like the star tables."""
        key = (kind, extra)
        if key not in self._marts:
            def build():
                return M.kpi_mart(self.mart_base(M.MART_KINDS[kind][2]), kind, extra)
            if kind == "neighbourhood" and not extra:
                name = f"mart_{kind}_{self.boundary}_{self.horizon[0]}_{self.horizon[1]}"
                self._marts[key] = self._table(build, name)
            else:
                self._marts[key] = build()
        return self._marts[key]
