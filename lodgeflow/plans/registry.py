"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each entry reads the driver tables under ``sf_dir`` and runs one model,
operator or analysis over the whole of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.functions import ratio
from lodgeflow.operators.kpi import exact_median
from lodgeflow.operators.history import month_validity, scd2_apply, scd2_check, scd2_timestamp
from lodgeflow.operators.lookup import resolve_lookup
from lodgeflow.operators.quality import (
    check_freshness,
    check_not_null,
    check_reference,
    check_unique,
)
from lodgeflow.operators import sketches as S
from lodgeflow.operators.temporal import asof_month_join, expand_months, last_n_months
from lodgeflow.plans import analyses as A
from lodgeflow.plans import models as M
from lodgeflow.plans.context import Domain
from lodgeflow.plans.marts import MartTable
from lodgeflow.session import scratch_path
from lodgeflow.sources import driver_tables as D
from lodgeflow.sources import sinks
from lodgeflow.sources.csv_ingest import (
    align_columns,
    assert_width,
    blank_as_null,
    clean_fact_text,
    split_valid,
)
from lodgeflow.sources.schemas import LISTING_SCHEMA
from lodgeflow.streaming.ingest import (
    SnapshotTable,
    month_file_stream,
    stream_months,
    stream_snapshot,
)

#: Month folders of any year.
ANY_MONTH = r"^MONTH_YEAR=\d{2}_\d{4}$"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


#: Values that are compared are rounded here, not in the engine.
DIGITS = 6
SILVER = ("listing_id", "scrape_id", "host_id", "scraped_date", "host_since", "host_is_superhost",
          "has_availability", "listing_neighbourhood", "host_neighbourhood", "property_type",
          "availability_30", "month_date")


def doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), DIGITS) for n in names})


def silver_columns(stg: DataFrame) -> DataFrame:
    """The silver columns that the load queries return."""
    scores = [f"review_scores_{s}" for s in M.REVIEW_SCORES]
    return doubles(stg.select(*SILVER, "price", *scores), "price", *scores)


def mart(spark: SparkSession, sf_dir: str, kind: str, boundary: str = "overlap") -> DataFrame:
    return doubles(Domain.of(spark, sf_dir, boundary=boundary).report(kind), "min_price_active",
                   "max_price_active", "median_price_active", "avg_est_rev_per_active")


@register("kpi_neighbourhood")
def kpi_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir, "neighbourhood")


@register("kpi_property_type")
def kpi_property_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir, "property_type")


@register("kpi_property_room_size")
def kpi_property_room_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The property mart at the (property, room, size) grain its docs describe."""
    return mart(spark, sf_dir, "property_room_size")


@register("kpi_host_area")
def kpi_host_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart(spark, sf_dir, "host_neighbourhood")


# ------------------------------------------------------------------ analyses
@register("top_bottom_bands")
def top_bottom_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(A.top_bottom_bands(Domain.of(spark, sf_dir)), "avg_rev_per_active_listing")


@register("age_revenue_corr")
def age_revenue_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(A.age_revenue_corr(Domain.of(spark, sf_dir)), "corr_median_age_vs_revenue")


@register("best_combo_per_area")
def best_combo_per_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(A.best_combo_per_area(Domain.of(spark, sf_dir)), "avg_rev_per_active_listing_12m",
                   "total_revenue_12m")


@register("host_concentration")
def host_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.host_concentration(Domain.of(spark, sf_dir))


@register("host_cost_cover")
def host_cost_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.host_cost_cover(Domain.of(spark, sf_dir))


# ------------------------------------------------------------ history / time
@register("scd2_timestamp")
def scd2_timestamp_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = [f"review_scores_{s}" for s in M.REVIEW_SCORES]
    return doubles(Domain.of(spark, sf_dir).dim_listing.select(
        "listing_id", "scraped_date", "listing_version_sk", "dbt_valid_from", "dbt_valid_to",
        "is_current", *scores), *scores)


@register("scd2_check")
def scd2_check_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Domain.of(spark, sf_dir).dim_host.select(
        "host_id", "host_name", "host_since", "host_is_superhost", "host_neighbourhood",
        "host_version_sk", "dbt_valid_from", "dbt_valid_to", "is_current")


@register("scd2_hard_delete")
def scd2_hard_delete_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the newest month as one batch with hard-delete closing."""
    rows = M.host_rows(Domain.of(spark, sf_dir).stg)
    newest = rows.agg(F.trunc(F.max("scraped_date"), "month").alias("m")).first()["m"]
    before = rows.filter(F.col("scraped_date") < F.lit(newest))
    batch = rows.filter(F.col("scraped_date") >= F.lit(newest))
    # a written snapshot: the apply reads its open versions and, of the closed, keys and times
    current = sinks.materialize(
        spark, scd2_check(before, "host_id", "scraped_date", M.HOST_CHECK_COLUMNS), "snap-before")
    out = scd2_apply(current, batch, "host_id", "scraped_date", M.HOST_CHECK_COLUMNS,
                     close_missing=True)
    return out.select("host_id", "scraped_date", "host_neighbourhood", "dbt_valid_from",
                      "dbt_valid_to")


@register("scd2_apply_batches")
def scd2_apply_batches_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 property: three successive applies equal the closed form (K2).

    Each apply goes to a snapshot table in the shared checkpoint folder that
    rewrites only open versions + the batch; closed history is never rewritten.
    """
    rows = M.host_rows(Domain.of(spark, sf_dir).stg)
    table = SnapshotTable(spark, scratch_path(spark, "snap-host-batches"))
    bounds = [None, "1997-01-01", "1999-01-01", None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        cond = F.lit(True)
        if lo:
            cond = cond & (F.col("scraped_date") >= F.lit(lo).cast("date"))
        if hi:
            cond = cond & (F.col("scraped_date") < F.lit(hi).cast("date"))
        table.apply(rows.filter(cond), "host_id", "scraped_date", M.HOST_CHECK_COLUMNS)
    return table.current().select("host_id", "host_name", "host_is_superhost",
                                  "host_neighbourhood", "dbt_valid_from", "dbt_valid_to")


def _hot_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of one state per (key, time), half of them of one key."""
    return (spark.read.parquet(f"{sf_dir}/events.parquet")
            .select(F.when(F.col("user_id") % 2 == 0, F.lit(0)).otherwise(F.col("user_id")).cast("long").alias("entity_id"),
                    F.col("ts").cast("timestamp_ntz").alias("seen_at"), "event_type")
            .groupBy("entity_id", "seen_at").agg(F.min("event_type").alias("event_type")))


@register("scd2_hot_key_timestamp")
def scd2_hot_key_timestamp_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 in slices of a day, where one key holds half of all rows."""
    return scd2_timestamp(_hot_key_rows(spark, sf_dir), "entity_id", "seen_at", slices="day").select(
        "entity_id", "event_type", "dbt_valid_from", "dbt_valid_to")


@register("scd2_hot_key_check")
def scd2_hot_key_check_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 in slices of a day, where one key holds half of all rows."""
    return scd2_check(_hot_key_rows(spark, sf_dir), "entity_id", "seen_at", ["event_type"], slices="day").select(
        "entity_id", "event_type", "dbt_valid_from", "dbt_valid_to")


@register("month_validity")
def month_validity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(spark, sf_dir)
    both = month_validity(month_validity(d.snap_listing).withColumnRenamed("valid_to_month", "overlap_to_month"),
                          boundary="half_open")
    return both.select("listing_id", "dbt_valid_from", "valid_from_month",
                       F.col("valid_to_month").alias("half_open_to_month"),
                       F.col("overlap_to_month").alias("valid_to_month"), "is_current")


@register("month_expand")
def month_expand_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(spark, sf_dir)
    lo, hi = d.horizon
    return expand_months(d.dim_listing, lo, hi).select("listing_id", "dbt_valid_from",
                                                      "month_start")


@register("asof_month_join")
def asof_month_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(spark, sf_dir)
    fa = asof_month_join(d.fact.select("listing_id", "month_date", "stays"),
                         d.dim_listing.select("listing_id", "listing_version_sk",
                                              "valid_from_month", "valid_to_month"),
                         "listing_id", "month_date")
    return fa.select("listing_id", "month_date", "stays", "listing_version_sk")


@register("trailing_window")
def trailing_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(spark, sf_dir)
    return last_n_months(d.fact.select("listing_id", "host_id", "month_date", "stays"),
                         "month_date", 12)


@register("kpi_neighbourhood_half_open")
def kpi_neighbourhood_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 option: each month counted once, in the last version begun by then."""
    return mart(spark, sf_dir, "neighbourhood", "half_open")


def _mart_by_batches(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """A mart after three deliveries, each applied to both snapshots and then to the mart."""
    d = Domain.of(spark, sf_dir)
    lo = d.horizon[0]
    cuts = [F.add_months(F.lit(lo), n) for n in (5, 9)]
    base = scratch_path(spark, f"mart-by-batches-{kind}")
    listings, hosts = SnapshotTable(spark, f"{base}/listings"), SnapshotTable(spark, f"{base}/hosts")
    table = MartTable(spark, f"{base}/mart", kind, lo)
    at = F.col("scraped_date")
    for part in (at < cuts[0], (at >= cuts[0]) & (at < cuts[1]), at >= cuts[1]):
        batch = d.stg.filter(part)
        listings.apply(batch.select(*M.LISTING_SNAPSHOT_COLUMNS), "listing_id", "scraped_date")
        hosts.apply(M.host_rows(batch), "host_id", "scraped_date", M.HOST_CHECK_COLUMNS)
        table.refresh(listings, hosts)
    return doubles(table.mart(), "min_price_active", "max_price_active", "median_price_active", "avg_est_rev_per_active")


@register("kpi_neighbourhood_refreshed")
def kpi_neighbourhood_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_by_batches(spark, sf_dir, "neighbourhood")


@register("kpi_host_area_refreshed")
def kpi_host_area_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart_by_batches(spark, sf_dir, "host_neighbourhood")


@register("pct_change_lag")
def pct_change_lag_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Domain.of(spark, sf_dir).mart("property_type", extra=True)
    return m.select("property_type", "month_start", "listings_active", "listings_inactive",
                    "pct_change_active", "pct_change_inactive")


@register("filtered_aggs")
def filtered_aggs_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FILTER-style aggregates per month of the fact."""
    f = Domain.of(spark, sf_dir).fact
    act = F.coalesce(F.col("has_availability"), F.lit(False))
    priced = act & F.col("price").isNotNull()
    counts = f.groupBy("month_date").agg(
        F.count(F.lit(1)).alias("listings"),
        F.count_if(act).alias("listings_active"),
        F.count_distinct(F.when(act, F.col("host_id"))).alias("hosts_active"),
        ratio(F.sum(F.when(priced, F.col("price"))), F.count(F.when(priced, F.lit(1))))
        .alias("avg_price_active"))
    prices = exact_median(f.filter(priced).select("month_date", "price", F.lit(1).alias("w")), ["month_date"],
                          "price", "w", "median_price_active")
    out = counts.join(prices.withColumnsRenamed({"_min": "min_price_active", "_max": "max_price_active"}), "month_date", "left")
    return doubles(out, "min_price_active", "max_price_active", "median_price_active")


def _audited(keys: list[str], rows: DataFrame, sketched: DataFrame) -> DataFrame:
    """Exact measures of a sketched mart beside the exact distinct hosts of ``rows``, and whether
    the sketches' values are within their bounds."""
    hosts = rows.groupBy(*keys, "host_id").agg(F.lit(1).alias("_")).groupBy(*keys).agg(F.count("host_id").alias("hosts"))
    priced = rows.filter(F.col("is_active") & F.col("price").isNotNull())
    ranks = S.rank_distance(priced, sketched, keys, "price", "_w", "median_price_active")
    off = F.abs(F.col("distinct_hosts") - F.col("hosts"))
    out = sketched.join(hosts, keys).join(ranks, keys, "left").select(
        *keys, "listings_total", "active_listings_rate", "min_price_active", "max_price_active", "avg_price_active", "total_stays",
        "avg_est_rev_per_active", "hosts", (off <= F.greatest(F.lit(1.0), S.host_error() * F.col("hosts"))).alias("hosts_within"),
        F.when(F.col("max_price_active").isNotNull(), F.col("distance") <= 1.5 * S.rank_error()).alias("median_within"))
    return doubles(out, "min_price_active", "max_price_active", "avg_est_rev_per_active")


@register("kpi_neighbourhood_sketched")
def kpi_neighbourhood_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5/E10 opt-in: the mart from sketches, held against exact counts and ranks."""
    d = Domain.of(spark, sf_dir)
    base = d.mart_base("left").filter(F.col("listing_neighbourhood").isNotNull())
    sketched = sinks.materialize(spark, M.kpi_mart(base, "neighbourhood", extra=True, approximate=True), "mart-sketched")
    return _audited(["listing_neighbourhood", "month_start"], base, sketched)


@register("kpi_trailing_sketched")
def kpi_trailing_sketched(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """E5/E10 opt-in: KPIs of trailing quarters, merged from monthly sketches; the audit alone reads
    the listing-months again."""
    d = Domain.of(spark, sf_dir)
    groups = ["listing_neighbourhood"]
    base = d.mart_base("left").filter(F.col("listing_neighbourhood").isNotNull())
    monthly = sinks.materialize(spark, S.month_sketches(base, groups), "month-sketches")
    quarters = S.trailing_sketches(monthly, groups, n)
    sketched = sinks.materialize(spark, S.sketched_kpis(quarters, groups, extra=True), "quarters-sketched")
    ahead = base.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    rows = ahead.withColumn("month_start", F.add_months("month_start", F.col("_ahead")))
    return _audited([*groups, "month_start"], rows, sketched)


@register("median_outliers")
def median_outliers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact medians of groups that each hold a value 10^9 times the largest of the rest."""
    orders = D.read_table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_totalprice").cast("decimal(30,2)").alias("price"))
    far = orders.groupBy("o_orderpriority").agg((F.max("price") * 1_000_000_000).cast("decimal(30,2)").alias("price"))
    rows = orders.unionByName(far).withColumn("w", F.lit(1))
    out = exact_median(rows, ["o_orderpriority"], "price", "w", "median_price", rounds=2)
    return out.select("o_orderpriority", F.col("_max").cast("double").alias("max_price"), "median_price")


@register("monthly_fact")
def monthly_fact_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = Domain.of(spark, sf_dir).fact
    return f.withColumn("price", F.col("price").cast("double"))


@register("lookup_resolve")
def lookup_resolve_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(spark, sf_dir)
    rows = d.stg.select("listing_id", "scraped_date", "listing_neighbourhood")
    return resolve_lookup(rows, "listing_neighbourhood", d.lookup)


# ------------------------------------------------------------------- silver
@register("stg_listing_clean")
def stg_listing_clean_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze text -> loader clean -> key guard -> raw table -> silver typing."""
    stg = M.stg_listing(Domain.of(spark, sf_dir).bronze_listing)
    return silver_columns(stg)


@register("pk_guard")
def pk_guard_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows dropped for a blank natural key after date normalisation."""
    bad = Domain.of(spark, sf_dir).quarantine
    return bad.select(F.col("LISTING_ID").cast("bigint").alias("listing_id"),
                      F.col("SCRAPE_ID").cast("bigint").alias("scrape_id"),
                      F.col("MONTH_YEAR").alias("month_year"))


@register("align_columns")
def align_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: a file lacking REVIEW_SCORES_VALUE and carrying EXTRA, aligned to bronze."""
    raw = Domain.of(spark, sf_dir).raw_text
    incoming = raw.drop("REVIEW_SCORES_VALUE").withColumn("EXTRA", F.lit("x")) \
        .withColumnRenamed("PROPERTY_TYPE", "property_type")
    aligned = assert_width(align_columns(incoming, LISTING_SCHEMA), len(LISTING_SCHEMA))
    return aligned.select(F.col("LISTING_ID").cast("bigint").alias("listing_id"),
                          F.col("SCRAPE_ID").cast("bigint").alias("scrape_id"),
                          "PROPERTY_TYPE", "REVIEW_SCORES_VALUE", "MONTH_YEAR")


@register("key_normalise")
def key_normalise_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census keys ('LGA10001') normalised to 5 digits meet the LGA codes."""
    d = Domain.of(spark, sf_dir)
    return (d.dim_census_g01.select("LGA_CODE_2016", "Tot_P_P")
            .join(d.dim_lga, F.col("LGA_CODE_2016") == F.col("lga_code"), "left")
            .select("LGA_CODE_2016", "lga_name", "Tot_P_P"))


@register("census_g02")
def census_g02_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = Domain.of(spark, sf_dir).dim_census_g02
    return g.select("LGA_CODE_2016", "Median_age_persons",
                    F.col("Median_mortgage_repay_monthly").cast("double")
                    .alias("Median_mortgage_repay_monthly"),
                    F.col("annual_median_mortgage").cast("double").alias("annual_median_mortgage"),
                    "Average_household_size")


@register("dim_suburb_lga")
def dim_suburb_lga_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Domain.of(spark, sf_dir)
    return d.dim_suburb.join(d.dim_lga, "lga_name").select("suburb_name", "lga_name", "lga_code")


# ------------------------------------------------------------------ quality
@register("unique_violations")
def unique_violations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = D.read_table(spark, sf_dir, "lineitem")
    return check_unique(li, ["l_orderkey", "l_linenumber"])


@register("not_null_violations")
def not_null_violations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = Domain.of(spark, sf_dir).stg
    return check_not_null(stg, ["listing_id", "host_id", "price", "has_availability",
                                "review_scores_rating", "host_neighbourhood", "scraped_date"])


@register("referential_integrity")
def referential_integrity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing areas that are not a known suburb, with their row counts."""
    d = Domain.of(spark, sf_dir)
    bad = check_reference(d.stg, d.dim_suburb, "listing_neighbourhood", "suburb_name")
    return bad.groupBy("listing_neighbourhood").agg(F.count(F.lit(1)).alias("n_rows"))


@register("freshness")
def freshness_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_freshness(Domain.of(spark, sf_dir).stg, "scraped_date", ["listing_neighbourhood"],
                           max_age_days=31)


# ------------------------------------------------------------ sinks/stream
@register("month_guard_load")
def month_guard_load_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load early months, then re-deliver everything; each row lands once."""
    obs = Domain.of(spark, sf_dir).obs.select(
        "listing_id", "scraped_date", sinks.month_key(F.col("scraped_date")).alias("MONTH_YEAR"))
    path = scratch_path(spark, "month-guard")
    keys = ["listing_id", "scraped_date"]
    sinks.load_new_rows(spark, obs.filter(F.col("scraped_date") < "1998-01-01"), path, keys)
    sinks.load_new_rows(spark, obs, path, keys)
    return spark.read.parquet(path).select("listing_id", "scraped_date",
                                           F.col("MONTH_YEAR").alias("month_year"))


def _stage_month_files(spark: SparkSession, sf_dir: str) -> str:
    """The month files of the input folder (written once per session)."""
    return Domain.of(spark, sf_dir).month_files


@register("stream_month_ingest")
def stream_month_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: month files streamed once into the raw table, then typed to silver."""
    src = _stage_month_files(spark, sf_dir)
    sink = scratch_path(spark, "bronze-listing")
    q = stream_months(spark, src, scratch_path(spark, "ckpt-ingest"), sink)
    q.awaitTermination()
    stg = M.stg_listing(spark.read.parquet(sink))
    return silver_columns(stg)


def _mixed_files(spark: SparkSession, sf_dir: str) -> str:
    """Month files with three kinds of header by month: as declared; reversed and in lower case;
    without two columns and with one that is not declared."""
    raw = Domain.of(spark, sf_dir).raw_text
    names = [c for c in raw.columns if c != "MONTH_YEAR"]
    kinds = [[F.col(c) for c in names], [F.col(c).alias(c.lower()) for c in reversed(names)],
             [F.col(c) for c in names if c not in MISSING_COLUMNS] + [F.lit("x").alias("EXTRA")]]
    path = scratch_path(spark, "mixed-files")
    for kind, columns in enumerate(kinds):
        (raw.filter(F.substring("MONTH_YEAR", 1, 2).cast("int") % 3 == kind).select(*columns, "MONTH_YEAR")
         .hint("rebalance", "MONTH_YEAR").write.mode("append").partitionBy("MONTH_YEAR")
         .options(header="true", quote='"', escape='"').csv(path))
    return path


#: Columns that one kind of mixed file lacks.
MISSING_COLUMNS = ("HOST_SINCE", "REVIEW_SCORES_VALUE")


@register("load_mixed_headers")
def load_mixed_headers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns differ in order, case and number, aligned by their own headers."""
    from lodgeflow.plans.pipeline import load_facts
    bronze = scratch_path(spark, "bronze-mixed")
    load_facts(spark, _mixed_files(spark, sf_dir), bronze, pattern=ANY_MONTH)
    return silver_columns(M.stg_listing(spark.read.parquet(f"{bronze}/r_f_listing")))


@register("stream_mixed_headers")
def stream_mixed_headers_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/L1: the same files as a stream."""
    sink = scratch_path(spark, "bronze-mixed-stream")
    stream_months(spark, _mixed_files(spark, sf_dir), scratch_path(spark, "ckpt-mixed"), sink).awaitTermination()
    return silver_columns(M.stg_listing(spark.read.parquet(sink)))


@register("stream_split_months")
def stream_split_months_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files that each hold a part of every month, one file a batch; then all of them
    once more, as after a lost checkpoint."""
    raw = Domain.of(spark, sf_dir).raw_text
    files, sink = scratch_path(spark, "split-files"), scratch_path(spark, "bronze-split")
    raw.repartition(4, "LISTING_ID").write.options(header="true", quote='"', escape='"').csv(files)
    for _ in range(2):
        stream_months(spark, files, scratch_path(spark, "ckpt-split"), sink, max_files=1).awaitTermination()
    return silver_columns(M.stg_listing(spark.read.parquet(sink)))


def _deliver(spark: SparkSession, rows: DataFrame, inbox: str) -> None:
    """Observations as files ``MM_YYYY.csv`` in ``inbox``, one a month. They travel typed, half as wide as text."""
    path = scratch_path(spark, "delivery")
    months = rows.withColumn("_month", sinks.month_key(F.col("scraped_date"))).repartition("_month")
    D.bronze_listing_text(months).write.partitionBy("MONTH_YEAR").options(header="true", quote='"', escape='"').csv(path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(inbox))
    for st in fs.globStatus(hadoop(f"{path}/MONTH_YEAR=*/*.csv")):
        month = st.getPath().getParent().getName().partition("=")[2]
        fs.rename(st.getPath(), hadoop(inbox, f"{month}.csv"))


#: Month files of any year.
ANY_MONTH_FILE = r"^\d{2}_\d{4}\.csv$"


def _delivered_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Month files with the even listings, loaded and archived, then files of the same names with
    the odd listings and some of the even ones again. Returns the raw layer and the archive."""
    from lodgeflow.plans.pipeline import load_facts
    raw, listing = Domain.of(spark, sf_dir).obs, F.col("listing_id")
    inbox, bronze, archive = (scratch_path(spark, n) for n in ("inbox", "bronze-twice", "archive"))
    for part in (listing % 2 == 0, (listing % 2 == 1) | (listing % 5 == 0)):
        _deliver(spark, raw.filter(part), inbox)
        load_facts(spark, inbox, bronze, pattern=ANY_MONTH_FILE, archive_dir=archive)
    return bronze, archive


@register("load_redelivered_month")
def load_redelivered_month_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files delivered, archived and delivered again under their names with other rows; the keys
    of both deliveries are there once."""
    bronze, _ = _delivered_twice(spark, sf_dir)
    return silver_columns(M.stg_listing(spark.read.parquet(f"{bronze}/r_f_listing")))


@register("load_archive_clash")
def load_archive_clash_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries are in the archive, file by file; none took the other's place."""
    _, archive = _delivered_twice(spark, sf_dir)
    rows = (spark.read.option("recursiveFileLookup", "true").options(header="true", quote='"', escape='"').csv(archive)
            .select(F.col("_metadata.file_path").alias("path")))
    name = F.element_at(F.split("path", "/"), -1)
    files = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).withColumns({
        "month_year": F.substring(name, 1, 7), "stamped": name.rlike(r"^\d{2}_\d{4}_\d{8}T\d{6}Z")})
    return files.groupBy("month_year").agg(F.count(F.lit(1)).alias("n_files"), F.count_if("stamped").alias("n_stamped"), F.sum("n").alias("n_rows"))


def _resumed(spark: SparkSession, sf_dir: str) -> str:
    """A load of all month files that ends after its writes and before its end is written down, and a
    second run of the job. Returns the raw layer."""
    from lodgeflow.plans.pipeline import load_facts, start_loads
    from lodgeflow.sources.manifest import Manifest, listing
    bronze, files = scratch_path(spark, "bronze-resumed"), Domain.of(spark, sf_dir).month_files
    found = listing(spark, [f"{files}/{n}" for n in sinks.list_names(spark, files) if n.startswith("MONTH_YEAR=")])
    start_loads(spark, Manifest(spark, f"{bronze}/r_f_listing_manifest"), found, f"{bronze}/r_f_listing")
    load_facts(spark, files, bronze, pattern=ANY_MONTH)
    return bronze


@register("load_resumed")
def load_resumed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that failed after its writes, repeated: every row is there once."""
    return silver_columns(M.stg_listing(spark.read.parquet(f"{_resumed(spark, sf_dir)}/r_f_listing")))


@register("load_resumed_quarantine")
def load_resumed_quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """And every row without a key is in the quarantine once."""
    bad = spark.read.parquet(f"{_resumed(spark, sf_dir)}/r_f_listing_quarantine")
    return bad.select(F.col("LISTING_ID").cast("bigint").alias("listing_id"), F.col("SCRAPE_ID").cast("bigint").alias("scrape_id"),
                      F.col("MONTH_YEAR").alias("month_year"))


@register("silver_quarantine")
def silver_quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose date or price has text without a value."""
    _, bad = M.split_silver(Domain.of(spark, sf_dir).bronze_listing)
    return bad.select(F.col("LISTING_ID").cast("bigint").alias("listing_id"),
                      F.col("SCRAPE_ID").cast("bigint").alias("scrape_id"), "reason")


@register("declared_tests")
def declared_tests_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1/V2 on the declared key columns: how many values fail each test."""
    d = Domain.of(spark, sf_dir)
    out = None
    for frame, name in ((d.dim_suburb, "suburb_name"), (d.dim_lga, "lga_code"),
                        (d.dim_listing, "listing_version_sk"), (d.dim_host, "host_version_sk")):
        tests = {"not_null": check_not_null(frame, [name]).agg(F.coalesce(F.sum("null_rows"), F.lit(0)).alias("n")),
                 "unique": check_unique(frame.filter(F.col(name).isNotNull()), [name]).agg(F.count(F.lit(1)).alias("n"))}
        for test, found in tests.items():
            row = found.select(F.lit(name).alias("column_name"), F.lit(test).alias("test"), F.col("n").alias("failures"))
            out = row if out is None else out.unionByName(row)
    return out


@register("stream_scd2_apply")
def stream_scd2_apply_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: the streamed month files applied to the host snapshot per micro-batch."""
    src = _stage_month_files(spark, sf_dir)
    table = SnapshotTable(spark, scratch_path(spark, "snap-host"))

    def to_rows(batch: DataFrame) -> DataFrame:
        # The loaded batch is raw-layer data: written as a table, then typed.
        valid, _ = split_valid(clean_fact_text(batch), ["LISTING_ID", "SCRAPED_DATE"])
        loaded = sinks.materialize(spark, blank_as_null(valid), "bronze-batch")
        return M.host_rows(M.stg_listing(loaded))

    q = stream_snapshot(spark, month_file_stream(spark, src), table, to_rows, "host_id",
                        "scraped_date", scratch_path(spark, "ckpt-snap"),
                        check_cols=M.HOST_CHECK_COLUMNS)
    q.awaitTermination()
    return table.current().select("host_id", "host_name", "host_is_superhost",
                                  "host_neighbourhood", "dbt_valid_from", "dbt_valid_to")


# ------------------------------------------------------------- bronze jobs
@register("bronze_dims_load")
def bronze_dims_load_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four dimension files loaded to bronze, typed, folded into the lookup."""
    from lodgeflow.plans.pipeline import Warehouse, load_dimensions
    bronze = scratch_path(spark, "bronze-dims")
    load_dimensions(spark, Domain.of(spark, sf_dir).dimension_files, bronze)
    w = Warehouse(spark, bronze)
    g01 = w.g01.select(F.col("LGA_CODE_2016").alias("lga_code"), "Tot_P_P")
    g02 = w.g02.select(F.col("LGA_CODE_2016").alias("lga_code"),
                       F.col("annual_median_mortgage").cast("double")
                       .alias("annual_median_mortgage"))
    return (w.lookup.join(g01, "lga_code", "left").join(g02, "lga_code", "left")
            .select("name_key", "lga_code", "lga_name", "Tot_P_P", "annual_median_mortgage"))


@register("bronze_facts_load")
def bronze_facts_load_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every month folder loaded in one batch job (twice: the rerun adds
    nothing), then typed to silver."""
    from lodgeflow.plans.pipeline import load_facts
    bronze = scratch_path(spark, "bronze-facts")
    files = Domain.of(spark, sf_dir).month_files
    load_facts(spark, files, bronze, pattern=ANY_MONTH)
    load_facts(spark, files, bronze, pattern=ANY_MONTH)
    stg = M.stg_listing(spark.read.parquet(f"{bronze}/r_f_listing"))
    return silver_columns(stg)
