"""The five business analyses (N14-N18) as Spark plans.

All take a ``Domain`` (or its frames) and parameters with the reference values
as defaults: trailing window ``n=12`` months, ``k`` = 3 / 5 / 30.

Scale notes: every global window (ranks, share of total) runs only on an
already-aggregated frame with one row per area; per-host questions are answered
with duplicate-insensitive ``min``/``max`` aggregates (map-side combined), so a
host holding a third of all listings still shuffles a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.functions import asc_pg, desc_pg, ratio, safe_corr
from lodgeflow.operators.lookup import resolve_lookup
from lodgeflow.operators.ranking import pct_where, share_of_total, top1_per_group, top_bottom
from lodgeflow.operators.temporal import asof_month_join, overlapping, trailing_bounds
from lodgeflow.plans.context import Domain

CODE = "LGA_CODE_2016"


def _trailing_neighbourhood(d: Domain, n: int, with_bounds: bool = False):
    """The neighbourhood mart's trailing ``n`` months (literal bounds, pushed down)."""
    mart = d.mart("neighbourhood").select("listing_neighbourhood", "month_start",
                                          "avg_est_rev_per_active")
    bounds = trailing_bounds(mart, "month_start", n)
    l12 = (mart.filter(F.col("month_start").between(*bounds)) if bounds
           else mart.filter(F.lit(False)))
    return (l12, bounds) if with_bounds else l12


def _resolve(df: DataFrame, d: Domain) -> DataFrame:
    """Area -> LGA code."""
    return resolve_lookup(df, "listing_neighbourhood", d.lookup, name_alias=None)


def _lga_names(d: Domain) -> DataFrame:
    return d.dim_lga.select(F.col("lga_code").alias(CODE), "lga_name").distinct()


def top_bottom_bands(d: Domain, n: int = 12, k: int = 3) -> DataFrame:
    """Demographics of the top-k and bottom-k LGAs by revenue per active listing."""
    l12 = _trailing_neighbourhood(d, n)
    mapped = _resolve(l12, d)
    lga_rev = (mapped.filter(F.col(CODE).isNotNull()).groupBy(CODE)
               .agg(F.avg("avg_est_rev_per_active").alias("avg_rev_per_active_listing")))
    bands = top_bottom(lga_rev, "avg_rev_per_active_listing", k,
                       top_label=f"TOP{k}", bottom_label=f"BOT{k}")
    g02 = d.dim_census_g02.select(CODE, F.col("Median_age_persons").alias("median_age"),
                       F.col("Average_household_size").alias("avg_household_size"))
    g01 = d.dim_census_g01
    tot = F.col("Tot_P_P")

    def share(*cols):
        s = F.col(cols[0])
        for c in cols[1:]:
            s = s + F.col(c)
        return ratio(s, tot)

    out = (bands.join(g02, CODE, "left").join(g01, CODE, "left")
           .join(_lga_names(d), CODE, "left")
           .select(
               "band",
               F.coalesce(F.col("lga_name"), F.lit("UNKNOWN")).alias("lga_name"),
               "avg_rev_per_active_listing",
               "median_age", "avg_household_size",
               share("Age_0_4_yr_P", "Age_5_14_yr_P").alias("pct_0_14"),
               share("Age_15_19_yr_P", "Age_20_24_yr_P").alias("pct_15_24"),
               share("Age_25_34_yr_P").alias("pct_25_34"),
               share("Age_35_44_yr_P").alias("pct_35_44"),
               share("Age_45_54_yr_P", "Age_55_64_yr_P").alias("pct_45_64"),
               share("Age_65_74_yr_P", "Age_75_84_yr_P", "Age_85ov_P").alias("pct_65_plus"),
           ))
    return out.orderBy(F.when(F.col("band") == f"TOP{k}", 1).otherwise(2),
                       desc_pg("avg_rev_per_active_listing"))


def age_revenue_corr(d: Domain, n: int = 12) -> DataFrame:
    """Correlation of census median age with 12-month revenue per active listing."""
    l12 = _trailing_neighbourhood(d, n)
    neigh_rev = l12.groupBy("listing_neighbourhood").agg(
        F.avg("avg_est_rev_per_active").alias("rev_active_avg_12m"))
    neigh = _resolve(neigh_rev, d)
    joined = (neigh.filter(F.col(CODE).isNotNull() & F.col("rev_active_avg_12m").isNotNull())
              .join(d.dim_census_g02.select(CODE, "Median_age_persons"), CODE)
              .filter(F.col("Median_age_persons").isNotNull()))
    return joined.agg(
        F.count(F.lit(1)).alias("n_neighbourhoods"),
        safe_corr(F.col("Median_age_persons").cast("double"),
                  F.col("rev_active_avg_12m").cast("double")).alias("corr_median_age_vs_revenue"))


def best_combo_per_area(d: Domain, n: int = 12, k: int = 5) -> DataFrame:
    """For the top-k neighbourhoods, the (property, room, size) with most stays."""
    l12, bounds = _trailing_neighbourhood(d, n, with_bounds=True)
    neigh_rev = l12.groupBy("listing_neighbourhood").agg(
        F.avg("avg_est_rev_per_active").alias("avg_rev_per_active_listing_12m"))
    top = (neigh_rev.withColumn("_rnk", F.rank().over(
        Window.orderBy(desc_pg("avg_rev_per_active_listing_12m"))))
        .filter(F.col("_rnk") <= k).drop("_rnk"))
    months = l12.select(F.col("month_start").alias("month_date")).distinct()
    fact = d.fact.join(months, "month_date", "left_semi")
    versions = d.dim_listing
    if bounds is not None:
        fact = fact.filter(F.col("month_date").between(*bounds))
        versions = overlapping(versions, *bounds)
    versions = versions.join(top.select("listing_neighbourhood"), "listing_neighbourhood",
                             "left_semi")
    fa = asof_month_join(fact.select("listing_id", "month_date", "stays", "price"),
                         versions.select("listing_id", "listing_neighbourhood", "property_type",
                                         "room_type", "accommodates", "valid_from_month",
                                         "valid_to_month"),
                         "listing_id", "month_date")
    by_type = fa.groupBy("listing_neighbourhood", "property_type", "room_type",
                         "accommodates").agg(
        F.sum("stays").cast("long").alias("total_stays_12m"),
        F.sum(F.col("stays") * F.col("price")).alias("total_revenue_12m"))
    best = top1_per_group(by_type, ["listing_neighbourhood"], [
        desc_pg("total_stays_12m"), asc_pg("property_type"), asc_pg("room_type"),
        asc_pg("accommodates")])
    return (best.join(top, "listing_neighbourhood")
            .select("listing_neighbourhood", "avg_rev_per_active_listing_12m", "property_type", "room_type", "accommodates", "total_stays_12m",
                    "total_revenue_12m")
            .orderBy(desc_pg("avg_rev_per_active_listing_12m")))


def _fact_window(d: Domain, n: int, fact_cols) -> DataFrame:
    """Trailing-window fact rows aligned to the listing version of their month.

    The window bounds are literals: the fact scan prunes month partitions and
    the version scan skips versions closed before the window.
    """
    bounds = trailing_bounds(d.fact, "month_date", n)
    if bounds is None:
        lo = hi = None
        fact = d.fact.select(*fact_cols).filter(F.lit(False))
        versions = d.dim_listing
    else:
        lo, hi = bounds
        fact = d.fact.select(*fact_cols).filter(F.col("month_date").between(lo, hi))
        versions = overlapping(d.dim_listing, lo, hi)
    versions = versions.select("listing_id", "listing_neighbourhood", "valid_from_month",
                               "valid_to_month")
    fa = asof_month_join(fact, versions, "listing_id", "month_date")
    return _resolve(fa, d)


def host_concentration(d: Domain, n: int = 12) -> DataFrame:
    """Multi-listing hosts whose listings sit in one LGA vs several.

    ``count(DISTINCT listing) >= 2`` and ``count(DISTINCT lga) = 1`` are
    decided with min/max per host, which needs no distinct step.
    """
    mapped = _fact_window(d, n, ["host_id", "listing_id", "month_date"])
    per_host = (mapped.filter(F.col(CODE).isNotNull()).groupBy("host_id").agg(
        F.min("listing_id").alias("_l_min"), F.max("listing_id").alias("_l_max"),
        F.min(CODE).alias("_c_min"), F.max(CODE).alias("_c_max")))
    multi = per_host.filter(F.col("_l_min") != F.col("_l_max"))
    spread = F.when(F.col("_c_min") == F.col("_c_max"), F.lit("Concentrated")).otherwise(
        F.lit("Distributed"))
    counts = multi.groupBy(spread.alias("spread_type")).agg(F.count(F.lit(1)).alias("hosts"))
    return share_of_total(counts, "hosts", "pct_hosts").orderBy("spread_type")


def host_cost_cover(d: Domain, n: int = 12, limit: int = 30) -> DataFrame:
    """Single-listing hosts whose 12-month revenue covers the annual median mortgage.

    One pass over the window: pre-aggregate per (host, LGA) with map-side
    combine, then per host decide single-listing (min = max listing), total
    revenue and the modal LGA (most rows, smallest code on ties).
    """
    mapped = _fact_window(d, n, ["host_id", "listing_id", "month_date", "has_availability",
                                 "stays", "price"])
    rev = F.when(F.col("has_availability"), F.col("stays").cast("decimal(10,0)") * F.col("price")
                 ).otherwise(F.lit(0))
    per_host_lga = mapped.groupBy("host_id", CODE).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(rev).alias("_rev"),
        F.min("listing_id").alias("_l_min"), F.max("listing_id").alias("_l_max"))
    mode_key = F.when(F.col(CODE).isNotNull(),
                      F.struct((-F.col("_n")).alias("n"), F.col(CODE).alias("c")))
    per_host = (per_host_lga.filter(F.col("host_id").isNotNull()).groupBy("host_id").agg(
        F.min("_l_min").alias("_l_min"), F.max("_l_max").alias("_l_max"),
        F.sum("_rev").alias("rev_12m"), F.min_by(F.col(CODE), mode_key).alias(CODE))
        .filter(F.col("_l_min") == F.col("_l_max")))
    g02 = d.dim_census_g02.select(CODE, (F.col("Median_mortgage_repay_monthly") * F.lit(12))
                       .alias("annual_median_mortgage"))
    joined = (per_host.filter(F.col(CODE).isNotNull()).join(g02, CODE)
              .join(_lga_names(d), CODE))
    out = pct_where(joined, ["lga_name"], F.col("rev_12m") >= F.col("annual_median_mortgage"),
                    "single_hosts", "hosts_covering", "pct_covering")
    return out.orderBy(desc_pg("pct_covering"), asc_pg("lga_name")).limit(limit)
