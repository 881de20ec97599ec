"""Named models, bronze -> silver -> snapshots -> star -> marts.

Every model is a pure function returning a lazy DataFrame; the reference's
views stay lazy and its tables can be materialised with ``sources.sinks``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.functions import (
    blank_to_null,
    collapse_ws,
    digits_key,
    first_non_null,
    month_start,
    parse_bool,
    parse_money,
    parse_month_key,
    parse_text_date,
    stays,
    upper_trim,
    zero_to_null,
)
from lodgeflow.operators.history import (
    VALID_FROM,
    month_validity,
    scd2_check,
    scd2_timestamp,
    with_version_key,
)
from lodgeflow.operators.kpi import host_months, kpis, listing_months, mart_base
from lodgeflow.operators.sketches import month_sketches, sketched_kpis

# The review scores, and the columns of a listing version.
REVIEW_SCORES = ("rating", "accuracy", "cleanliness", "checkin", "communication", "value")
LISTING_SNAPSHOT_COLUMNS = (
    "listing_id", "host_id", "property_type", "room_type", "accommodates",
    "listing_neighbourhood", "has_availability", "availability_30", "price",
    "number_of_reviews", "review_scores_rating", "review_scores_accuracy",
    "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_value", "scraped_date",
)
# The host snapshot's check columns.
HOST_CHECK_COLUMNS = ("host_name", "host_is_superhost", "host_neighbourhood")


# --------------------------------------------------------------------- silver
def stg_listing(bronze: DataFrame, strict_dates: bool = False) -> DataFrame:
    """Type and normalise bronze listing text."""
    c = F.col
    return bronze.select(
        c("LISTING_ID").cast("bigint").alias("listing_id"),
        c("SCRAPE_ID").cast("bigint").alias("scrape_id"),
        c("HOST_ID").cast("bigint").alias("host_id"),
        parse_text_date(c("SCRAPED_DATE"), strict_dates).alias("scraped_date"),
        parse_text_date(c("HOST_SINCE"), strict_dates).alias("host_since"),
        parse_bool(c("HOST_IS_SUPERHOST")).alias("host_is_superhost"),
        parse_bool(c("HAS_AVAILABILITY")).alias("has_availability"),
        upper_trim(c("HOST_NAME")).alias("host_name"),
        upper_trim(c("HOST_NEIGHBOURHOOD")).alias("host_neighbourhood"),
        upper_trim(c("LISTING_NEIGHBOURHOOD")).alias("listing_neighbourhood"),
        upper_trim(c("PROPERTY_TYPE")).alias("property_type"),
        upper_trim(c("ROOM_TYPE")).alias("room_type"),
        c("ACCOMMODATES").cast("int").alias("accommodates"),
        parse_money(c("PRICE")).alias("price"),
        c("AVAILABILITY_30").cast("int").alias("availability_30"),
        c("NUMBER_OF_REVIEWS").cast("int").alias("number_of_reviews"),
        *[c(f"REVIEW_SCORES_{s.upper()}").cast("decimal(18,4)").alias(f"review_scores_{s}")
          for s in REVIEW_SCORES],
        parse_month_key(c("MONTH_YEAR")).alias("month_date"),
    )


def split_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """N3 with quarantine (K18): the typed rows, and the bronze rows whose scrape date or price
    has text that gives no value, with the ``reason``. Those rows are in the first frame too,
    with NULL in that column, as in the reference's lenient models."""
    date, price = F.col("SCRAPED_DATE"), F.col("PRICE")
    bad_date = (F.coalesce(date, F.lit("")) != "") & parse_text_date(date).isNull()
    bad_price = (F.regexp_replace(F.coalesce(price, F.lit("")), r"[^0-9.\-]", "") != "") & parse_money(price).isNull()
    reason = F.concat_ws(",", F.when(bad_date, "scraped_date"), F.when(bad_price, "price"))
    return stg_listing(bronze), bronze.withColumn("reason", reason).filter(F.col("reason") != "")


def silver_from_observations(obs: DataFrame) -> DataFrame:
    """The ``stg_listing`` shape built directly from typed observations."""
    c = F.col
    return obs.select(
        "listing_id", "scrape_id", "host_id",
        upper_trim(c("host_name")).alias("host_name"),
        c("is_superhost").alias("host_is_superhost"),
        upper_trim(c("host_area")).alias("host_neighbourhood"),
        upper_trim(c("neighbourhood")).alias("listing_neighbourhood"),
        upper_trim(c("property_type")).alias("property_type"),
        upper_trim(c("room_type")).alias("room_type"),
        "accommodates", "price", "has_availability", "availability_30", "number_of_reviews",
        *[c(s).alias(f"review_scores_{s}") for s in REVIEW_SCORES],
        "host_since", "scraped_date",
        month_start(c("scraped_date")).alias("month_date"),
    )


def stg_lga_code(bronze: DataFrame, normalise_code: bool = False) -> DataFrame:
    """LGA codes, upper-trimmed. ``normalise_code`` applies the census key
    rule (B12) to the code too, so non-5-digit codes still join (K20)."""
    code = upper_trim(F.col("LGA_CODE"))
    return bronze.select((digits_key(code) if normalise_code else code).alias("lga_code"),
                         upper_trim(F.col("LGA_NAME")).alias("lga_name"))


def stg_lga_suburb(bronze: DataFrame) -> DataFrame:
    """Suburb -> LGA name, upper-trimmed."""
    return bronze.select(upper_trim(F.col("LGA_NAME")).alias("lga_name"),
                         upper_trim(F.col("SUBURB_NAME")).alias("suburb_name"))


def _typed_measures(bronze: DataFrame, text_type: str):
    """Measures as numbers: raw text columns are cast (ANSI: bad text raises, as
    the reference's casts do); already-typed columns pass through."""
    return [(F.col(c).cast(text_type) if t == "string" else F.col(c)).alias(c)
            for c, t in bronze.dtypes if c != "LGA_CODE_2016"]


def stg_census_g01(bronze: DataFrame) -> DataFrame:
    """G01 with the 5-digit key (B12) replacing the original; counts as INT."""
    return bronze.select(digits_key(F.col("LGA_CODE_2016")).alias("LGA_CODE_2016"),
                         *_typed_measures(bronze, "int"))


def stg_census_g02(bronze: DataFrame) -> DataFrame:
    """G02 with the 5-digit key and ``annual_median_mortgage``."""
    return bronze.select(
        digits_key(F.col("LGA_CODE_2016")).alias("LGA_CODE_2016"),
        *_typed_measures(bronze, "decimal(18,4)"),
        (F.col("Median_mortgage_repay_monthly").cast(
            "decimal(18,4)" if dict(bronze.dtypes)["Median_mortgage_repay_monthly"] == "string"
            else dict(bronze.dtypes)["Median_mortgage_repay_monthly"]) * F.lit(12))
        .alias("annual_median_mortgage"))


# ----------------------------------------------------------------- snapshots
def snap_listing(stg: DataFrame, slices: str | None = None) -> DataFrame:
    """Listing history, timestamp strategy on ``scraped_date``."""
    src = stg.select(*LISTING_SNAPSHOT_COLUMNS).filter(F.col("listing_id").isNotNull())
    return scd2_timestamp(src, "listing_id", "scraped_date", slices)


def host_rows(stg: DataFrame) -> DataFrame:
    """Host observations: area fallback + normalisation (B8-B10), one row per
    (host, day) with the lowest listing id winning (F1, K3).

    Hosts can be hot keys (one host may own a large share of listings), so
    the dedup is an aggregate: map-side combine collapses a host's rows to
    one per day in every task before anything is shuffled. The rows are read once and
    joined with nothing: a join back to them was planned as a broadcast of all rows.
    """
    base = stg.filter(F.col("host_id").isNotNull() & F.col("scraped_date").isNotNull() & F.col("listing_id").isNotNull())
    area = collapse_ws(first_non_null(blank_to_null(F.col("host_neighbourhood")),
                                      blank_to_null(F.col("listing_neighbourhood"))))
    # the lowest listing id, then the least attributes where a listing has several rows a day
    attrs = F.struct(F.col("listing_id"), F.col("host_name"), F.col("host_since"), F.col("host_is_superhost"),
                     area.alias("host_neighbourhood"))
    picked = base.groupBy("host_id", "scraped_date").agg(F.min(attrs).alias("_a"))
    return picked.select("host_id", "_a.host_name", "_a.host_since", "_a.host_is_superhost",
                         "_a.host_neighbourhood", "scraped_date")


def snap_host(stg: DataFrame, slices: str | None = None) -> DataFrame:
    """Host history, check strategy on name, superhost flag and area."""
    return scd2_check(host_rows(stg), "host_id", "scraped_date", HOST_CHECK_COLUMNS, slices)


# ---------------------------------------------------------------------- star
def dim_snap_listing(snap: DataFrame, boundary: str = "overlap") -> DataFrame:
    """Listing versions with surrogate key and month validity."""
    keyed = with_version_key(snap, "listing_version_sk", [
        F.col("listing_id").cast("string"),
        F.coalesce(F.col(VALID_FROM).cast("string"), F.lit(""))])
    return month_validity(keyed, boundary=boundary)


def dim_snap_host(snap: DataFrame, boundary: str = "overlap") -> DataFrame:
    """Host versions with surrogate key and month validity."""
    keyed = with_version_key(snap, "host_version_sk", [
        F.col("host_id").cast("string"),
        F.coalesce(F.col("host_neighbourhood"), F.lit("UNKNOWN")),
        F.coalesce(F.col(VALID_FROM).cast("string"), F.lit(""))])
    return month_validity(keyed, boundary=boundary)


def dim_listing_monthly(stg: DataFrame) -> DataFrame:
    """Monthly listing fact, every row with a month and a listing."""
    rows = stg.filter(F.col("month_date").isNotNull() & F.col("listing_id").isNotNull())
    return rows.select(
        "listing_id", "host_id", "month_date", "has_availability", "availability_30",
        zero_to_null(F.col("price")).alias("price"),
        stays(F.col("has_availability"), F.col("availability_30")).alias("stays"),
        "number_of_reviews", "review_scores_rating")


def dim_lga(stg_code: DataFrame) -> DataFrame:
    """Pass-through LGA dimension."""
    return stg_code.select("lga_code", "lga_name")


def dim_census_g01(stg: DataFrame) -> DataFrame:
    """Pass-through census G01 dimension."""
    return stg.select("LGA_CODE_2016", *[c for c in stg.columns if c != "LGA_CODE_2016"])


def dim_census_g02(stg: DataFrame) -> DataFrame:
    """Pass-through census G02 dimension, with the annual mortgage."""
    return stg.select("LGA_CODE_2016", *[c for c in stg.columns if c != "LGA_CODE_2016"])


def dim_suburb(stg_suburb: DataFrame) -> DataFrame:
    """Pass-through suburb dimension."""
    return stg_suburb.select("suburb_name", "lga_name")


# ---------------------------------------------------------------------- marts
MART_KINDS = {
    # name: (listing-side groups, host-side groups, join type)
    "neighbourhood": (("listing_neighbourhood",), (), "left"),
    "property_type": (("property_type",), (), "left"),
    "host_neighbourhood": ((), ("host_neighbourhood",), "inner"),
    # The grain the reference's column docs describe for the property mart
    "property_room_size": (("property_type", "room_type", "accommodates"), (), "left"),
}


# All listing-side groups, so that one base feeds every mart of a join type.
BASE_GROUPS = ("listing_neighbourhood", "property_type", "room_type", "accommodates")


def kpi_base(dim_listing: DataFrame, dim_host: DataFrame, horizon, how: str = "left") -> DataFrame:
    """Listing-months with their hosts over ``horizon``; the ``inner`` base has the host's area."""
    h_groups = ("host_neighbourhood",) if how == "inner" else ()
    return mart_base(listing_months(dim_listing, *horizon, BASE_GROUPS),
                     host_months(dim_host, *horizon, h_groups), h_groups, how)


def kpi_mart(base: DataFrame, kind: str, extra: bool = False, approximate: bool = False) -> DataFrame:
    """Monthly KPI mart of the given kind over its base (``kpi_base``); ``approximate`` takes
    distinct hosts and medians from sketches, within the bounds of ``operators.sketches``."""
    l_groups, h_groups, _ = MART_KINDS[kind]
    groups = [*l_groups, *h_groups]
    if approximate:
        return sketched_kpis(month_sketches(base, groups), groups, extra)
    return kpis(base, groups, extra)


def newest_horizon(snapshot: DataFrame, n: int = 12) -> tuple[dt.date, dt.date] | None:
    """First and last of the ``n`` months that end at a snapshot's newest version (one aggregated
    row); None when it is empty."""
    row = snapshot.agg(F.trunc(F.max(VALID_FROM).cast("date"), "month").alias("hi")).first()
    if row["hi"] is None:
        return None
    k = row["hi"].year * 12 + row["hi"].month - n
    return dt.date(k // 12, k % 12 + 1, 1), row["hi"]
