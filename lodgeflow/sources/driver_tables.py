"""Derive the rental domain from the driver's TPC-H-like parquet tables.

The reference ships no data, so the listing history, area lookups and census
tables are derived from ``orders``, ``customer``, ``nation`` and ``region`` by
fixed rules. Every rule is a native expression, so the derived tables grow with
the inputs and each one is an ordinary Spark job (scan, broadcast-checked join,
window dedup). The same rules are restated in SQL for the DuckDB oracle.

Mapping (listing = customer, scrape = order):

* ``listing_id`` = ``o_custkey``; even keys are their own host, odd keys share
  host ``o_custkey % 100`` (multi-listing hosts, and hot host keys for skew)
* ``neighbourhood`` = region name for every tenth listing, else nation name
  (so lookups hit both the direct LGA path and the suburb path)
* one observation per (listing, order date); the newest order wins
* LGA = region (code ``10000 + r_regionkey``), suburb = nation
* every 23rd order has no host; ``host_since`` and the review sub-scores follow from the keys
* census G01 = customers per region, age band ``c_custkey % 11``, male = even key
* census G02 = per-region aggregates of ``c_acctbal``
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgeflow.operators.ranking import dedupe

# Census G01 age bands (person counts), in the order the
# analyses read them.
AGE_BANDS = (
    "Age_0_4_yr", "Age_5_14_yr", "Age_15_19_yr", "Age_20_24_yr", "Age_25_34_yr",
    "Age_35_44_yr", "Age_45_54_yr", "Age_55_64_yr", "Age_65_74_yr", "Age_75_84_yr",
    "Age_85ov",
)
# Room types assigned by ``o_orderkey % 3``.
ROOM_TYPES = ("ENTIRE HOME/APT", "PRIVATE ROOM", "SHARED ROOM")
LGA_CODE_BASE = 10000
SUB_SCORES = ("accuracy", "cleanliness", "checkin", "communication", "value")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listing_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing history ``obs``: one row per (listing_id, scraped_date).

    Columns: listing_id, host_id, host_name, property_type, room_type,
    accommodates, neighbourhood, scraped_date, price, has_availability,
    availability_30, number_of_reviews, rating and its five sub-scores, host_since,
    is_superhost, host_area, scrape_id (the order key).
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    okey, ckey = F.col("o_orderkey"), F.col("o_custkey")
    host_id = F.when(okey % 23 != 0, F.when(ckey % 2 == 0, ckey).otherwise(ckey % 100))
    room = (F.when(okey % 3 == 0, F.lit(ROOM_TYPES[0]))
            .when(okey % 3 == 1, F.lit(ROOM_TYPES[1])).otherwise(F.lit(ROOM_TYPES[2])))
    joined = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey)
              .join(r, n.n_regionkey == r.r_regionkey))
    # Newest order per (listing, day), picked while rows are narrow: the other columns follow from these
    newest = dedupe(joined.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "c_mktsegment",
        F.col("o_orderdate").cast("date").alias("scraped_date"),
        F.when(ckey % 10 == 0, F.col("r_name")).otherwise(F.col("n_name")).alias("neighbourhood")),
        ["o_custkey", "scraped_date"], [okey.desc()])
    return newest.select(
        ckey.alias("listing_id"),
        host_id.alias("host_id"),
        F.concat(F.lit("HOST_"), host_id.cast("string")).alias("host_name"),
        F.col("o_orderpriority").alias("property_type"),
        room.alias("room_type"),
        (okey % 6 + 1).cast("int").alias("accommodates"),
        "neighbourhood",
        "scraped_date",
        F.when(okey % 11 == 0, F.lit(None)).otherwise(F.col("o_totalprice"))
        .cast("decimal(18,2)").alias("price"),
        F.when(F.col("o_orderstatus") == "O", F.lit(True))
        .when(F.col("o_orderstatus") == "F", F.lit(False)).alias("has_availability"),
        (okey % 31).cast("int").alias("availability_30"),
        (okey % 50).cast("int").alias("number_of_reviews"),
        F.when(okey % 7 == 0, F.lit(None)).otherwise((okey % 100).cast("double")).alias("rating"),
        *[F.when(okey % (7 + i) != 0, ((okey + i) % 11).cast("double")).alias(name)
          for i, name in enumerate(SUB_SCORES, start=1)],
        F.date_add(F.lit(dt.date(2010, 1, 1)), (host_id % 2000).cast("int")).alias("host_since"),
        (okey % 5 == 0).alias("is_superhost"),
        F.when(okey % 13 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("host_area"),
        okey.alias("scrape_id"),
    )


def bronze_lga_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``NSW_LGA_CODE`` as bronze text: LGA_CODE, LGA_NAME."""
    r = read_table(spark, sf_dir, "region")
    return r.select((F.col("r_regionkey") + LGA_CODE_BASE).cast("string").alias("LGA_CODE"),
                    F.col("r_name").alias("LGA_NAME"))


def bronze_lga_suburbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``NSW_LGA_SUBURB`` as bronze text: LGA_NAME, SUBURB_NAME."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("r_name").alias("LGA_NAME"), F.col("n_name").alias("SUBURB_NAME")))


def _customers_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return c.join(n, c.c_nationkey == n.n_nationkey)


def bronze_census_g01(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census G01: ``LGA_CODE_2016`` text plus {Tot_P, age bands} x {M, F, P} person counts.

    One aggregation over customers grouped by region; partial aggregation
    collapses every task to a handful of rows before the shuffle.
    """
    cr = _customers_by_region(spark, sf_dir)
    male = F.col("c_custkey") % 2 == 0
    band = F.col("c_custkey") % len(AGE_BANDS)

    def counts(prefix: str, cond):
        return [
            F.sum(F.when(cond & male, 1).otherwise(0)).cast("int").alias(f"{prefix}_M"),
            F.sum(F.when(cond & ~male, 1).otherwise(0)).cast("int").alias(f"{prefix}_F"),
            F.sum(F.when(cond, 1).otherwise(0)).cast("int").alias(f"{prefix}_P"),
        ]

    aggs = counts("Tot_P", F.lit(True))
    for i, name in enumerate(AGE_BANDS):
        aggs += counts(name, band == i)
    return (cr.groupBy("n_regionkey").agg(*aggs)
            .select(F.concat(F.lit("LGA"), (F.col("n_regionkey") + LGA_CODE_BASE).cast("string"))
                    .alias("LGA_CODE_2016"), *_g01_measure_names()))


def _g01_measure_names() -> list[str]:
    names = []
    for prefix in ("Tot_P",) + AGE_BANDS:
        names += [f"{prefix}_M", f"{prefix}_F", f"{prefix}_P"]
    return names


def bronze_census_g02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census G02: ``LGA_CODE_2016`` text plus medians/averages per region.

    Sums are taken in DECIMAL so the result does not depend on summation order.
    """
    cr = _customers_by_region(spark, sf_dir)
    bal = F.col("c_acctbal").cast("decimal(18,2)")
    agg = cr.groupBy("n_regionkey").agg(
        (F.sum(bal).cast("double") / F.count(F.lit(1)).cast("double")).alias("Median_age_persons"),
        F.max(bal).alias("Median_mortgage_repay_monthly"),
        F.min(bal).alias("Median_tot_prsnl_inc_weekly"),
        F.max(bal).alias("Median_rent_weekly"),
        F.sum(bal).alias("Median_tot_fam_inc_weekly"),
        (F.count(F.lit(1)).cast("double") / F.count_distinct("c_nationkey").cast("double"))
        .alias("Average_num_psns_per_bedroom"),
        F.min(bal).alias("Median_tot_hhd_inc_weekly"),
        (F.count(F.lit(1)).cast("double") / F.count_distinct("c_nationkey").cast("double"))
        .alias("Average_household_size"),
    )
    return agg.select(
        F.concat(F.lit("LGA"), (F.col("n_regionkey") + LGA_CODE_BASE).cast("string"))
        .alias("LGA_CODE_2016"),
        *[c for c in agg.columns if c != "n_regionkey"])


def monthly_text(obs: DataFrame) -> DataFrame:
    """``bronze_listing_text`` rebalanced by month, for files by month: typed rows travel, and become text,
    twice as wide, in the task that writes them."""
    return bronze_listing_text(obs.withColumn("_month", F.date_format("scraped_date", "MM_yyyy")).hint("rebalance", "_month"))


def bronze_listing_text(obs: DataFrame) -> DataFrame:
    """Raw listing rows as the monthly files would carry them (all text).

    Dates use one of three layouts by ``scrape_id % 3`` (``yyyy-MM-dd``,
    ``d/M/yyyy``, ``dd.MM.yyyy``); every 17th scrape has an unreadable date
    (``n/a``, quarantined by the key guard) and every 19th an impossible one
    (``31-02-yyyy``: accepted by the loader, NULL in silver). Prices carry
    ``$`` and thousands separators, every 29th is no number (``1-2``), flags use
    mixed spellings, area names mixed case and padding.
    """
    sid, d = F.col("scrape_id"), F.col("scraped_date")
    layout = (F.when(sid % 3 == 0, F.date_format(d, "yyyy-MM-dd"))
              .when(sid % 3 == 1, F.date_format(d, "d/M/yyyy"))
              .otherwise(F.date_format(d, "dd.MM.yyyy")))
    date_text = (F.when(sid % 17 == 0, F.lit("n/a"))
                 .when(sid % 19 == 0, F.concat(F.lit("31-02-"), F.year(d).cast("string")))
                 .otherwise(layout))

    def flag(c):
        yes = F.when(sid % 2 == 0, F.lit("t")).otherwise(F.lit("Yes"))
        no = F.when(sid % 2 == 0, F.lit("f")).otherwise(F.lit("No"))
        return F.when(c, yes).when(~c, no).otherwise(F.lit(""))

    def text(c):
        return F.coalesce(c.cast("string"), F.lit(""))

    return obs.select(
        text(F.col("listing_id")).alias("LISTING_ID"),
        text(sid).alias("SCRAPE_ID"),
        date_text.alias("SCRAPED_DATE"),
        text(F.col("host_id")).alias("HOST_ID"),
        text(F.col("host_name")).alias("HOST_NAME"),
        text(F.date_format("host_since", "d/M/yyyy")).alias("HOST_SINCE"),
        flag(F.col("is_superhost")).alias("HOST_IS_SUPERHOST"),
        text(F.col("host_area")).alias("HOST_NEIGHBOURHOOD"),
        F.concat(F.lit("  "), F.lower(F.col("neighbourhood")), F.lit(" ")).alias(
            "LISTING_NEIGHBOURHOOD"),
        text(F.col("property_type")).alias("PROPERTY_TYPE"),
        text(F.col("room_type")).alias("ROOM_TYPE"),
        text(F.col("accommodates")).alias("ACCOMMODATES"),
        F.when(sid % 29 == 0, F.lit("1-2")).when(F.col("price").isNull(), F.lit("")).otherwise(
            F.concat(F.lit("$"), F.format_number(F.col("price"), 2))).alias("PRICE"),
        flag(F.col("has_availability")).alias("HAS_AVAILABILITY"),
        text(F.col("availability_30")).alias("AVAILABILITY_30"),
        text(F.col("number_of_reviews")).alias("NUMBER_OF_REVIEWS"),
        text(F.col("rating")).alias("REVIEW_SCORES_RATING"),
        *[text(F.col(s)).alias(f"REVIEW_SCORES_{s.upper()}") for s in SUB_SCORES],
        F.date_format(d, "MM_yyyy").alias("MONTH_YEAR"),
    )
