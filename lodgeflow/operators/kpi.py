"""Monthly KPI marts (N11-N13): one function, parameterised by the grouping.

Plan shape (per mart): expand listing versions to months, expand host versions
to months, **pre-aggregate** the host side to one row per (host, month, host
group) carrying a multiplicity ``_w`` and an any-superhost flag, join on
(host_id, month_start), then one grouped aggregate and one small window.

The pre-aggregation keeps the reference's row multiplicity (a host with two
versions in its change month doubles its listings' rows there, K1) as a
weight instead of duplicated rows, so a hot host never multiplies the largest
group. Every aggregate is weighted accordingly and all of them are additive
with map-side combine: (group, month, host) first, then (group, month), so
distinct hosts need no Expand. The median is found by counting
(``exact_median``). All marts of one join type share one base table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.functions import ratio, renormalise_bool, stays, upper_trim, zero_to_null
from lodgeflow.operators.temporal import expand_months
from lodgeflow.session import ensure_checkpoint_dir

MART_COLUMNS = (
    "month_start", "year", "month", "active_listings_rate", "min_price_active",
    "max_price_active", "median_price_active", "avg_price_active", "distinct_hosts",
    "superhost_rate", "avg_review_rating_active", "total_stays", "avg_est_rev_per_active",
    "pct_change_active", "pct_change_inactive",
)
# Computed by the reference but not part of its output (K6); ``extra=True`` adds them.
EXTRA_COLUMNS = ("listings_total", "listings_active", "listings_inactive", "est_revenue")


def listing_months(dim_listing: DataFrame, lo, hi,
                   group_cols: Sequence[str] = ("listing_neighbourhood",)) -> DataFrame:
    """Listing-month rows of the marts: activity, stays, zero-as-NULL price/rating."""
    x = expand_months(dim_listing, lo, hi)
    types = dict(dim_listing.dtypes)
    return x.select(
        "month_start", "listing_id", "host_id",
        *[(upper_trim(F.col(g)) if types[g] == "string" else F.col(g)).alias(g)
          for g in group_cols],
        F.coalesce(F.col("has_availability"), F.lit(False)).alias("is_active"),
        stays(F.col("has_availability"), F.col("availability_30")).alias("stays"),
        zero_to_null(F.col("price")).alias("price"),
        zero_to_null(F.col("review_scores_rating")).alias("review_scores_rating"),
    )


def host_months(dim_host: DataFrame, lo, hi,
                group_cols: Sequence[str] = ("host_neighbourhood",)) -> DataFrame:
    """Host-month rows of the marts: superhost flag re-normalised."""
    x = expand_months(dim_host, lo, hi)
    return x.select(
        "month_start", "host_id",
        *[upper_trim(F.col(g)).alias(g) for g in group_cols],
        renormalise_bool(F.col("host_is_superhost")).alias("is_superhost"),
    )


def mart_base(lm: DataFrame, hm: DataFrame, host_groups: Sequence[str] = (),
              how: str = "left") -> DataFrame:
    """Listing-months joined with their host's months, pre-aggregated with a weight ``_w``.

    ``how`` is the listing->host join type (``left`` for the listing and
    property marts, ``inner`` for the host-area mart, K9). Listing-months
    without a host can't match: they pass beside the join, not through it as
    one hot NULL key.
    """
    hosts = (hm.groupBy("host_id", "month_start", *host_groups)
             .agg(F.count(F.lit(1)).alias("_w"),
                  F.max(F.coalesce(F.col("is_superhost"), F.lit(False))).alias("_sh")))
    # Each task holds its partition's host-months: from the size of the snapshot's files the planner takes
    # them for small and would broadcast them all.
    base = lm.filter(F.col("host_id").isNotNull()).join(hosts.hint("shuffle_hash"), ["host_id", "month_start"], how)
    if how == "left":
        base = base.unionByName(lm.filter(F.col("host_id").isNull()), allowMissingColumns=True)
    return base.withColumns({"_w": F.coalesce(F.col("_w"), F.lit(1)).cast("long"),
                             "_sh": F.coalesce(F.col("_sh"), F.lit(False))})


def _bin_of(edges: Column, value: Column, bits: int) -> Column:
    """How many of up to ``2**bits - 1`` sorted ``edges`` are below ``value``, by binary search."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(bits))))

    def step(at: Column, width: Column) -> Column:
        # null beyond the last edge
        return F.when(F.get(edges, at + width - 1) < value, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str,
                 bits: int = 7, rounds: int = 1) -> DataFrame:
    """Exact weighted median per group by selection, with the group's ``_min`` and ``_max``.

    Equal values of a group are one row with their summed weight. Each round cuts what is left of a
    group into ``2**bits`` bins at quantiles of its values, taken from a mergeable sketch: an edge that
    is a little off makes bins a little uneven, not the result wrong. Weights are summed by bin
    and only the bins that hold the two middle ranks go on, each as its interval of values with the
    weight below it; a last window sorts the values in these. So a task sorts about one in
    ``2**(bits * rounds)`` of a group's values, wherever they lie, and no task holds a group; ``rounds=2`` is for groups
    of over some 10**8 different values.

    A sketch may come out otherwise when a lost task is repeated or a plan is run twice. The interval
    carries its own edges and weight, so what follows agrees with them; between rounds it is
    checkpointed (two rows a group at most).
    """
    keys = list(keys)
    values = df.groupBy(*keys, value).agg(F.sum(weight).alias("_f"))
    v = F.col(value).cast("double")
    shares = F.array(*(F.lit(i / (1 << bits)) for i in range(1, 1 << bits)))
    sketch = F.kll_sketch_agg_double(v, max(800, 4 << bits))
    lower, upper = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    within = (F.col("_lo").isNull() | (v > F.col("_lo"))) & (F.col("_hi").isNull() | (v <= F.col("_hi")))
    kept = None
    for turn in range(rounds):
        if kept is None:
            left, group = values.withColumns({"_lo": F.lit(None).cast("double"), "_hi": F.lit(None).cast("double")}), keys
            edges = values.groupBy(*keys).agg(sketch.alias("_sketch"), F.sum("_f").alias("_n")).withColumn("_before", F.lit(0).cast("long"))
        else:
            ensure_checkpoint_dir(df.sparkSession)
            kept = kept.checkpoint().withColumn("_part", F.coalesce("_lo", F.lit(float("-inf"))))
            left, group = values.join(kept.drop("_n", "_before"), keys).filter(within), [*keys, "_part"]
            edges = left.groupBy(*group).agg(sketch.alias("_sketch")).join(kept.drop("_lo", "_hi"), group)
        edges = edges.withColumn("_edges", F.kll_sketch_get_quantile_double("_sketch", shares)).drop("_sketch")
        bin_ = _bin_of(F.col("_edges"), v, bits)
        cut = left.join(edges, group).withColumn("_bin", bin_).withColumns({
            "_lo": F.coalesce(F.when(F.col("_bin") > 0, F.get("_edges", F.col("_bin") - 1)), "_lo"),
            "_hi": F.coalesce(F.get("_edges", F.col("_bin")), "_hi")})
        by_bin = Window.partitionBy(*group).orderBy("_bin")
        kept = (cut.groupBy(*group, "_bin").agg(F.sum("_f").alias("_b"), *(F.first(c).alias(c) for c in ("_n", "_before", "_lo", "_hi")))
                .withColumn("_end", F.col("_before") + F.sum("_b").over(by_bin))
                .withColumn("_before", F.col("_end") - F.col("_b"))
                .filter((F.col("_end") > lower) & (F.col("_before") <= upper))
                .select(*keys, "_lo", "_hi", "_n", "_before"))
    by_value = Window.partitionBy(*keys, "_lo").orderBy(value)
    near = (values.join(kept, keys).filter(within)
            .withColumn("_to", F.col("_before") + F.sum("_f").over(by_value))
            .withColumn("_from", F.col("_to") - F.col("_f")))

    def at_rank(rank):
        return F.max(F.when((F.col("_from") <= rank) & (rank < F.col("_to")), F.col(value)))

    medians = near.groupBy(*keys).agg(at_rank(lower).alias("_l"), at_rank(upper).alias("_u"))
    ranges = values.groupBy(*keys).agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    return (ranges.join(medians, keys)
            .select(*keys, "_min", "_max",
                    ((F.col("_l").cast("double") + F.col("_u").cast("double")) / 2).alias(out)))


def measures() -> dict[str, Column]:
    """The additive measures of a mart, per row of a ``mart_base``."""
    w, act, price, rating = F.col("_w"), F.col("is_active"), F.col("price"), F.col("review_scores_rating")
    priced = act & price.isNotNull()
    rated = act & rating.isNotNull()
    return {
        "listings_total": w,
        "listings_active": F.when(act, w).otherwise(0),
        "listings_inactive": F.when(~act, w).otherwise(0),
        "_price_sum": F.when(priced, price * w),
        "_price_n": F.when(priced, w),
        "_rating_sum": F.when(rated, rating * w),
        "_rating_n": F.when(rated, w),
        "total_stays": F.col("stays") * w,
        "est_revenue": F.col("stays") * F.coalesce(price, F.lit(0)) * w,
    }


def kpis(base: DataFrame, group_cols: Sequence[str], extra: bool = False) -> DataFrame:
    """KPI table per (group, month) with month-on-month change of active/inactive counts.

    ``base`` is a ``mart_base``. Rows with a NULL group key are dropped (K14).
    Percent change compares with the previous month present for the group, not
    the calendar month (K13). Money stays DECIMAL; ratios of counts are DOUBLE.
    """
    group_cols = list(group_cols)
    for g in group_cols:
        base = base.filter(F.col(g).isNotNull())
    keys = [*group_cols, "month_start"]
    sums = measures()
    # Level 1: one row per (group, month, host); every measure is additive.
    per_host = base.groupBy(*keys, "host_id").agg(*(F.sum(c).alias(name) for name, c in sums.items()), F.max("_sh").alias("sh"))
    # Level 2: per (group, month); a host is one level-1 row, so distinct hosts are a plain
    # count (no Expand over the raw rows). The row of listings without a host is none.
    agg = per_host.groupBy(*keys).agg(
        *(F.sum(name).alias(name) for name in sums),
        F.count("host_id").alias("distinct_hosts"),
        F.count_if(F.col("sh") & F.col("host_id").isNotNull()).alias("distinct_superhosts"),
    )
    priced = F.col("is_active") & F.col("price").isNotNull()
    prices = exact_median(base.filter(priced), keys, "price", "_w", "median_price_active")
    return kpi_columns(agg.join(prices, keys, "left"), group_cols, extra)


def kpi_columns(agg: DataFrame, group_cols: Sequence[str], extra: bool = False) -> DataFrame:
    """A mart's columns from its measures, distinct counts and prices per (group, month)."""
    by_group = Window.partitionBy(*group_cols).orderBy("month_start")
    prev_act = F.lag("listings_active").over(by_group)
    prev_inact = F.lag("listings_inactive").over(by_group)
    # exact division: ranks of averages of this value must not hang on rounding of doubles
    revenue = F.col("est_revenue").cast("decimal(24,4)")
    out = agg.select(
        *group_cols,
        "month_start",
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        ratio(F.col("listings_active"), F.col("listings_total")).alias("active_listings_rate"),
        F.col("_min").alias("min_price_active"),
        F.col("_max").alias("max_price_active"),
        "median_price_active",
        ratio(F.col("_price_sum"), F.col("_price_n")).alias("avg_price_active"),
        "distinct_hosts",
        ratio(F.col("distinct_superhosts"), F.col("distinct_hosts")).alias("superhost_rate"),
        ratio(F.col("_rating_sum"), F.col("_rating_n")).alias("avg_review_rating_active"),
        F.col("total_stays").cast("long").alias("total_stays"),
        (revenue / F.nullif(F.col("listings_active").cast("decimal(10,0)"), F.lit(0)))
        .alias("avg_est_rev_per_active"),
        ratio(F.col("listings_active") - prev_act, prev_act).alias("pct_change_active"),
        ratio(F.col("listings_inactive") - prev_inact, prev_inact).alias("pct_change_inactive"),
        *([F.col(c) for c in EXTRA_COLUMNS] if extra else []),
    )
    return out


def monthly_kpis(lm: DataFrame, hm: DataFrame, group_cols: Sequence[str], how: str = "left",
                 extra: bool = False) -> DataFrame:
    """``kpis`` straight from listing-months and host-months; ``group_cols`` may come from either."""
    host_groups = [g for g in group_cols if g not in lm.columns]
    return kpis(mart_base(lm, hm, host_groups, how), group_cols, extra)
