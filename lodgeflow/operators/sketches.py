"""Mergeable sketches of the marts' distinct counts and medians (E5, E10), an opt-in for scale.

``month_sketches`` has one row per (group, month): the additive measures of the exact mart, an HLL
sketch of hosts and of superhosts, and a KLL sketch of active prices. All of it combines before the
shuffle, so a group of any size is a few kilobytes per task; the exact mart shuffles every host and
every price. Rows merge: ``trailing_sketches`` makes windows of months from them
without the listing-months. ``sketched_kpis`` has the columns of the exact mart.

Errors: a distinct count is off by ``host_error(lg_k)`` at most in 99 of 100 cases, relative to the
count; the rank of a median is off by ``rank_error(k)`` of the rows in as many. Both are near exact for small
groups. Rates of superhosts follow from two such counts. All other columns are exact.

Defined results: rows with a NULL group are dropped, as in the exact mart; hosts and prices that are
NULL are in no sketch; without an active price the median is NULL, without a host the superhost rate.
An empty base gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.operators.kpi import kpi_columns, measures

#: Sizes of the sketches: 2**LG_K registers, and about 3 * K values.
LG_K = 12
K = 400
SKETCHES = ("hosts", "superhosts", "prices")


def host_error(lg_k: int = LG_K) -> float:
    """Three standard errors of an HLL sketch that has seen merges."""
    return 3 * 1.04 / math.sqrt(2 ** lg_k)


def rank_error(k: int = K) -> float:
    """Bound of a KLL sketch's rank at 99 % confidence (one rank, normalised)."""
    return 2.296 / k ** 0.9021


def month_sketches(base: DataFrame, group_cols: Sequence[str], lg_k: int = LG_K, k: int = K) -> DataFrame:
    """Measures and sketches per (group, month) of a ``mart_base``; one shuffle of combined rows.

    A KLL sketch has no weights: a row stands as often as its weight says, inside its task."""
    for g in group_cols:
        base = base.filter(F.col(g).isNotNull())
    rows = base.withColumn("_w", F.explode(F.array_repeat(F.lit(1).cast("long"), F.col("_w").cast("int"))))
    priced = F.col("is_active") & F.col("price").isNotNull()
    return rows.groupBy(*group_cols, "month_start").agg(
        *(F.sum(c).alias(name) for name, c in measures().items()),
        F.min(F.when(priced, F.col("price"))).alias("_min"),
        F.max(F.when(priced, F.col("price"))).alias("_max"),
        F.hll_sketch_agg("host_id", lg_k).alias("hosts"),
        F.hll_sketch_agg(F.when(F.col("_sh"), F.col("host_id")), lg_k).alias("superhosts"),
        F.kll_sketch_agg_double(F.when(priced, F.col("price").cast("double")), k).alias("prices"))


def trailing_sketches(sketches: DataFrame, group_cols: Sequence[str], n: int = 12) -> DataFrame:
    """Rows of ``month_sketches`` merged over the ``n`` months that end at each month a group has.

    A row goes to ``n`` months, so this shuffles at most ``n`` sketches per (group, month), however
    many listings these stand for."""
    spread = sketches.withColumn("_ahead", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    spread = spread.withColumn("month_start", F.add_months("month_start", F.col("_ahead")))
    merged = spread.groupBy(*group_cols, "month_start").agg(
        *(F.sum(name).alias(name) for name in measures()),
        F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        F.hll_union_agg("hosts").alias("hosts"), F.hll_union_agg("superhosts").alias("superhosts"),
        F.kll_merge_agg_double("prices").alias("prices"),
        F.min("_ahead").alias("_nearest"))
    return merged.filter(F.col("_nearest") == 0).drop("_nearest")


def median_of(sketch: Column) -> Column:
    """The middle value of a KLL sketch; NULL if it is empty."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(0.5)))


def sketched_kpis(sketches: DataFrame, group_cols: Sequence[str], extra: bool = False) -> DataFrame:
    """The mart's columns from ``month_sketches`` or ``trailing_sketches``."""
    return kpi_columns(sketches.withColumns({
        "distinct_hosts": F.hll_sketch_estimate("hosts"),
        "distinct_superhosts": F.hll_sketch_estimate("superhosts"),
        "median_price_active": median_of(F.col("prices")),
    }), group_cols, extra)


def rank_distance(rows: DataFrame, estimates: DataFrame, keys: Sequence[str], value: str, weight: str,
                  estimate: str) -> DataFrame:
    """(keys, ``distance``): how far the estimate's rank is from the middle of the group's rows, as a share
    of their weight; 0 where the estimate's equals reach over the middle. For audits: it reads ``rows``."""
    at, v, w = F.col(estimate), F.col(value).cast("double"), F.col(weight)
    found = (rows.join(estimates.select(*keys, estimate), list(keys)).groupBy(*keys)
             .agg(F.sum(F.when(v < at, w).otherwise(0)).alias("_below"), F.sum(F.when(v <= at, w).otherwise(0)).alias("_upto"),
                  F.sum(w).alias("_n")))
    low, high = F.col("_below") / F.col("_n"), F.col("_upto") / F.col("_n")
    return found.select(*keys, F.greatest(low - 0.5, 0.5 - high, F.lit(0.0)).alias("distance"))
