"""Ranking, dedup and share helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgeflow.functions import asc_pg, desc_pg, ratio


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order_by`` (``row_number() = 1``)."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def top1_per_group(df: DataFrame, group_cols: Sequence[str],
                   order_by: Sequence[Column]) -> DataFrame:
    """Best row per group with explicit tie-breaks."""
    return dedupe(df, group_cols, order_by)


def mode_per_group(df: DataFrame, group_cols: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per group; ties go to the smallest value.

    Pre-aggregates (group, value) counts, then picks with ``min_by`` over
    ``(-count, value)``: two aggregations with map-side combine, no window.
    """
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*group_cols, value).agg(F.count(F.lit(1)).alias("_n")))
    return counts.groupBy(*group_cols).agg(
        F.min_by(F.col(value), F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
        .alias(value))


def top_bottom(df: DataFrame, metric: str, k: int = 3, top_label: str = "TOP3",
               bottom_label: str = "BOT3") -> DataFrame:
    """Rows ranked within the top ``k`` (DESC, NULLs first) and the
    bottom ``k`` (ASC, NULLs last), ties kept, stacked with a ``band`` label.

    The window has no partition key, so it must only ever see an
    already-aggregated frame (one row per area).
    """
    ranked = (df.withColumn("_r_desc", F.rank().over(Window.orderBy(desc_pg(metric))))
              .withColumn("_r_asc", F.rank().over(Window.orderBy(asc_pg(metric)))))
    top = ranked.filter(F.col("_r_desc") <= k).withColumn("band", F.lit(top_label))
    bottom = ranked.filter(F.col("_r_asc") <= k).withColumn("band", F.lit(bottom_label))
    return top.unionByName(bottom).drop("_r_desc", "_r_asc")


def share_of_total(df: DataFrame, count_col: str, out: str, scale: int = 2) -> DataFrame:
    """``round(100 * n / sum(n) over (), scale)`` on an aggregated frame."""
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn(out, F.round(ratio(F.col(count_col) * F.lit(100), total), scale))


def pct_where(df: DataFrame, group_cols: Sequence[str], cond: Column, n_out: str,
              hit_out: str, pct_out: str, scale: int = 2) -> DataFrame:
    """Per group, row count, count where ``cond``, and the rounded percentage."""
    agg = df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias(n_out),
        F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(hit_out))
    return agg.withColumn(pct_out, F.round(ratio(F.col(hit_out) * F.lit(100), F.col(n_out)),
                                           scale))
