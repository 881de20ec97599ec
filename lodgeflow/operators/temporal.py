"""Month-level temporal operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _date(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v if isinstance(v, dt.date) else dt.date.fromisoformat(str(v)))


def _add_months(d: dt.date, k: int) -> dt.date:
    m = d.year * 12 + d.month - 1 + k
    return dt.date(m // 12, m % 12 + 1, 1)


def overlapping(versions: DataFrame, lo, hi, from_col: str = "valid_from_month",
                to_col: str = "valid_to_month") -> DataFrame:
    """Versions whose month validity overlaps ``[lo, hi]`` (month starts).

    When the raw validity timestamps are present, a superset condition on them
    (true for either month-boundary rule) is added first: it is a plain column
    comparison with literals, so it reaches the parquet scan and skips old
    closed versions before any shuffle.
    """
    lo_d = lo if isinstance(lo, dt.date) else dt.date.fromisoformat(str(lo))
    hi_d = hi if isinstance(hi, dt.date) else dt.date.fromisoformat(str(hi))
    out = versions
    if "dbt_valid_from" in versions.columns and "dbt_valid_to" in versions.columns:
        def ntz(d: dt.date) -> Column:       # zone-free literal, like the columns
            return F.lit(f"{d.isoformat()} 00:00:00").cast("timestamp_ntz")
        out = out.filter(
            (F.col("dbt_valid_from") < ntz(_add_months(hi_d, 1)))
            & (F.col("dbt_valid_to").isNull()
               | (F.col("dbt_valid_to") >= ntz(_add_months(lo_d, -1)))))
    return out.filter((F.col(from_col) <= F.lit(hi_d))
                      & (F.col(to_col).isNull() | (F.col(to_col) > F.lit(lo_d))))


def trailing_bounds(df: DataFrame, month_col: str, n: int = 12):
    """``(first, last)`` month of the trailing ``n``-month window, from one
    aggregated row (a scan of the month column only); ``None`` when empty."""
    row = window_bounds(df, month_col, n).first()
    if row is None or row["_max_month"] is None:
        return None
    return row["_min_month"], row["_max_month"]


def expand_months(df: DataFrame, lo, hi, from_col: str = "valid_from_month",
                  to_col: str = "valid_to_month", out: str = "month_start") -> DataFrame:
    """One row per month a version covers, clipped to ``[lo, hi]``.

    The covered months run from the month of ``from_col`` to the month before
    ``to_col`` (exclusive end; NULL = open). Versions outside the horizon are
    filtered before the explode so the filter can reach the scan, and an empty
    range yields no rows (``sequence`` would raise on reversed bounds).
    """
    lo_c, hi_c = _date(lo), _date(hi)
    start = F.greatest(F.trunc(F.col(from_col), "month"), lo_c)
    last = F.least(F.trunc(F.date_sub(F.col(to_col), 1), "month"), hi_c)
    if isinstance(lo, Column) or isinstance(hi, Column):
        cover = df.filter((F.col(from_col) <= hi_c)
                          & (F.col(to_col).isNull() | (F.col(to_col) > lo_c)))
    else:
        cover = overlapping(df, lo, hi, from_col, to_col)
    months = F.when(start <= last, F.sequence(start, last, F.expr("interval 1 month")))
    return cover.withColumn(out, F.explode(months))


def asof_month_join(fact: DataFrame, versions: DataFrame, key: str, month_col: str,
                    from_col: str = "valid_from_month", to_col: str = "valid_to_month",
                    how: str = "inner") -> DataFrame:
    """Attach to each fact row the version(s) valid in its month.

    Equality on ``key`` plus the half-open residual ``from <= month < to`` with
    open ends; planned as a hash/sort-merge join on the key with the range as a
    residual predicate, so there is no cross product.
    """
    v = versions.withColumnRenamed(key, "_v_key")
    cond = ((fact[key] == v["_v_key"])
            & (v[from_col].isNull() | (fact[month_col] >= v[from_col]))
            & (v[to_col].isNull() | (fact[month_col] < v[to_col])))
    return fact.join(v, cond, how).drop("_v_key")


def window_bounds(df: DataFrame, month_col: str, n: int = 12) -> DataFrame:
    """One-row frame ``(_min_month, _max_month)`` of the trailing ``n``-month window."""
    return df.agg(F.max(month_col).alias("_max_month")).select(
        F.add_months(F.col("_max_month"), -(n - 1)).alias("_min_month"), "_max_month")


def last_n_months(df: DataFrame, month_col: str, n: int = 12) -> DataFrame:
    """Rows in the ``n`` months ending at the newest month (inclusive).

    The bounds are one aggregated row (a scan of the month column only)
    fetched first, so the window filter is a literal that Catalyst pushes into
    the parquet scan and, on a month-partitioned table, turns into partition
    pruning (instead of joining the one-row bounds ``ON TRUE``).
    """
    bounds = trailing_bounds(df, month_col, n)
    if bounds is None:
        return df.filter(F.lit(False))
    return df.filter(F.col(month_col).between(F.lit(bounds[0]), F.lit(bounds[1])))
