"""Data-quality checks (V1-V6, relationships, freshness). Each returns a
DataFrame of violations (empty = pass); all are single aggregations or
anti joins with map-side combine, so they scale with the checked table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V1: ``(column_name, null_rows)`` for every column that has NULLs; one pass."""
    counts = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long").alias(c)
                      for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (counts.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_rows)")
            .filter(F.col("null_rows") > 0))


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """V2/V3: key values that occur more than once, with their count."""
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def check_schema(spark: SparkSession, df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """V4: columns whose type differs from ``expected`` (or that are missing)."""
    actual = dict(df.dtypes)
    bad = [(c, t, actual.get(c)) for c, t in expected.items() if actual.get(c) != t]
    schema = T.StructType([T.StructField("column_name", T.StringType()),
                           T.StructField("expected", T.StringType()),
                           T.StructField("actual", T.StringType())])
    return spark.createDataFrame(bad, schema)


def check_tables_exist(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """V5: names of required tables that are missing."""
    from lodgeflow.sources.sinks import table_exists
    return [n for n in names if not table_exists(spark, n)]


def sample_values(df: DataFrame, col: str, n: int = 5) -> list:
    """V6: a few non-blank parsed values for the load report."""
    return [r[0] for r in df.filter(F.col(col).isNotNull() & (F.col(col).cast("string") != ""))
            .select(col).limit(n).collect()]


def check_reference(child: DataFrame, parent: DataFrame, child_key: Column | str,
                    parent_key: str) -> DataFrame:
    """Relationship test: child rows whose key has no parent (left-anti join)."""
    ck = F.col(child_key) if isinstance(child_key, str) else child_key
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, ck == p["_pk"], "left_anti")


def check_freshness(df: DataFrame, date_col: str, group_cols: Sequence[str],
                    max_age_days: int) -> DataFrame:
    """Source freshness: newest date per group, its age against the newest date
    overall, and whether it is older than ``max_age_days``."""
    per = df.groupBy(*group_cols).agg(F.max(date_col).alias("newest_date"))
    # the table is scanned once: the newest date overall is that of the groups' rows
    as_of = F.max("newest_date").over(Window.partitionBy())
    age = F.datediff(as_of, F.col("newest_date"))
    return per.withColumns({"age_days": age, "is_stale": age > F.lit(max_age_days)})
