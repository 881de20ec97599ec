"""Ordered-path name lookup.

The reference resolves an area name to an LGA through three left joins tried
in order (direct LGA name, suburb -> LGA, staged suburb -> LGA) and keeps the
first hit. Here the paths are first folded into one small table keyed by the
normalised name (one row per name, the first path that knows it), and the
fact side is joined once. How that join runs is left to the byte threshold
and to AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def name_key(c: Column) -> Column:
    """Join key ``lower(trim(name))``."""
    return F.lower(F.trim(c))


def lga_name_lookup(dim_lga: DataFrame, suburb_paths: Sequence[DataFrame]) -> DataFrame:
    """Fold the lookup paths into ``(name_key, lga_code, lga_name)``, one row per name.

    Path 1 matches LGA names directly; each frame of ``suburb_paths`` holds
    ``(suburb_name, lga_name)`` and resolves through ``dim_lga`` on the exact
    LGA name (D8). Code and name are each the first non-NULL value by path
    order, as ``COALESCE`` over the path joins would give. Duplicate names
    inside one path are collapsed instead of fanning out (K8).
    """
    lga = dim_lga.select("lga_code", "lga_name")
    paths = [lga.select(name_key(F.col("lga_name")).alias("name_key"), "lga_code",
                        "lga_name", F.lit(1).alias("_prio"))]
    for i, sub in enumerate(suburb_paths, start=2):
        s = sub.select(F.col("suburb_name"), F.col("lga_name").alias("_s_lga"))
        paths.append(s.join(lga, s["_s_lga"] == lga["lga_name"]).select(
            name_key(F.col("suburb_name")).alias("name_key"), "lga_code", "lga_name",
            F.lit(i).alias("_prio")))
    allp = paths[0]
    for p in paths[1:]:
        allp = allp.unionByName(p)
    allp = allp.filter(F.col("name_key").isNotNull())
    return allp.groupBy("name_key").agg(
        F.min_by("lga_code", F.when(F.col("lga_code").isNotNull(), F.col("_prio")))
        .alias("lga_code"),
        F.min_by("lga_name", F.when(F.col("lga_name").isNotNull(), F.col("_prio")))
        .alias("lga_name"))


def resolve_lookup(df: DataFrame, name_col: str, lookup: DataFrame,
                   code_alias: str = "LGA_CODE_2016",
                   name_alias: str | None = "lga_name") -> DataFrame:
    """Left-join ``df`` to the folded lookup on ``lower(trim(name_col))``."""
    lk = lookup.select(F.col("name_key").alias("_lk_key"),
                       F.col("lga_code").alias(code_alias),
                       *([F.col("lga_name").alias(name_alias)] if name_alias else []))
    out = df.join(lk, name_key(df[name_col]) == lk["_lk_key"], "left")
    return out.drop("_lk_key")
