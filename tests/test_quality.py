"""Data-quality checks (V1-V6, relationships, freshness)."""

import datetime as dt

from lodgeflow.operators.quality import (
    check_freshness,
    check_not_null,
    check_reference,
    check_schema,
    check_tables_exist,
    check_unique,
    sample_values,
)


def test_checks(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", dt.date(2020, 5, 1)), (1, None, dt.date(2020, 3, 1)),
                                (2, "b", None)], "k long, v string, d date")
    assert sorted(tuple(r) for r in check_not_null(df, ["k", "v", "d"]).collect()) == [
        ("d", 1), ("v", 1)]
    assert [tuple(r) for r in check_unique(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(1,)], "k long")
    assert [r.k for r in check_reference(df, parent, "k", "k").collect()] == [2]
    fresh = {r.v: (r.age_days, r.is_stale) for r in
             check_freshness(df.filter("v is not null"), "d", ["v"], 31).collect()}
    assert fresh == {"a": (0, False), "b": (None, None)}
    bad = check_schema(spark, df, {"k": "bigint", "v": "int", "x": "string"}).collect()
    assert sorted(r.column_name for r in bad) == ["v", "x"]
    assert check_tables_exist(spark, [tmpdir_path + "/missing"]) == [tmpdir_path + "/missing"]
    assert sorted(sample_values(df, "v")) == ["a", "b"]
