"""Plan shape of every registered query, the entry contract, and pushdown."""

import pytest

import __spark_entry__ as E
from lodgeflow.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: physical(fn(spark, SF)) for name, fn in QUERIES.items()}


def test_every_query_has_an_oracle_or_is_documented():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def test_no_cartesian_product_or_python_udf(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:4] == ["listing_neighbourhood", "month_start", "year", "month"]


def test_trailing_window_prunes_columns(spark):
    df = E.queries()["trailing_window"](spark, SF)
    plan = physical(df)
    assert "ReadSchema: struct<listing_id:bigint,host_id:bigint,stays:int>" in plan
    assert "PartitionFilters: [isnotnull(month_date" in plan


def test_no_group_buffer_in_a_mart(plans):
    for name in ("kpi_neighbourhood_half_open", "kpi_property_type", "filtered_aggs"):
        assert "percentile" not in plans[name], name
