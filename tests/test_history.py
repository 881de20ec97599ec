"""SCD2 history, month validity and expansion."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from lodgeflow.operators.history import (
    month_validity,
    scd2_apply,
    scd2_check,
    scd2_timestamp,
)
from lodgeflow.operators.temporal import asof_month_join, expand_months, last_n_months

D = dt.date
LO, HI = D(2020, 5, 1), D(2021, 4, 1)


def months_of(df):
    return sorted((r.listing_id, str(r.dbt_valid_from)[:10], r.month_start.isoformat())
                  for r in df.collect())


def test_overlap_and_half_open(spark):
    hist = spark.createDataFrame([(1, D(2020, 5, 10), 1), (1, D(2020, 6, 12), 2)],
                                 "listing_id long, scraped_date date, v int")
    versions = scd2_timestamp(hist, "listing_id", "scraped_date")
    over = expand_months(month_validity(versions, boundary="overlap"), LO, HI)
    half = expand_months(month_validity(versions, boundary="half_open"), LO, HI)
    ov = months_of(over)
    assert [m for _, f, m in ov if f == "2020-05-10"] == ["2020-05-01", "2020-06-01"]
    assert [m for _, f, m in ov if f == "2020-06-12"][0] == "2020-06-01"
    assert len([m for _, f, m in ov if f == "2020-06-12"]) == 11
    hv = months_of(half)
    assert [m for _, f, m in hv if f == "2020-05-10"] == ["2020-05-01"]
    # under half_open every month is covered exactly once
    assert len(hv) == len({m for _, _, m in hv}) == 12


def test_empty_range_yields_no_rows(spark):
    # K4: a version inside one month under half_open has an empty range
    hist = spark.createDataFrame([(1, D(2020, 6, 12)), (1, D(2020, 6, 20))],
                                 "listing_id long, scraped_date date")
    v = month_validity(scd2_timestamp(hist, "listing_id", "scraped_date"), boundary="half_open")
    got = months_of(expand_months(v, LO, HI))
    assert [f for _, f, _ in got].count("2020-06-12") == 0
    assert len(got) == 11


def test_open_end_is_null_not_year_10000(spark):
    hist = spark.createDataFrame([(1, D(2020, 5, 10))], "listing_id long, scraped_date date")
    r = month_validity(scd2_timestamp(hist, "listing_id", "scraped_date")).collect()[0]
    assert r.valid_to_month is None and r.is_current is True
    assert r.valid_from_month == D(2020, 5, 1)


def test_check_strategy(spark):
    rows = [(7, D(2020, 5, 1), "A"), (7, D(2020, 6, 1), "A"), (7, D(2020, 7, 1), "B"),
            (7, D(2020, 8, 1), "A")]
    hist = spark.createDataFrame(rows, "host_id long, scraped_date date, area string")
    got = sorted((str(r.dbt_valid_from)[:10], r.area, str(r.dbt_valid_to)[:10])
                 for r in scd2_check(hist, "host_id", "scraped_date", ["area"]).collect())
    assert got == [("2020-05-01", "A", "2020-07-01"), ("2020-07-01", "B", "2020-08-01"),
                   ("2020-08-01", "A", "None")]


def test_check_strategy_null_safe(spark):
    rows = [(1, D(2020, 5, 1), None), (1, D(2020, 6, 1), None), (1, D(2020, 7, 1), "X")]
    hist = spark.createDataFrame(rows, "host_id long, scraped_date date, area string")
    assert scd2_check(hist, "host_id", "scraped_date", ["area"]).count() == 2


def _random_history(spark, seed=7, keys=30, days=120):
    rnd = random.Random(seed)
    rows = []
    for k in range(keys):
        for d in sorted(rnd.sample(range(days), rnd.randint(1, 12))):
            rows.append((k, D(2020, 1, 1) + dt.timedelta(days=d), rnd.choice(["A", "B", None]),
                         rnd.random() < 0.3))
    return spark.createDataFrame(rows, "k long, ts date, a string, b boolean")


def _canon(df):
    return sorted((r.k, str(r.ts), r.a, r.b, str(r.dbt_valid_from), str(r.dbt_valid_to))
                  for r in df.collect())


def test_closed_form_equals_iterated_apply(spark):
    """K2: applying the history month by month gives the closed form."""
    hist = _random_history(spark)
    for check in (None, ["a", "b"]):
        closed = (scd2_check(hist, "k", "ts", check) if check
                  else scd2_timestamp(hist, "k", "ts"))
        snap = None
        for m in range(1, 6):
            lo, hi = D(2020, m, 1), D(2020, m + 1, 1)
            batch = hist.filter((F.col("ts") >= lo) & (F.col("ts") < hi))
            snap = scd2_apply(snap, batch, "k", "ts", check).checkpoint()
        assert _canon(snap) == _canon(closed)


def test_apply_ignores_stale_rows_and_closes_missing(spark):
    cur = scd2_timestamp(spark.createDataFrame(
        [(1, D(2020, 5, 1), "A"), (2, D(2020, 5, 2), "B")], "k long, ts date, a string"),
        "k", "ts")
    batch = spark.createDataFrame([(1, D(2020, 4, 1), "Z"), (1, D(2020, 6, 1), "C")],
                                  "k long, ts date, a string")
    out = scd2_apply(cur, batch, "k", "ts", close_missing=True)
    got = sorted((r.k, str(r.ts), r.a, str(r.dbt_valid_to)[:10]) for r in out.collect())
    assert got == [(1, "2020-05-01", "A", "2020-06-01"), (1, "2020-06-01", "C", "None"),
                   (2, "2020-05-02", "B", "2020-06-01")]


def test_asof_join_and_trailing_window(spark):
    hist = spark.createDataFrame([(1, D(2020, 5, 10), "X"), (1, D(2020, 6, 12), "Y")],
                                 "listing_id long, scraped_date date, tag string")
    v = month_validity(scd2_timestamp(hist, "listing_id", "scraped_date"))
    fact = spark.createDataFrame([(1, D(2020, m, 1)) for m in range(4, 9)],
                                 "listing_id long, month_date date")
    got = sorted((r.month_date.month, r.tag) for r in
                 asof_month_join(fact, v, "listing_id", "month_date").collect())
    # K1: June matches both versions; April precedes every version
    assert got == [(5, "X"), (6, "X"), (6, "Y"), (7, "Y"), (8, "Y")]
    last3 = last_n_months(fact, "month_date", 3)
    assert sorted(r.month_date.month for r in last3.collect()) == [6, 7, 8]


def test_overlap_filter_reaches_the_scan(spark):
    import tempfile
    from lodgeflow.operators.temporal import overlapping
    hist = spark.createDataFrame([(1, D(2019, 1, 5)), (1, D(2020, 6, 1)), (2, D(2020, 7, 1))],
                                 "listing_id long, scraped_date date")
    path = tempfile.mkdtemp(prefix="lodgeflow-test-") + "/v"
    month_validity(scd2_timestamp(hist, "listing_id", "scraped_date")).write.parquet(path)
    v = overlapping(spark.read.parquet(path), D(2020, 5, 1), D(2020, 8, 1))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # untruncated filters
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(dbt_valid_from" in plan and "GreaterThanOrEqual(dbt_valid_to" in plan
    assert sorted(str(r.dbt_valid_from)[:10] for r in v.collect()) == ["2019-01-05",
                                                                      "2020-06-01",
                                                                      "2020-07-01"]


@pytest.mark.parametrize("partitions", ["4", "8", "200"])
@pytest.mark.parametrize("check", [["a"], None])
def test_apply_on_a_lazy_snapshot(spark, partitions, check):
    """No checkpoint between the steps: the plan of the current snapshot is part of the apply."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        hist = spark.createDataFrame([(k, D(2020, 5, 1), "x") for k in range(6)], "k long, ts date, a string")
        batch = spark.createDataFrame([(k, D(2020, 6, 1), "y") for k in range(3)], "k long, ts date, a string")
        current = scd2_check(hist, "k", "ts", check) if check else scd2_timestamp(hist, "k", "ts")
        for close in (False, True):
            got = scd2_apply(current, batch, "k", "ts", check, close_missing=close).collect()
            still = {r.k: r.a for r in got if r.dbt_valid_to is None}
            want = {0: "y", 1: "y", 2: "y"} | ({} if close else {3: "x", 4: "x", 5: "x"})
            assert still == want and len(got) == 9
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_replay_does_not_reopen_a_deleted_key(spark):
    kind = "k long, ts date, a string"
    may = spark.createDataFrame([(1, D(2020, 5, 1), "x"), (2, D(2020, 5, 1), "x")], kind)
    june = spark.createDataFrame([(1, D(2020, 6, 1), "x")], kind)
    july = spark.createDataFrame([(2, D(2020, 7, 1), "z")], kind)
    snap = scd2_apply(None, may, "k", "ts", ["a"])
    snap = scd2_apply(snap, june, "k", "ts", ["a"], close_missing=True)
    want = sorted((r.k, r.a, str(r.dbt_valid_to)[:10]) for r in snap.collect())
    assert want == [(1, "x", "None"), (2, "x", "2020-06-01")]
    again = scd2_apply(snap, may, "k", "ts", ["a"])
    assert sorted((r.k, r.a, str(r.dbt_valid_to)[:10]) for r in again.collect()) == want
    back = scd2_apply(again, july, "k", "ts", ["a"])      # a key may come back later
    assert {(r.k, r.a) for r in back.collect() if r.dbt_valid_to is None} == {(1, "x"), (2, "z")}


@pytest.mark.parametrize("unit", ["year", "month", "day"])
def test_slices_change_nothing(spark, unit):
    """Half of the rows are one key's; gaps of several slices, nulls in check columns, slices without
    a change, null keys and times."""
    rng = random.Random(5)
    rows = {(0, dt.date(2019, 1, 1) + dt.timedelta(days=3 * d)) for d in range(300)}
    rows |= {(rng.randrange(1, 40), dt.date(2019, 1, 1) + dt.timedelta(days=rng.randrange(1500))) for _ in range(300)}
    data = [(k, d, rng.choice(["a", "a", "b", None]), rng.choice([1, 1, None]), d.day) for k, d in sorted(rows)]
    data += [(None, dt.date(2020, 1, 1), "a", 1, 0), (3, None, "a", 1, 0)]
    df = spark.createDataFrame(data, "k int, at date, v string, n int, x int")
    for build in (lambda s: scd2_timestamp(df, "k", "at", s), lambda s: scd2_check(df, "k", "at", ["v", "n"], s)):
        plain, sliced = build(None), build(unit)
        assert sliced.columns == plain.columns
        assert sorted(map(str, sliced.collect())) == sorted(map(str, plain.collect()))
        assert build(unit).limit(0).count() == 0
    empty = df.limit(0)
    assert scd2_check(empty, "k", "at", ["v", "n"], unit).count() == 0


def test_slices_split_a_hot_key(spark):
    """Of the rows that a window sorts as one group, none is over a slice's."""
    df = spark.range(20000).select(F.lit(7).alias("k"), F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, id)").alias("at"),
                                   (F.col("id") % 3).alias("v"))
    plan = scd2_check(df, "k", "at", ["v"], "day")._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line and "row_number" in line]
    assert windows and all("_slice" in line for line in windows)
    out = scd2_check(df, "k", "at", ["v"], "day")
    assert out.count() == 20000 and out.filter("dbt_valid_to is null").count() == 1
