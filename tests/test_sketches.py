"""Sketched marts: near exact on small groups, within their bounds on large ones, one shuffle."""

import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from lodgeflow.operators import sketches as S
from lodgeflow.operators.kpi import kpis

BASE = ("month_start date, listing_id long, host_id long, area string, is_active boolean, stays int, price decimal(18,2), "
        "review_scores_rating double, _w long, _sh boolean")


def random_base(spark, seed=3, rows=400):
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        active = rnd.random() < 0.7
        out.append((dt.date(2020, rnd.choice([1, 2, 3, 4, 7]), 1), i, rnd.choice([None, *range(12)]), rnd.choice(["A", "B", None]), active,
                    rnd.randrange(30) if active else 0, rnd.choice([None, Decimal(rnd.randrange(1, 60))]), rnd.choice([None, 80.0, 95.0]),
                    rnd.choice([1, 1, 2]), rnd.random() < 0.3))
    return spark.createDataFrame(out, BASE)


def by_key(df):
    return {(r["area"], r["month_start"]): r for r in df.collect()}


def test_small_groups_equal_the_exact_mart(spark):
    base = random_base(spark)
    exact, got = by_key(kpis(base, ["area"], extra=True)), by_key(S.sketched_kpis(S.month_sketches(base, ["area"]), ["area"], extra=True))
    assert set(got) == set(exact) and len(got) == 10
    for key, r in got.items():
        for name, value in exact[key].asDict().items():
            if name not in ("median_price_active", "superhost_rate"):
                assert r[name] == value or abs(r[name] - value) < 1e-9, (key, name)
        # a sketch's median is one of the values, the exact one can lie between two
        assert abs(r["median_price_active"] - exact[key]["median_price_active"]) <= 6
        assert abs(r["superhost_rate"] - exact[key]["superhost_rate"]) < 1e-9


def test_trailing_windows_equal_those_over_the_rows(spark):
    base = random_base(spark, seed=4)
    got = by_key(S.sketched_kpis(S.trailing_sketches(S.month_sketches(base, ["area"]), ["area"], 3), ["area"], extra=True))
    rows = [r for r in base.collect() if r["area"]]
    assert set(got) == {(r["area"], r["month_start"]) for r in rows}
    for (area, month), r in got.items():
        inside = [x for x in rows if x["area"] == area and 0 <= month.month - x["month_start"].month <= 2]
        assert r["listings_total"] == sum(x["_w"] for x in inside)
        assert r["distinct_hosts"] == len({x["host_id"] for x in inside} - {None})
        prices = sorted(float(x["price"]) for x in inside if x["is_active"] and x["price"] is not None for _ in range(x["_w"]))
        below, upto = sum(p < r["median_price_active"] for p in prices), sum(p <= r["median_price_active"] for p in prices)
        assert below <= len(prices) * 0.5 + 1 and upto >= len(prices) * 0.5 - 1


def test_large_groups_and_outliers_stay_within_the_bounds(spark):
    rows = spark.range(60_000).select(
        F.make_date(F.lit(2020), (F.col("id") % 3 + 1).cast("int"), F.lit(1)).alias("month_start"), F.col("id").alias("listing_id"),
        (F.col("id") % 20_011).alias("host_id"), F.lit("A").alias("area"), F.lit(True).alias("is_active"), F.lit(3).alias("stays"),
        F.when(F.col("id") == 7, 10 ** 12).otherwise(F.col("id") * 7919 % 10_007 + 1).cast("decimal(18,2)").alias("price"),
        F.lit(None).cast("double").alias("review_scores_rating"), F.lit(1).cast("long").alias("_w"), F.lit(False).alias("_sh"))
    merged = S.trailing_sketches(S.month_sketches(rows, ["area"]), ["area"], 3)
    got = by_key(S.sketched_kpis(merged, ["area"]))[("A", dt.date(2020, 3, 1))]
    assert abs(got["distinct_hosts"] - 20_011) <= 20_011 * S.host_error()
    at = S.rank_distance(rows.withColumn("month_start", F.lit(dt.date(2020, 3, 1))),
                         S.sketched_kpis(merged, ["area"]).filter("month_start = date'2020-03-01'"), ["area", "month_start"], "price", "_w",
                         "median_price_active").first()
    assert at["distance"] <= 1.5 * S.rank_error()
    assert merged.select(F.max(F.length("prices"))).first()[0] < 40_000   # 60,000 values


def test_no_price_no_host_no_rows(spark):
    row = (dt.date(2020, 1, 1), 1, None, "A", True, 3, None, None, 1, False)
    got = S.sketched_kpis(S.month_sketches(spark.createDataFrame([row], BASE), ["area"]), ["area"]).first()
    assert got["distinct_hosts"] == 0 and got["superhost_rate"] is None and got["median_price_active"] is None
    empty = S.month_sketches(spark.createDataFrame([], BASE), ["area"])
    assert S.sketched_kpis(S.trailing_sketches(empty, ["area"]), ["area"]).count() == 0


def test_months_are_sketched_in_one_shuffle(spark):
    plan = S.month_sketches(random_base(spark), ["area"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
