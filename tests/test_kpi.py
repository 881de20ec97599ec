"""KPI marts: hand-computed cases and equality with plain Python."""

import datetime as dt
import random
import statistics
from decimal import Decimal

from pyspark.sql import functions as F

from lodgeflow.functions import desc_pg
from lodgeflow.operators.kpi import _bin_of, exact_median, monthly_kpis

D = dt.date
LM = ("month_start date, listing_id long, host_id long, listing_neighbourhood string, "
      "is_active boolean, stays int, price decimal(18,2), review_scores_rating double")
HM = "month_start date, host_id long, host_neighbourhood string, is_superhost boolean"


def lm_row(m, lid, host, area, active, price=Decimal("100.00"), rating=None):
    return (D(2020, m, 1), lid, host, area, active, 10 if active else 0, price, rating)


def test_pct_change_uses_previous_present_month(spark):
    rows = ([lm_row(5, i, i, "A", True) for i in range(4)]
            + [lm_row(7, i, i, "A", True) for i in range(6)])
    lm = spark.createDataFrame(rows, LM)
    hm = spark.createDataFrame([], HM)
    out = {r.month_start.month: r for r in
           monthly_kpis(lm, hm, ["listing_neighbourhood"]).collect()}
    assert set(out) == {5, 7}
    assert out[7].pct_change_active == 0.5 and out[5].pct_change_active is None


def test_zero_active_and_null_group(spark):
    rows = [lm_row(5, 1, 1, "A", False), lm_row(5, 2, 2, "A", False),
            lm_row(5, 3, 3, "B", True), lm_row(5, 4, 4, None, True)]
    out = monthly_kpis(spark.createDataFrame(rows, LM), spark.createDataFrame([], HM),
                       ["listing_neighbourhood"])
    got = {r.listing_neighbourhood: r for r in out.collect()}
    assert set(got) == {"A", "B"}                       # K14: NULL group absent
    assert got["A"].avg_est_rev_per_active is None      # zero active -> NULL
    assert got["A"].active_listings_rate == 0.0
    first = out.orderBy(desc_pg("avg_est_rev_per_active")).first()
    assert first.listing_neighbourhood == "A"           # K10: NULL first under DESC


def test_superhost_rate_counts_distinct_hosts(spark):
    rows = [lm_row(5, 1, 9, "A", True), lm_row(5, 2, 9, "A", True), lm_row(5, 3, 8, "A", True)]
    hm = [(D(2020, 5, 1), 9, "X", True), (D(2020, 5, 1), 8, "X", False)]
    r = monthly_kpis(spark.createDataFrame(rows, LM), spark.createDataFrame(hm, HM),
                     ["listing_neighbourhood"]).first()
    assert r.distinct_hosts == 2 and r.superhost_rate == 0.5   # K7


def _random_frames(spark, seed):
    rnd = random.Random(seed)
    lm, hm = [], []
    for lid in range(60):
        host = lid % 7
        for m in rnd.sample(range(5, 13), rnd.randint(1, 6)):
            act = rnd.random() < 0.7
            price = None if rnd.random() < 0.2 else Decimal(rnd.randint(1, 500))
            lm.append((D(2020, m, 1), lid, host, rnd.choice(["A", "B", "C", None]), act,
                       rnd.randint(0, 30) if act else 0, price,
                       None if rnd.random() < 0.3 else float(rnd.randint(0, 100))))
    for host in range(6):          # host 6 never appears: left vs inner join differ
        for m in range(5, 13):
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):   # fan-out rows (K1)
                hm.append((D(2020, m, 1), host, rnd.choice(["X", "Y"]),
                           rnd.choice([True, False, None])))
    return spark.createDataFrame(lm, LM), spark.createDataFrame(hm, HM)


def plain(lm, hm, group, how):
    """The mart in plain Python: {(group, month): (hosts, superhosts, median, revenue, stays)}."""
    out = {}
    for x in lm:
        hosts = [h for h in hm if h.host_id == x.host_id and h.month_start == x.month_start and x.host_id is not None]
        for h in hosts or ([None] if how == "left" else []):
            key = x[group] if group in x else h[group]
            if key is not None:
                out.setdefault((key, x.month_start), []).append((x, h))
    return {k: figures(pairs) for k, pairs in out.items()}


def figures(pairs):
    known = {x.host_id for x, _ in pairs if x.host_id is not None}
    supers = {x.host_id for x, h in pairs if h is not None and h.is_superhost and x.host_id is not None}
    prices = [float(x.price) for x, _ in pairs if x.is_active and x.price is not None]
    active = sum(x.is_active for x, _ in pairs)
    revenue = sum(x.stays * (x.price or 0) for x, _ in pairs)
    return (len(known), len(supers), statistics.median(prices) if prices else None,
            round(float(revenue) / active, 6) if active else None, sum(x.stays for x, _ in pairs))


def measured(df, group):
    return {(r[group], r.month_start): (
        r.distinct_hosts, round((r.superhost_rate or 0) * r.distinct_hosts), r.median_price_active,
        None if r.avg_est_rev_per_active is None else round(float(r.avg_est_rev_per_active), 6), r.total_stays)
        for r in df.collect()}


def test_mart_equals_plain_python(spark):
    for seed, (group, side, how) in enumerate([("listing_neighbourhood", "lm", "left"),
                                                ("host_neighbourhood", "hm", "inner")]):
        lm, hm = _random_frames(spark, seed)
        got = monthly_kpis(lm, hm if side == "hm" else hm.drop("host_neighbourhood"), [group], how=how)
        assert measured(got, group) == plain(lm.collect(), hm.collect(), group, how)


def test_listing_without_host_is_no_host(spark):
    lm = spark.createDataFrame([lm_row(5, 1, 1, "A", True), lm_row(5, 2, None, "A", True)], LM)
    hm = spark.createDataFrame([(D(2020, 5, 1), 1, "X", True)], HM)
    r = monthly_kpis(lm, hm.drop("host_neighbourhood"), ["listing_neighbourhood"], extra=True).first()
    assert (r.distinct_hosts, r.superhost_rate, r.listings_total) == (1, 1.0, 2)


def test_median_by_counting(spark):
    rnd = random.Random(9)
    rows = [(g, Decimal(rnd.choice([v, rnd.randint(1, 10**6)])) / 100, rnd.randint(1, 4))
            for g, v in (("a", 5), ("b", 7777), ("c", 1)) for _ in range(301)] + [("one", Decimal("3.50"), 2)]
    df = spark.createDataFrame(rows, "g string, v decimal(18,2), w int")
    for bits, rounds in ((1, 1), (3, 1), (8, 1), (2, 2), (2, 3)):
        got = {r.g: (float(r._min), r.m, float(r._max)) for r in exact_median(df, ["g"], "v", "w", "m", bits, rounds).collect()}
        for g in got:
            values = [float(v) for k, v, w in rows if k == g for _ in range(w)]
            assert got[g] == (min(values), statistics.median(values), max(values))


def test_median_beside_an_outlier(spark):
    """Bins follow the values: one price far out leaves them even, and no bin has 1 % of the group."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), (F.col("id") * 37 % 20_011).cast("decimal(18,2)").alias("v"), F.lit(1).alias("w"))
    df = df.unionByName(spark.createDataFrame([("g", Decimal(10) ** 13, 1)], "g string, v decimal(18,2), w int"))
    edges = df.groupBy("g").agg(F.percentile_approx("v", [i / 256 for i in range(1, 256)], 1024).alias("e"))
    binned = df.join(edges, "g").groupBy(_bin_of(F.col("e"), F.col("v"), 8).alias("b")).count()
    assert binned.agg(F.max("count")).first()[0] < 200 and binned.count() > 200
    values = [float(r.v) for r in df.collect()]
    assert exact_median(df, ["g"], "v", "w", "m").first().m == statistics.median(values)
    plain = [sum(e < v for e in (1, 3, 3, 7)) for v in (0, 1, 2, 3, 5, 7, 9)]
    got = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 5, 7, 9)], "v int").select(
        _bin_of(F.array(*map(F.lit, (1, 3, 3, 7))), F.col("v"), 3).alias("b"))
    assert [r.b for r in got.collect()] == plain


def test_hot_host_holding_half_of_all_rows(spark):
    """A host owning half the listings, with several versions in one month (fan-out)."""
    rows, hm = [], []
    for lid in range(400):
        host = 1 if lid % 2 == 0 else lid            # host 1 holds half of all rows
        for m in (5, 6):
            rows.append((D(2020, m, 1), lid, host, "A" if lid % 3 else "B", lid % 4 != 0,
                         lid % 30, Decimal(lid % 50 + 1), float(lid % 10)))
    for m in (5, 6):
        for v in range(3 if m == 6 else 1):          # three host-1 versions in June
            hm.append((D(2020, m, 1), 1, "X", v == 2))
    lm_df = spark.createDataFrame(rows, LM)
    hm_df = spark.createDataFrame(hm, HM)
    got = monthly_kpis(lm_df, hm_df.drop("host_neighbourhood"), ["listing_neighbourhood"])
    assert measured(got, "listing_neighbourhood") == plain(lm_df.collect(), hm_df.collect(), "listing_neighbourhood", "left")


def test_half_open_counts_each_listing_month_once(spark):
    """SURVEY §5 property: under half_open, sum(listings_total) = (listing, month) pairs."""
    from pyspark.sql import functions as F

    from lodgeflow.plans.context import Domain
    d = Domain.of(spark, "/root/testdata/sf0.001", boundary="half_open")
    lo, hi = d.horizon
    total = d.mart("neighbourhood", extra=True).agg(F.sum("listings_total")).first()[0]
    first = d.obs.groupBy("listing_id").agg(F.min(F.trunc("scraped_date", "month")).alias("f"))
    start = F.greatest(F.col("f"), F.lit(lo))
    months = F.when(start <= F.lit(hi), F.months_between(F.lit(hi), start).cast("int") + 1)
    expected = first.agg(F.sum(months)).first()[0]
    assert total == expected and total > 0
