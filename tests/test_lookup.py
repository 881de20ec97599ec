"""Ordered-path lookup (D13), ranking helpers and modes."""

from lodgeflow.operators.lookup import lga_name_lookup, resolve_lookup
from lodgeflow.operators.ranking import mode_per_group, share_of_total, top_bottom


def test_lookup_paths(spark):
    lga = spark.createDataFrame([("10050", "SYDNEY"), ("10100", "RANDWICK")],
                                "lga_code string, lga_name string")
    sub = spark.createDataFrame([("BONDI", "RANDWICK"), ("BONDI", "RANDWICK")],
                                "suburb_name string, lga_name string")
    lk = lga_name_lookup(lga, [sub, sub])
    df = spark.createDataFrame([(1, " Sydney "), (2, "bondi"), (3, "nowhere")],
                               "id int, area string")
    got = sorted((r.id, r.LGA_CODE_2016, r.lga_name) for r in
                 resolve_lookup(df, "area", lk).collect())
    # direct name, suburb path, no match; duplicate suburb rows do not fan out (K8)
    assert got == [(1, "10050", "SYDNEY"), (2, "10100", "RANDWICK"), (3, None, None)]


def test_lookup_prefers_direct_name(spark):
    lga = spark.createDataFrame([("1", "MANLY"), ("2", "WARRINGAH")],
                                "lga_code string, lga_name string")
    sub = spark.createDataFrame([("MANLY", "WARRINGAH")], "suburb_name string, lga_name string")
    lk = lga_name_lookup(lga, [sub])
    got = resolve_lookup(spark.createDataFrame([("manly",)], "area string"), "area", lk).first()
    assert got.LGA_CODE_2016 == "1"


def test_mode_tie_goes_to_smaller_code(spark):
    df = spark.createDataFrame([(1, "20"), (1, "10"), (2, "30"), (2, "30"), (2, "05"),
                                (3, None)], "host long, code string")
    got = sorted(tuple(r) for r in mode_per_group(df, ["host"], "code").collect())
    assert got == [(1, "10"), (2, "30")]


def test_top_bottom_ties_and_overlap(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 3.0), ("c", 2.0), ("d", 1.0), ("e", None)],
                               "k string, v double")
    got = sorted((r.band, r.k) for r in top_bottom(df, "v", k=1).collect())
    # DESC NULLS FIRST puts e on top; ASC NULLS LAST puts d at the bottom
    assert got == [("BOT3", "d"), ("TOP3", "e")]
    got2 = sorted((r.band, r.k) for r in top_bottom(df.filter("v is not null"), "v", 1).collect())
    assert got2 == [("BOT3", "d"), ("TOP3", "a"), ("TOP3", "b")]   # ties kept (K15)


def test_share_of_total(spark):
    df = spark.createDataFrame([("x", 1), ("y", 2)], "k string, n long")
    got = {r.k: r.pct for r in share_of_total(df, "n", "pct").collect()}
    assert got == {"x": 33.33, "y": 66.67}
