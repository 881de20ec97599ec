"""End to end on hand-made files: CSV -> bronze -> silver/star -> marts -> analyses."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lodgeflow.plans import analyses as A
from lodgeflow.plans.pipeline import (
    Warehouse,
    check_load,
    load_dimensions,
    load_facts,
    register_tables,
)
from lodgeflow.sources.csv_ingest import IngestError
from lodgeflow.sources.schemas import G01_SCHEMA, G02_COLUMNS, LISTING_COLUMNS
from lodgeflow.sources.sinks import plan_by_statistics, save_named

FACT_COLS = [c for c in LISTING_COLUMNS if c != "MONTH_YEAR"]


def write(path, lines):
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def fact_line(**kv):
    vals = {c: "" for c in FACT_COLS}
    vals.update({k.upper(): v for k, v in kv.items()})
    return ",".join(f'"{vals[c]}"' for c in FACT_COLS)


def build_inputs(root):
    dims, facts = os.path.join(root, "dimensions"), os.path.join(root, "facts")
    os.makedirs(dims)
    os.makedirs(facts)
    write(os.path.join(dims, "NSW_LGA_CODE.csv"),
          ["LGA_CODE,LGA_NAME,NOTE", "10050,Sydney,x", "10100, Randwick ,y"])
    write(os.path.join(dims, "NSW_LGA_SUBURB.csv"),
          ["LGA_NAME,SUBURB_NAME", "Randwick,Bondi", "Sydney,Surry Hills"])
    g01 = [f.name for f in G01_SCHEMA.fields]
    write(os.path.join(dims, "2016Census_G01_NSW_LGA.csv"),
          [",".join(g01)] + [",".join([code] + [str(10 + i) for i in range(len(g01) - 1)])
                             for code in ("LGA10050", "LGA10100")])
    write(os.path.join(dims, "2016Census_G02_NSW_LGA.csv"),
          ["LGA_CODE_2016," + ",".join(G02_COLUMNS),
           "LGA10050,35,2000,1,1,1,1,1,2.5", "LGA10100,40,10,1,1,1,1,1,2.1"])
    common = dict(host_name="H", host_is_superhost="t", has_availability="t",
                  availability_30="10", property_type="Apartment", room_type="Entire",
                  accommodates="2")
    write(os.path.join(facts, "05_2020.csv"), [",".join(FACT_COLS),
          fact_line(listing_id="1", scraped_date="10/05/2020", host_id="7",
                    listing_neighbourhood="Bondi", price="$100.00", **common),
          fact_line(listing_id="2", scraped_date="11.05.2020", host_id="8",
                    listing_neighbourhood="sydney", price="$1,050.00", **common),
          fact_line(listing_id="3", scraped_date="2020-05-12", host_id="9",
                    listing_neighbourhood="Nowhere", price="20", **common),
          fact_line(listing_id="4", scraped_date="n/a", host_id="9", **common)])
    write(os.path.join(facts, "06_2020.csv"), [",".join(FACT_COLS),
          fact_line(listing_id="1", scraped_date="12/06/2020", host_id="7",
                    listing_neighbourhood="Bondi", price="$100.00", **common)])
    write(os.path.join(facts, "13_2020.csv"), [",".join(FACT_COLS)])   # not a month file
    return dims, facts


def test_end_to_end(spark, tmpdir_path):
    dims, facts = build_inputs(tmpdir_path)
    bronze = os.path.join(tmpdir_path, "bronze")
    loaded = load_dimensions(spark, dims, bronze)
    assert loaded == {"r_d_2016census_g01_nsw_lga": 2, "r_d_2016census_g02_nsw_lga": 2,
                      "r_d_nsw_lga_code": 2, "r_d_nsw_lga_suburb": 2}
    first = load_facts(spark, facts, bronze)
    assert first == {"files": 2, "loaded": 4, "quarantined": 1}
    assert spark.read.parquet(bronze + "/r_f_listing_quarantine").count() == 1
    again = load_facts(spark, facts, bronze)                          # reload reads nothing
    assert again == {"files": 0, "loaded": 0, "quarantined": 0}

    assert check_load(spark, bronze)["PRICE"] != []
    with pytest.raises(IngestError):
        check_load(spark, os.path.join(tmpdir_path, "nothing"))

    w = Warehouse.of(spark, bronze, horizon=(dt.date(2020, 5, 1), dt.date(2020, 6, 1)), materialize=False)
    assert isinstance(w, Warehouse) and w.boundary == "overlap"
    assert Warehouse(spark, bronze).horizon == (dt.date(2019, 7, 1), dt.date(2020, 6, 1))
    stg = {r.listing_id: r for r in w.stg.filter("listing_id = 2").collect()}
    assert stg[2].price == 1050 and stg[2].scraped_date == dt.date(2020, 5, 11)
    assert stg[2].listing_neighbourhood == "SYDNEY" and stg[2].month_date == dt.date(2020, 5, 1)

    mart = w.mart("neighbourhood", extra=True)
    bondi = {r.month_start.month: r for r in
             mart.filter(F.col("listing_neighbourhood") == "BONDI").collect()}
    assert bondi[5].listings_total == 1 and bondi[6].listings_total == 2   # K1 overlap

    lk = {r.name_key: r.lga_code for r in w.lookup.collect()}
    assert lk["sydney"] == "10050" and lk["bondi"] == "10100" and "nowhere" not in lk

    bands = A.top_bottom_bands(w, n=12, k=3).collect()
    assert {r.lga_name for r in bands} == {"SYDNEY", "RANDWICK"}
    assert all(r.pct_0_14 is not None for r in bands)
    assert A.age_revenue_corr(w).first().n_neighbourhoods == 2
    assert A.best_combo_per_area(w).count() >= 1
    spread = A.host_concentration(w).collect()
    assert spread == []                                # every host has one listing
    cover = {r.lga_name: (r.single_hosts, r.hosts_covering) for r in A.host_cost_cover(w).collect()}
    # host 8 (SYDNEY): 20 nights x 1050 = 21000 < 12 x 2000; host 7 (RANDWICK): May 2000 plus
    # June counted in both versions (K1) 2 x 2000, well above 12 x 10
    assert cover["SYDNEY"] == (1, 0) and cover["RANDWICK"] == (1, 1)


def test_archive_and_catalog(spark, tmpdir_path):
    _, facts = build_inputs(tmpdir_path)
    bronze, arch = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "arch")
    load_facts(spark, facts, bronze, archive_dir=arch)
    assert sorted(n for _, _, names in os.walk(arch) for n in names) == ["05_2020.csv", "06_2020.csv"]
    assert os.listdir(facts) == ["13_2020.csv"]
    assert register_tables(spark, bronze) == ["r_f_listing"]
    assert spark.table("r_f_listing").count() == 4
    assert "4 rows" in spark.sql("DESCRIBE EXTENDED r_f_listing").filter("col_name = 'Statistics'").first()[1]
    spark.sql("DROP TABLE r_f_listing")


def test_statistics_reach_the_plans_of_the_analyses(spark, tmpdir_path):
    """With catalog tables, N17 and N18 are planned with row counts, and a join order taken from them."""
    dims, facts = build_inputs(tmpdir_path)
    bronze = os.path.join(tmpdir_path, "bronze")
    load_dimensions(spark, dims, bronze)
    load_facts(spark, facts, bronze)
    horizon = (dt.date(2020, 5, 1), dt.date(2020, 6, 1))
    plain = Warehouse(spark, bronze, horizon=horizon)
    spark.sql(f"CREATE DATABASE lodge_stats LOCATION '{tmpdir_path}/lodge_stats'")
    plan_by_statistics(spark)
    try:
        w = Warehouse(spark, bronze, horizon=horizon, catalog="lodge_stats.")
        for analysis in (A.host_concentration, A.host_cost_cover, A.top_bottom_bands):
            got, want = analysis(w), analysis(plain)
            assert got.collect() == want.collect()
        for analysis in (A.host_concentration, A.host_cost_cover):
            lines = analysis(w)._jdf.queryExecution().stringWithStats().split("== Physical")[0].splitlines()
            joins = [x for x in lines if "Join " in x]
            scans = [x for x in lines if "Relation " in x]
            assert joins and scans and all("rowCount=" in x for x in scans), scans
            assert any("rowCount=" in x for x in joins), joins
        seen = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED lodge_stats.snap_listing listing_id").collect()}
        assert seen["distinct_count"] == "3" and seen["histogram"] != "NULL"

        # written largest first; the statistics put the join that leaves least first
        spark.range(2000).selectExpr("id % 500 AS listing_id", "id % 40 AS host_id").createOrReplaceTempView("rows_in")
        save_named(spark.table("rows_in"), "lodge_stats.facts", columns=["listing_id", "host_id"])
        save_named(spark.range(500).selectExpr("id AS listing_id", "id % 5 AS kind"), "lodge_stats.listings", columns=["listing_id", "kind"])
        save_named(spark.range(2).selectExpr("id AS host_id"), "lodge_stats.hosts", columns=["host_id"])
        query = spark.table("lodge_stats.facts").join(spark.table("lodge_stats.listings"), "listing_id").join(spark.table("lodge_stats.hosts"), "host_id")
        order = query._jdf.queryExecution().optimizedPlan().toString()
        plan_by_statistics(spark, False)
        as_written = spark.table("lodge_stats.facts").join(spark.table("lodge_stats.listings"), "listing_id").join(spark.table("lodge_stats.hosts"), "host_id")
        written = as_written._jdf.queryExecution().optimizedPlan().toString()

        def last_join(plan):
            return next(x for x in plan.splitlines() if "Join " in x)

        assert "host_id" in last_join(written) and "listing_id" in last_join(order)
        assert query.count() == as_written.count() == 100
    finally:
        plan_by_statistics(spark, False)
        spark.sql("DROP DATABASE lodge_stats CASCADE")


def test_redelivered_file_and_archive_clash(spark, tmpdir_path, caplog):
    """A corrected file under an old name is loaded and archived beside the first one."""
    _, facts = build_inputs(tmpdir_path)
    bronze, arch = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "arch")
    load_facts(spark, facts, bronze, archive_dir=arch)
    for n in (5, 6):                                    # again and again
        write(os.path.join(facts, "05_2020.csv"), [",".join(FACT_COLS), fact_line(listing_id="1", scraped_date="10/05/2020", host_id="7"),
                                                   fact_line(listing_id=str(n), scraped_date="10/05/2020", host_id="7")])
        report = load_facts(spark, facts, bronze, archive_dir=arch, register=n == 6)
        assert report == {"files": 1, "loaded": 1, "quarantined": 0} and report.not_archived == []
        assert report.samples["SCRAPED_DATE"]
    raw = spark.read.parquet(bronze + "/r_f_listing")
    assert sorted(r.LISTING_ID for r in raw.filter("MONTH_YEAR = '05_2020'").collect()) == ["1", "2", "3", "5", "6"]
    names = sorted(n for _, _, found in os.walk(arch) for n in found if n.endswith(".csv"))
    assert len(names) == 4 and names[0] == "05_2020.csv" and names[-1] == "06_2020.csv" and names[1].startswith("05_2020_2")
    assert os.listdir(facts) == ["13_2020.csv"]
    assert spark.table("r_f_listing").count() == 6
    spark.sql("DROP TABLE r_f_listing")
    with caplog.at_level("WARNING"):
        assert load_dimensions(spark, os.path.join(tmpdir_path, "none"), bronze) == {}
    assert sum("missing" in r.message for r in caplog.records) == 4


def test_failed_load_is_repeated(spark, tmpdir_path, monkeypatch):
    from lodgeflow.plans import pipeline
    from lodgeflow.sources.manifest import Manifest
    _, facts = build_inputs(tmpdir_path)
    bronze = os.path.join(tmpdir_path, "bronze")

    def lost(*args):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(Manifest, "end", lost)
        with pytest.raises(RuntimeError):
            load_facts(spark, facts, bronze)
    write(os.path.join(facts, "07_2020.csv"), [",".join(FACT_COLS), fact_line(listing_id="8", scraped_date="10/07/2020", host_id="7")])
    assert load_facts(spark, facts, bronze) == {"files": 3, "loaded": 5, "quarantined": 1}
    assert spark.read.parquet(bronze + "/r_f_listing").count() == 5
    assert spark.read.parquet(bronze + "/r_f_listing_quarantine").count() == 1
    assert load_facts(spark, facts, bronze) == {"files": 0, "loaded": 0, "quarantined": 0}
    assert pipeline.check_load(spark, bronze)["PRICE"]


def test_silver_quarantine(spark):
    from lodgeflow.plans import models as M
    rows = [("1", "2020-05-01", "$10"), ("2", "2020-02-31", "1-2"), ("3", "2020-05-02", "123456789012345.5"), ("4", "2020-05-03", "")]
    cols = list(LISTING_COLUMNS)
    full = [tuple({"LISTING_ID": i, "SCRAPED_DATE": d, "PRICE": p, "MONTH_YEAR": "05_2020"}.get(c) for c in cols) for i, d, p in rows]
    typed, bad = M.split_silver(spark.createDataFrame(full, ", ".join(f"{c} string" for c in cols)))
    assert typed.count() == 4
    assert sorted((r.LISTING_ID, r.reason) for r in bad.collect()) == [("2", "scraped_date,price"), ("3", "price")]


def test_mart_by_several_listing_columns_and_code_option(spark, tmpdir_path):
    from lodgeflow.plans.context import Domain
    from lodgeflow.plans import models as M
    d = Domain.of(spark, "/root/testdata/sf0.001")
    m = d.mart("property_room_size")
    assert m.columns[:4] == ["property_type", "room_type", "accommodates", "month_start"]
    assert dict(m.dtypes)["accommodates"] == "int" and m.count() > 0
    codes = spark.createDataFrame([("LGA 10050", "Sydney")], "LGA_CODE string, LGA_NAME string")
    assert M.stg_lga_code(codes, normalise_code=True).first().lga_code == "10050"


def test_ensure_tables(spark, tmpdir_path):
    from lodgeflow.sources.schemas import LGA_CODE_SCHEMA
    from lodgeflow.sources.sinks import ensure_tables
    made = ensure_tables(spark, {"r_d_nsw_lga_code": LGA_CODE_SCHEMA}, tmpdir_path)
    assert len(made) == 1 and ensure_tables(spark, {"r_d_nsw_lga_code": LGA_CODE_SCHEMA},
                                            tmpdir_path) == []
    assert spark.read.parquet(made[0]).columns == ["LGA_CODE", "LGA_NAME"]
