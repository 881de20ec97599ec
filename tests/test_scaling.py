"""What a query moves, holds and computes twice, read from plans and files of small rows (findings of round 3)."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from lodgeflow.operators.kpi import mart_base
from lodgeflow.plans import models as M
from lodgeflow.sources import driver_tables as D
from lodgeflow.sources import sinks
from lodgeflow.sources.csv_ingest import blank_as_null, clean_fact_text, read_aligned, split_valid
from lodgeflow.sources.schemas import LISTING_COLUMNS, LISTING_SCHEMA

#: Bytes of a method beyond which the JVM runs it without compiling it.
COMPILED = 8000


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_mart_does_not_broadcast_its_host_months(spark, tmpdir_path):
    day = dt.date(2020, 5, 1)
    lm = spark.createDataFrame([(day, 1, 7), (day, 2, 7), (day, 3, 8), (day, 4, None)], "month_start date, listing_id long, host_id long")
    hm = spark.createDataFrame([(day, 7, True), (day, 7, False)], "month_start date, host_id long, is_superhost boolean")
    hm.write.parquet(f"{tmpdir_path}/hosts")      # small files, as those of a snapshot of millions of hosts may be
    base = mart_base(lm, spark.read.parquet(f"{tmpdir_path}/hosts"))
    assert "BroadcastHashJoin" not in base._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.listing_id, r._w, r._sh) for r in base.collect()) == [(1, 2, True), (2, 2, True), (3, 1, False), (4, 1, False)]


def test_host_rows_are_picked_without_a_join(spark):
    day = dt.date(2020, 5, 1)
    rows = spark.createDataFrame(
        [(9, 5, "B", False, None, "X  Y", day), (9, 3, "D", True, "z", None, day), (9, 3, "C", True, "z", None, day),
         (9, None, "A", True, "z", None, day), (8, None, "A", True, "z", None, day), (None, 1, "A", True, "z", None, day), (7, 1, "A", True, "z", None, None)],
        "host_id long, listing_id long, host_name string, host_is_superhost boolean, host_neighbourhood string, listing_neighbourhood string, scraped_date date"
    ).withColumn("host_since", F.lit(day))
    picked = M.host_rows(rows)
    assert "Join" not in optimized(picked)
    assert [(r.host_id, r.host_name, r.host_neighbourhood) for r in picked.collect()] == [(9, "C", "Z")]


def small_tables(spark, folder):
    stamp = dt.datetime(1997, 3, 4)
    orders = [(k, k % 5, "OF"[k % 2], 10.0 * k, stamp + dt.timedelta(days=40 * (k % 3)), "1-URGENT") for k in range(40)]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(k, 0, "AUTOMOBILE") for k in range(5)], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "nation": ([(0, "PERU", 0)], "n_nationkey long, n_name string, n_regionkey long"),
        "region": ([(0, "AMERICA")], "r_regionkey long, r_name string")}
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(f"{folder}/{name}.parquet")
    return orders


def test_observations_are_picked_before_their_columns_are_made(spark, tmpdir_path):
    orders = small_tables(spark, tmpdir_path)
    obs = D.listing_observations(spark, tmpdir_path)
    plan = optimized(obs)
    assert plan.index("HOST_") < plan.index("Window")       # the plan's top comes first
    newest = {}
    for k, listing, _, _, at, _ in orders:
        newest[listing, at.date()] = max(k, newest.get((listing, at.date()), -1))
    assert {(r.listing_id, r.scraped_date): r.scrape_id for r in obs.collect()} == newest


def test_month_files_move_typed_rows(spark, tmpdir_path):
    small_tables(spark, tmpdir_path)
    obs = D.listing_observations(spark, tmpdir_path)
    plan = optimized(D.monthly_text(obs))
    assert plan.index("format_number") < plan.index("RebalancePartitions")
    assert sorted(map(tuple, D.monthly_text(obs).collect())) == sorted(map(tuple, D.bronze_listing_text(obs).collect()))


def raw_rows(spark, folder):
    row = dict.fromkeys(LISTING_COLUMNS, "x")
    rows = [tuple((row | {"LISTING_ID": str(i), "SCRAPED_DATE": "n/a" if i % 4 == 0 else f"{1 + i}/5/2020", "MONTH_YEAR": "05_2020"}).values()) for i in range(12)]
    spark.createDataFrame(rows, LISTING_SCHEMA).write.parquet(folder)
    return spark.read.parquet(folder)


def test_cleaned_rows_are_guarded_in_code_that_is_compiled(spark, tmpdir_path):
    valid, bad = split_valid(clean_fact_text(raw_rows(spark, f"{tmpdir_path}/raw")), ["LISTING_ID", "SCRAPED_DATE"])
    rows = blank_as_null(valid)
    parts = rows._jdf.queryExecution().debug().codegenToSeq()
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < COMPILED
    assert (rows.count(), bad.count()) == (9, 3)


def test_a_month_is_taken_from_a_path_once_a_file(spark, tmpdir_path):
    for month in ("05_2020", "06_2020"):
        os.makedirs(f"{tmpdir_path}/MONTH_YEAR={month}")
        with open(f"{tmpdir_path}/MONTH_YEAR={month}/a file.csv", "w") as f:
            f.write("LISTING_ID\n1\n2\n")
    rows = read_aligned(spark, [f"{tmpdir_path}/MONTH_YEAR={m}/a file.csv" for m in ("05_2020", "06_2020")], LISTING_SCHEMA)
    assert "regexp_extract" not in optimized(rows).split("Relation")[0]
    assert sorted((r.MONTH_YEAR, r.LISTING_ID) for r in rows.collect()) == [(m, i) for m in ("05_2020", "06_2020") for i in "12"]


def test_rows_that_lie_by_month_are_loaded_where_they_are(spark, tmpdir_path):
    rows = [(str(i % 50), f"2020-{1 + i // 50:02d}-01", f"{1 + i // 50:02d}_2020") for i in range(600)]
    kind = "id string, day string, MONTH_YEAR string"
    by_month = spark.createDataFrame(spark.sparkContext.parallelize(rows, 60), kind)
    across = spark.createDataFrame(spark.sparkContext.parallelize([r for i in range(60) for r in rows[i::60]], 60), kind)
    mixed = spark.createDataFrame(spark.sparkContext.parallelize(sorted(rows), 60), kind)
    assert sinks.lie_by(by_month, "MONTH_YEAR") and not sinks.lie_by(mixed, "MONTH_YEAR") and not sinks.lie_by(across, "MONTH_YEAR")
    for name, df in (("a", by_month), ("b", mixed)):
        again = df.unionByName(df.filter("id = '7'"))       # some keys come twice
        assert sinks.load_new_rows(spark, again, f"{tmpdir_path}/{name}", ["id", "day"]).count() == 600
        assert sorted(map(tuple, spark.read.parquet(f"{tmpdir_path}/{name}").select("id", "day", "MONTH_YEAR").collect())) == sorted(rows)


def test_a_long_delivery_that_is_there_moves_no_rows(spark, tmpdir_path, monkeypatch):
    """More keys than are sent to all tasks: results as with few, and whole rows meet keys by a shuffle only
    where both the new rows and the other keys are many."""
    kind = "id string, day string, v string, MONTH_YEAR string"

    def rows(ids, v="a"):
        return [(i and str(i), "2020-05-01", v, "05_2020") for i in ids]

    there = rows(range(40))
    deliveries = {      # name: rows of it, whether whole rows are shuffled to find the new ones
        "known": (there, False), "few new": (there + rows([50, 51, None, None]), False),
        "differ": (rows(range(1, 40), "b") + rows([60]) + rows([61, 61]) + rows([61], "c"), False), "many new": (there + rows(range(70, 100)), True)}
    made = []
    monkeypatch.setattr(sinks, "materialize", lambda s, df, name, *a, f=sinks.materialize: made.append(name) or f(s, df, name, *a))
    sinks.load_new_rows(spark, spark.createDataFrame(there, kind), f"{tmpdir_path}/base", ["id", "day"])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, (delivered, moved) in deliveries.items():
            found = []
            for few in (1000, 10):
                monkeypatch.setattr(sinks, "FEW_KEYS", few)
                table, bad = (f"{tmpdir_path}/{name}-{few}{end}" for end in ("", "-bad"))
                for end in ("", "_index"):
                    shutil.copytree(f"{tmpdir_path}/base{end}", f"{table}{end}")
                made.clear()
                new = sinks.load_new_rows(spark, spark.createDataFrame(delivered, kind), table, ["id", "day"], quarantine=bad)
                assert ("load-first" in made) == (name == "differ")
                if name != "differ":
                    assert ("SortMergeJoin" in new._jdf.queryExecution().executedPlan().toString()) == (moved and few == 10), name
                found.append([sorted(map(repr, (spark.read.parquet(f).drop(sinks.LOAD) if sinks.table_exists(spark, f) else new.limit(0)).collect()))
                              for f in (table, f"{table}_index", bad)] + [new.count()])
            assert found[0] == found[1], name
            assert found[0][3] == {"known": 0, "few new": 4, "differ": 2, "many new": 30}[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
