"""Marts kept up to date by months: equal to the mart from scratch, other months' files stay."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lodgeflow.plans import models as M
from lodgeflow.plans.marts import MartTable
from lodgeflow.streaming.ingest import SnapshotTable

SINCE = dt.date(2020, 1, 1)
HOSTS = "host_id int, host_name string, host_since date, host_is_superhost boolean, host_neighbourhood string, scraped_date date"


def listing_rows(spark, rows):
    """(listing, host, area, price, day) as rows of the listing snapshot."""
    kinds = {"listing_id": "int", "host_id": "int", "property_type": "string", "room_type": "string", "accommodates": "int",
             "listing_neighbourhood": "string", "has_availability": "boolean", "availability_30": "int", "price": "decimal(18,2)",
             "number_of_reviews": "int", "scraped_date": "date"}
    df = spark.createDataFrame([(i, h, a, p, d) for i, h, a, p, d in rows], "listing_id int, host_id int, area string, p int, d date")
    given = {"listing_id": F.col("listing_id"), "host_id": F.col("host_id"), "listing_neighbourhood": F.col("area"), "price": F.col("p"),
             "scraped_date": F.col("d"), "property_type": F.lit("H"), "room_type": F.lit("R"), "accommodates": F.lit(2),
             "has_availability": F.col("p") % 2 == 0, "availability_30": F.lit(3), "number_of_reviews": F.lit(1)}
    return df.select(*[given[c].cast(kinds[c]).alias(c) if c in given else F.lit(5.0).alias(c) for c in M.LISTING_SNAPSHOT_COLUMNS])


def host_rows(spark, rows):
    return spark.createDataFrame([(h, f"N{h}", SINCE, sh, area, d) for h, sh, area, d in rows], HOSTS)


def day(text):
    return dt.date.fromisoformat(text)


BATCHES = [
    ([(1, 1, "A", 10, day("2020-01-05")), (2, 1, "A", 11, day("2020-01-06")), (3, 2, "B", 12, day("2020-02-07")), (9, 2, "GONE", 8, day("2020-02-01"))],
     [(1, True, "X", day("2020-01-05")), (2, False, "Y", day("2020-02-07"))]),
    ([(1, 1, "A", 14, day("2020-04-05")), (2, 1, "B", 13, day("2020-05-06")), (9, 2, "B", 8, day("2020-05-01"))],
     [(1, False, "X", day("2020-04-05")), (2, True, "Z", day("2020-05-01"))]),
    # a listing that is older than the batch before, and one that moves on in the newest month
    ([(4, None, "A", 20, day("2020-04-30")), (3, 2, "C", 16, day("2020-07-07"))], [(2, False, "Y", day("2020-07-07"))]),
]


def scratch_mart(kind, listings, hosts, newest, boundary):
    base = M.kpi_base(M.dim_snap_listing(listings.current(), boundary), M.dim_snap_host(hosts.current(), boundary), (SINCE, newest), M.MART_KINDS[kind][2])
    return M.kpi_mart(base, kind, extra=True)


def files(base):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{base}/cells") for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("kind, boundary", [("neighbourhood", "overlap"), ("host_neighbourhood", "half_open")])
def test_refreshes_equal_the_mart_from_scratch(spark, tmpdir_path, kind, boundary):
    listings, hosts = SnapshotTable(spark, f"{tmpdir_path}/l"), SnapshotTable(spark, f"{tmpdir_path}/h")
    table = MartTable(spark, f"{tmpdir_path}/m", kind, SINCE, boundary)
    assert table.mart() is None and table.refresh(listings, hosts) == []
    for i, (ls, hs) in enumerate(BATCHES):
        listings.apply(listing_rows(spark, ls), "listing_id", "scraped_date")
        hosts.apply(host_rows(spark, hs), "host_id", "scraped_date", M.HOST_CHECK_COLUMNS)
        before = files(f"{tmpdir_path}/m")
        written = table.refresh(listings, hosts)
        newest = max(r[4] for b in BATCHES[:i + 1] for r in b[0]).replace(day=1)
        plain = scratch_mart(kind, listings, hosts, newest, boundary)
        got = table.mart(extra=True)
        assert got.columns == plain.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
        stay = {f for f in before if not any(f"month_start={m}" in f for m in written)}
        assert stay <= files(f"{tmpdir_path}/m")
        if i:
            assert stay     # the months before the batch's first change
        # a refresh without an apply writes nothing, and one that lost its entry is made again with the same rows
        assert table.refresh(listings, hosts) == []
    assert min(written) == day("2020-04-01")


def test_a_missed_refresh_is_made_up(spark, tmpdir_path):
    listings, hosts = SnapshotTable(spark, f"{tmpdir_path}/l"), SnapshotTable(spark, f"{tmpdir_path}/h")
    table = MartTable(spark, f"{tmpdir_path}/m", "neighbourhood", SINCE)
    for i, (ls, hs) in enumerate(BATCHES):
        listings.apply(listing_rows(spark, ls), "listing_id", "scraped_date")
        hosts.apply(host_rows(spark, hs), "host_id", "scraped_date", M.HOST_CHECK_COLUMNS)
        if i != 1:
            table.refresh(listings, hosts)
    plain = scratch_mart("neighbourhood", listings, hosts, day("2020-07-01"), "overlap")
    assert sorted(map(str, table.mart(extra=True).collect())) == sorted(map(str, plain.collect()))


def test_a_month_that_loses_its_rows(spark, tmpdir_path):
    """Hard deletes empty the months after them."""
    listings, hosts = SnapshotTable(spark, f"{tmpdir_path}/l"), SnapshotTable(spark, f"{tmpdir_path}/h")
    table = MartTable(spark, f"{tmpdir_path}/m", "neighbourhood", SINCE)
    hosts.apply(host_rows(spark, BATCHES[0][1]), "host_id", "scraped_date", M.HOST_CHECK_COLUMNS)
    listings.apply(listing_rows(spark, [(1, 1, "A", 10, day("2020-01-05")), (2, 1, "A", 10, day("2020-04-05"))]), "listing_id", "scraped_date")
    table.refresh(listings, hosts)
    listings.apply(listing_rows(spark, [(2, 1, "A", 10, day("2020-04-05"))]), "listing_id", "scraped_date", close_missing=True)
    table.refresh(listings, hosts)
    plain = scratch_mart("neighbourhood", listings, hosts, day("2020-04-01"), "overlap")
    assert sorted(map(str, table.mart(extra=True).collect())) == sorted(map(str, plain.collect()))
