"""L1 exactly-once month ingest with archive, L2 snapshot apply per micro-batch."""

import datetime as dt
import os
import shutil
import time

from pyspark.sql import functions as F

from lodgeflow.operators.history import scd2_apply, scd2_check
from lodgeflow.sources.schemas import LISTING_COLUMNS
from lodgeflow.streaming.ingest import (
    SnapshotTable,
    month_file_stream,
    stream_months,
    stream_snapshot,
)

COLS = [c for c in LISTING_COLUMNS if c != "MONTH_YEAR"]


def month_file(d, name, rows, mtime):
    path = os.path.join(d, name)
    with open(path, "w") as f:
        f.write(",".join(COLS) + "\n")
        for r in rows:
            vals = {c: "" for c in COLS}
            vals.update(r)
            f.write(",".join(vals[c] for c in COLS) + "\n")
    os.utime(path, (mtime, mtime))
    return path


def listing(lid, date, host="7", area="Bondi", sh="t"):
    return {"LISTING_ID": str(lid), "SCRAPED_DATE": date, "HOST_ID": host, "HOST_NAME": "H",
            "HOST_IS_SUPERHOST": sh, "HOST_NEIGHBOURHOOD": area, "PRICE": "$10"}


def test_stream_ingest_exactly_once_with_archive(spark, tmpdir_path):
    src, arch = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "archive")
    os.makedirs(src)
    now = time.time() - 100
    month_file(src, "05_2020.csv", [listing(1, "1/5/2020"), listing(2, "bad")], now)
    month_file(src, "06_2020.csv", [listing(1, "1/6/2020")], now + 1)
    sink, ck = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "ck")
    stream_months(spark, src, ck, sink, archive_dir=arch).awaitTermination()
    first = sorted((r.LISTING_ID, r.SCRAPED_DATE, r.MONTH_YEAR)
                   for r in spark.read.parquet(sink).collect())
    assert first == [("1", "2020-05-01", "05_2020"), ("1", "2020-06-01", "06_2020")]
    # a row delivered again, a file that is not a month file, and a rerun change nothing; a new row
    # of a month that is there already is added
    os.makedirs(os.path.join(src, "more"))
    month_file(os.path.join(src, "more"), "05_2020.csv", [listing(1, "1/5/2020"), listing(9, "2/5/2020")], now + 2)
    month_file(src, "notes.csv", [listing(8, "2/5/2020")], now + 3)
    for _ in range(2):
        stream_months(spark, src, ck, sink, archive_dir=arch).awaitTermination()
    again = sorted((r.LISTING_ID, r.SCRAPED_DATE, r.MONTH_YEAR)
                   for r in spark.read.parquet(sink).collect())
    assert again == sorted([*first, ("9", "2020-05-02", "05_2020")])
    # the source moves a batch's files when a later batch is planned
    archived = {n for _, _, names in os.walk(arch) for n in names}
    assert "05_2020.csv" in archived and "06_2020.csv" in archived


def test_month_split_over_batches(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src", "MONTH_YEAR=05_2020")
    os.makedirs(src)
    now = time.time() - 100
    for i in range(3):
        month_file(src, f"part{i}.csv", [listing(i, "1/5/2020")], now + i)
    sink = os.path.join(tmpdir_path, "bronze")
    for ck in ("one", "two"):     # the second time as if the checkpoint were lost
        stream_months(spark, os.path.dirname(src), os.path.join(tmpdir_path, ck), sink,
                      max_files=1).awaitTermination()
    got = sorted((r.LISTING_ID, r.MONTH_YEAR) for r in spark.read.parquet(sink).collect())
    assert got == [(str(i), "05_2020") for i in range(3)]


def test_half_written_apply_is_invisible(spark, tmpdir_path):
    """An apply whose closed versions are written but not its state, as if it had ended there."""
    base, half = os.path.join(tmpdir_path, "snap"), os.path.join(tmpdir_path, "half")
    rows = spark.createDataFrame([(1, dt.date(2020, 5, 1), "A"), (1, dt.date(2020, 6, 1), "B")],
                                 "k long, ts date, a string")
    t = SnapshotTable(spark, base)
    t.apply(rows.filter("ts < '2020-06-01'"), "k", "ts", ["a"])
    t.apply(rows.filter("ts >= '2020-06-01'"), "k", "ts", ["a"])
    shutil.copytree(base, half, ignore=lambda d, names: ["batch=1"] if d.endswith("state") else [])
    back = SnapshotTable(spark, half)
    assert [(r.a, r.dbt_valid_to) for r in back.current().collect()] == [("A", None)]
    back.apply(rows.filter("ts >= '2020-06-01'"), "k", "ts", ["a"])
    assert sorted((r.a, str(r.dbt_valid_to)[:10]) for r in back.current().collect()) == [
        ("A", "2020-06-01"), ("B", "None")]


def test_an_apply_reads_no_closed_history(spark, tmpdir_path):
    """One row a key is read by every apply, with deletes and old batches, and the result is that
    of applying to the whole table."""
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "snap"))
    whole = None
    batches = []
    for i in range(8):
        keys = [k for k in range(6) if (k + i) % 4 or i == 0]          # some keys go and come back
        batches.append(spark.createDataFrame([(k, dt.date(2020, 1 + i, 1), f"v{(k * i) % 3}") for k in keys], "k long, ts date, a string"))
    for b in [*batches[:4], batches[1], *batches[4:], batches[0]]:       # two old batches among them
        table.apply(b, "k", "ts", ["a"], close_missing=True)
        whole = scd2_apply(whole, b, "k", "ts", ["a"], close_missing=True)
        whole = spark.createDataFrame(whole.collect(), whole.schema)
        state = table.state()
        assert state.count() == 6
        assert all(f"/state/batch={table.version}/" in f for f in state.inputFiles())

    def canon(df):
        return sorted((r.k, r.a, str(r.dbt_valid_from), str(r.dbt_valid_to)) for r in df.collect())
    assert canon(table.current()) == canon(whole)


def test_a_batch_is_one_load(spark, tmpdir_path):
    """Rows without a key are kept aside once, also when the batch is repeated from its checkpoint."""
    src, ck = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "ck")
    os.makedirs(src)
    month_file(src, "05_2020.csv", [listing(1, "1/5/2020"), listing(2, "bad")], time.time() - 100)
    sink, bad = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "bad")
    stream_months(spark, src, ck, sink, quarantine=bad).awaitTermination()
    for name in ("0", ".0.crc"):                           # the driver was lost before the commit
        os.remove(os.path.join(ck, "commits", name))
    stream_months(spark, src, ck, sink, quarantine=bad).awaitTermination()
    assert [r.LISTING_ID for r in spark.read.parquet(sink).collect()] == ["1"]
    assert [r.LISTING_ID for r in spark.read.parquet(bad).collect()] == ["2"]


def test_snapshot_apply_per_batch_equals_closed_form(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    areas = ["A", "A", "B", "A", "C", "C"]
    now = time.time() - 100
    for i, a in enumerate(areas):
        m = 5 + i
        month_file(src, f"{m:02d}_2020.csv",
                   [listing(1, f"1/{m}/2020", area=a), listing(2, f"3/{m}/2020", host="8",
                                                              area="Z" if i < 3 else "Y")],
                   now + i)
    table = SnapshotTable(spark, os.path.join(tmpdir_path, "snap"))

    def to_rows(b):
        return b.select(F.col("HOST_ID").cast("long").alias("host_id"),
                        F.to_date(F.col("SCRAPED_DATE"), "d/M/yyyy").alias("scraped_date"),
                        F.col("HOST_NEIGHBOURHOOD").alias("area"))

    stream = month_file_stream(spark, src, max_files=1)
    stream_snapshot(spark, stream, table, to_rows, "host_id", "scraped_date",
                    os.path.join(tmpdir_path, "ck"), check_cols=["area"]).awaitTermination()
    assert table.version == len(areas) - 1          # one snapshot version per month batch
    allrows = to_rows(spark.read.options(header="true").csv(src))
    closed = scd2_check(allrows, "host_id", "scraped_date", ["area"])

    def canon(df):
        return sorted((r.host_id, r.area, str(r.dbt_valid_from), str(r.dbt_valid_to))
                      for r in df.collect())
    assert canon(table.current()) == canon(closed)
    assert len(canon(closed)) == 6   # host 7: A,B,A,C; host 8: Z,Y


def test_snapshot_table_resumes_after_restart(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "snap")
    rows = spark.createDataFrame([(1, dt.date(2020, 5, 1), "A"), (1, dt.date(2020, 6, 1), "B")],
                                 "k long, ts date, a string")
    t1 = SnapshotTable(spark, base)
    t1.apply(rows.filter("ts < '2020-06-01'"), "k", "ts", ["a"])
    t2 = SnapshotTable(spark, base)                     # a new driver finds version 0
    assert t2.version == 0
    t2.apply(rows.filter("ts >= '2020-06-01'"), "k", "ts", ["a"])
    t2.apply(rows.filter("ts >= '2020-06-01'"), "k", "ts", ["a"])   # replayed batch: no-op
    got = sorted((r.a, str(r.dbt_valid_to)[:10]) for r in t2.current().collect())
    assert got == [("A", "2020-06-01"), ("B", "None")]
