"""CSV ingest, alignment, idempotent month loads."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.functions import null_tokens

from lodgeflow.sources.csv_ingest import (
    IngestError,
    align_columns,
    assert_width,
    clean_fact_text,
    headers,
    list_month_files,
    read_aligned,
    read_raw_csv,
    split_valid,
    take_first,
    with_file_month,
)
from lodgeflow.sources.schemas import FACT_FILE_PATTERN, LISTING_COLUMNS, LISTING_SCHEMA
from lodgeflow.sources.sinks import (
    keys_held,
    load_new_rows,
    materialize,
    materialize_view,
    overwrite_table,
    save_named,
    table_exists,
)


def write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_quoting_and_multiline(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "q.csv"),
              'A,B\n"say ""hi""",1\n"two\nlines",2\n')
    rows = sorted(tuple(r) for r in read_raw_csv(spark, p, multi_line=True).collect())
    assert rows == [('say "hi"', "1"), ("two\nlines", "2")]


def test_missing_or_empty_file_fails(spark, tmpdir_path):
    with pytest.raises(IngestError):
        read_raw_csv(spark, os.path.join(tmpdir_path, "nope.csv"))
    with pytest.raises(IngestError):
        read_raw_csv(spark, write(os.path.join(tmpdir_path, "e.csv"), ""))


def test_align_columns(spark, tmpdir_path):
    cols = [c for c in LISTING_COLUMNS if c not in ("REVIEW_SCORES_VALUE", "MONTH_YEAR")]
    header = ",".join([c.lower() if c == "PRICE" else c for c in cols] + ["EXTRA"])
    values = ",".join(["1" if c == "LISTING_ID" else "" for c in cols] + ["junk"])
    p = write(os.path.join(tmpdir_path, "05_2020.csv"), header + "\n" + values + "\n")
    df = align_columns(read_raw_csv(spark, p), LISTING_SCHEMA)
    assert df.columns == list(LISTING_COLUMNS)
    r = df.first()
    assert r.LISTING_ID == "1" and r.REVIEW_SCORES_VALUE is None and "EXTRA" not in df.columns
    assert_width(df, len(LISTING_COLUMNS))
    with pytest.raises(IngestError):
        assert_width(df, 3)


def test_take_first_two_columns(spark, tmpdir_path):
    p = write(os.path.join(tmpdir_path, "s.csv"), "LGA,SUBURB,OTHER\n Randwick , Bondi\t,x\n")
    r = take_first(read_raw_csv(spark, p), ["lga_name", "suburb_name"]).collect()
    assert [tuple(x) for x in r] == [("Randwick", "Bondi")]


def test_month_files_pattern_and_order():
    names = ["01_2021.csv", "05_2020.csv", "13_2020.csv", "05_2021.csv", "notes.txt",
             "12_2020.csv"]
    assert list_month_files(names, FACT_FILE_PATTERN) == ["05_2020.csv", "12_2020.csv",
                                                          "01_2021.csv"]


def test_file_month_and_key_guard(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "facts")
    os.makedirs(d)
    write(os.path.join(d, "05_2020.csv"),
          "LISTING_ID,SCRAPED_DATE,PRICE\n1,1/5/2020,\"$1,200.00\"\n,2/5/2020,1\n2,bad,None\n")
    raw = with_file_month(read_raw_csv(spark, d))
    cleaned = clean_fact_text(raw, date_cols=("SCRAPED_DATE",))
    ok, bad = split_valid(cleaned, ["LISTING_ID", "SCRAPED_DATE"])
    assert [(r.LISTING_ID, r.SCRAPED_DATE, r.PRICE, r.MONTH_YEAR) for r in ok.collect()] == [
        ("1", "2020-05-01", "1200.00", "05_2020")]
    assert bad.count() == 2


def test_reload_same_month_adds_nothing(spark, tmpdir_path):
    sink = os.path.join(tmpdir_path, "bronze")
    df = spark.createDataFrame([("1", "05_2020"), ("2", "05_2020"), ("3", "06_2020")],
                               "LISTING_ID string, MONTH_YEAR string")
    assert not table_exists(spark, sink)
    load_new_rows(spark, df.filter("LISTING_ID = '1'"), sink, ["LISTING_ID"])   # a part of a month
    load_new_rows(spark, df, sink, ["LISTING_ID"])                              # the rest comes later
    assert load_new_rows(spark, df, sink, ["LISTING_ID"]).count() == 0
    got = sorted((r.LISTING_ID, r.MONTH_YEAR) for r in spark.read.parquet(sink).collect())
    assert got == [("1", "05_2020"), ("2", "05_2020"), ("3", "06_2020")]


def test_primary_key_on_load(spark, tmpdir_path):
    sink, bad = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "bad")
    kind = "id string, day string, v string, MONTH_YEAR string"
    keys = ["id", "day"]
    one = spark.createDataFrame([("1", "2020-05-01", "a", "05_2020"), ("1", "2020-05-01", "b", "05_2020"),
                                 ("2", "2020-05-01", "c", "05_2020"), ("2", "2020-05-01", "c", "05_2020")], kind)
    load_new_rows(spark, one, sink, keys, quarantine=bad)
    two = spark.createDataFrame([("1", "2020-05-01", "z", "06_2020"), ("1", "2020-05-01", "a", "05_2020"),
                                 ("3", "2020-06-01", "d", "06_2020")], kind)
    load_new_rows(spark, two.filter("v <> 'a'"), sink, keys, quarantine=bad)
    assert sorted((r.id, r.v) for r in spark.read.parquet(sink).collect()) == [("1", "a"), ("2", "c"), ("3", "d")]
    # what differs from the row that holds the key is kept aside; an exact repeat is nothing new
    assert sorted((r.v, r._reason) for r in spark.read.parquet(bad).collect()) == [
        ("b", "key twice"), ("z", "key in table")]


def test_a_batch_reads_the_keys_that_can_be_its_own(spark, tmpdir_path):
    sink, keys = os.path.join(tmpdir_path, "bronze"), ["id", "day"]
    kind = "id string, day string, v string, MONTH_YEAR string"
    months = {m: spark.createDataFrame([(str(i), f"2020-{m:02d}-{1 + i % 28:02d}", "x", f"{m:02d}_2020") for i in range(400)], kind) for m in range(1, 7)}
    for df in months.values():
        load_new_rows(spark, df, sink, keys)
    assert spark.read.parquet(sink).count() == 2400
    assert keys_held(months[6], f"{sink}_index", keys, "other").count() == 400       # its own dates only
    one = months[3].filter("id = '7'")
    held = keys_held(one, f"{sink}_index", keys, "other")
    def parts(files):
        return {f.split("_part=")[1].split("/")[0] for f in files}
    assert len(parts(spark.read.parquet(f"{sink}_index").inputFiles())) == 16 and len(parts(held.inputFiles())) == 1
    assert held.count() < 10
    assert load_new_rows(spark, months[6].union(one), sink, keys).count() == 0


def test_a_repeated_load_takes_its_own_place(spark, tmpdir_path):
    sink, bad, keys = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "bad"), ["id", "day"]
    kind = "id string, day string, v string, MONTH_YEAR string"
    one = spark.createDataFrame([("1", "2020-05-01", "a", "05_2020")], kind)
    two = spark.createDataFrame([("1", "2020-05-01", "b", "05_2020"), ("2", "2020-05-02", "c", "05_2020"), ("3", "2020-05-02", "d", "05_2020"),
                                 ("3", "2020-05-02", "d", "05_2020"), ("3", "2020-05-02", "e", "05_2020")], kind)
    load_new_rows(spark, one, sink, keys, quarantine=bad, load="first")
    for _ in range(2):
        assert load_new_rows(spark, two, sink, keys, quarantine=bad, load="second").count() == 2
        assert sorted((r.id, r.v) for r in spark.read.parquet(sink).collect()) == [("1", "a"), ("2", "c"), ("3", "d")]
        assert sorted((r.v, r._reason) for r in spark.read.parquet(bad).collect()) == [("b", "key in table"), ("e", "key twice")]


def test_refresh_that_fails_leaves_the_old_table(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "dim")
    overwrite_table(spark.range(3), path)
    with pytest.raises(Exception):
        overwrite_table(spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id")), path)
    with pytest.raises(IngestError):
        overwrite_table(spark.range(5), path, check=lambda rows: assert_width(rows, 2))
    assert spark.read.parquet(path).count() == 3 and os.listdir(tmpdir_path) == ["dim"]
    os.rename(path, path + "__old")                       # ended between the two renames
    overwrite_table(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4 and os.listdir(tmpdir_path) == ["dim"]


def test_headers_in_one_job(spark, tmpdir_path):
    files = [write(os.path.join(tmpdir_path, f"a file {i}.csv"), f"A,B{i % 3}\r\n1,2\r\n") for i in range(40)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    got = headers(spark, files)
    assert len(tracker.getJobIdsForGroup("headers")) <= 3         # a listing, a scan and its aggregate, however many files
    spark.sparkContext.setJobGroup("rest", "rest")
    assert {os.path.basename(p): n for p, n in got.items()} == {f"a file {i}.csv": ("A", f"B{i % 3}") for i in range(40)}
    assert len(read_aligned(spark, files, T.StructType([T.StructField("A", T.StringType()), T.StructField("MONTH_YEAR", T.StringType())])).collect()) == 40


def test_files_are_aligned_by_their_own_header(spark, tmpdir_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("A", "B", "C", "MONTH_YEAR")])
    files = [write(os.path.join(tmpdir_path, "05_2020.csv"), "A,B,C\n1,2,3\n"),
             write(os.path.join(tmpdir_path, "06_2020.csv"), "c,EXTRA,a\n6,x,4\n"),
             write(os.path.join(tmpdir_path, "07_2020.csv"), '\ufeff"B",A\n8,"7, and"\n'),
             write(os.path.join(tmpdir_path, "08_2020.csv"), "")]
    got = sorted(tuple(r) for r in read_aligned(spark, files, schema).collect())
    assert got == [("1", "2", "3", "05_2020"), ("4", None, "6", "06_2020"), ("7, and", "8", None, "07_2020")]
    assert read_aligned(spark, files[3:], schema).count() == 0


def test_null_tokens(spark):
    texts = ["NULL", "NA", "N/A", "null", "nan", "None", "", "Nancy", "n"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select(null_tokens(F.col("v")).alias("v"))
    assert [r.v for r in df.collect()] == [None] * 7 + ["Nancy", "n"]


def test_named_tables_and_views(spark):
    df = spark.range(6).withColumn("m", F.col("id") % 2)
    back = save_named(df, "lodgeflow_test_named", ["m"])
    assert back.count() == 6 and spark.table("lodgeflow_test_named").columns == ["id", "m"]
    assert "6 rows" in spark.sql("DESCRIBE EXTENDED lodgeflow_test_named").filter("col_name = 'Statistics'").first()[1]
    view = materialize_view(df.filter("m = 1"), "lodgeflow_test_view")
    assert view.count() == 3 == spark.table("lodgeflow_test_view").count()
    spark.sql("DROP TABLE lodgeflow_test_named")


def test_materialize_round_trip(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    back = materialize(spark, df, "t")
    assert sorted(r.x for r in back.collect()) == list(range(0, 20, 2))


def test_file_month_from_partition_folders(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "files")
    for month in ("05_2020", "06_2020"):
        d = os.path.join(base, f"MONTH_YEAR={month}")
        os.makedirs(d)
        write(os.path.join(d, "part-00000.csv"), f"LISTING_ID\n{month[:2]}\n")
    names = list_month_files(os.listdir(base), r"^MONTH_YEAR=\d{2}_\d{4}$")
    assert names == ["MONTH_YEAR=05_2020", "MONTH_YEAR=06_2020"]
    df = with_file_month(read_raw_csv(spark, os.path.join(base, names[0])))
    assert [(r.LISTING_ID, r.MONTH_YEAR) for r in df.collect()] == [("05", "05_2020")]
