"""Column cleansers against the hand-computed fixtures (FIXTURES §2)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodgeflow.functions import (
    collapse_ws,
    digits_key,
    iso_text_dayfirst,
    null_tokens,
    parse_bool,
    parse_money,
    parse_month_key,
    parse_text_date,
    renormalise_bool,
    safe_corr,
    stays,
    strip_ws,
    upper_trim,
    zero_to_null,
)


def col_values(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_loader_dates(spark):
    raw = ["2020-5-1", "2020/05/01", "1/5/2020", "01.05.2020", "5-13-2020", "31-02-2020",
           "abc", "", None, " 2020-05-01\n", "nan"]
    assert col_values(spark, raw, iso_text_dayfirst) == [
        "2020-05-01", "2020-05-01", "2020-05-01", "2020-05-01", "", "2020-02-31", "", "", "",
        "2020-05-01", ""]


def test_silver_dates(spark):
    import datetime as dt
    raw = ["2020-05-01", "5-3-2020", "05/03/2020", "5.3.2020", "2020-02-31", "2020-5-1",
           "2020-05-01\n", "x"]
    got = col_values(spark, raw, parse_text_date)
    assert got == [dt.date(2020, 5, 1), dt.date(2020, 3, 5), dt.date(2020, 3, 5),
                   dt.date(2020, 3, 5), None, None, None, None]


def test_strict_dates_raise(spark):
    df = spark.createDataFrame([("2020-02-31",)], "v string")
    with pytest.raises(Exception):
        df.select(parse_text_date(F.col("v"), strict=True)).collect()


def test_booleans(spark):
    raw = ["t", "TRUE", "1", "Yes", "f", "0", "no", "x", None]
    assert col_values(spark, raw, parse_bool) == [True, True, True, True, False, False, False,
                                                  None, None]


def test_boolean_renormalise_is_identity_on_booleans(spark):
    assert col_values(spark, [True, False, None], renormalise_bool, "boolean") == [
        True, False, None]


def test_prices(spark):
    raw = ["$1,234.50", "0", "", "N/A", "1-2", None]
    assert col_values(spark, raw, parse_money) == [Decimal("1234.5000"), Decimal("0.0000"),
                                                   None, None, None, None]


def test_keys(spark):
    assert col_values(spark, ["LGA10050", "50", "123456", "", None], digits_key) == [
        "10050", "00050", "12345", "00000", None]


def test_month_key(spark):
    import datetime as dt
    assert col_values(spark, ["05_2020", "5_2020", "13_2020", "05_2020\n"], parse_month_key) == [
        dt.date(2020, 5, 1), None, None, None]


def test_stays(spark):
    df = spark.createDataFrame([(True, 10), (True, None), (True, 40), (False, 5), (None, 5)],
                               "a boolean, f int")
    got = [r[0] for r in df.select(stays(F.col("a"), F.col("f"))).collect()]
    assert got == [20, 30, 0, 0, 0]


def test_text_helpers(spark):
    assert col_values(spark, ["  a  b\t c ", None], collapse_ws) == [" A B C ", None]
    assert col_values(spark, ["  ab  "], upper_trim) == ["AB"]
    assert col_values(spark, ["\t ab \n"], strip_ws) == ["ab"]
    assert col_values(spark, ["nan", "NaN", "None", "x"], null_tokens) == [None, None, None, "x"]
    assert col_values(spark, [0, 3], zero_to_null, "int") == [None, 3]


def test_safe_corr_constant_and_single(spark):
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert const.agg(safe_corr(F.col("a"), F.col("b"))).collect()[0][0] is None
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert one.agg(safe_corr(F.col("a"), F.col("b"))).collect()[0][0] is None
    lin = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "a double, b double")
    assert lin.agg(safe_corr(F.col("a"), F.col("b"))).collect()[0][0] > 0.99
