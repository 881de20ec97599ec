"""CSV ingest into the raw layer.

Files are read by Spark's CSV source with every column as text; a month file
is one input among many, so a whole directory of months is one parallel scan,
and a large file is split over tasks. Fields that hold line breaks need
``multi_line=True``, which makes a file one task.
"""

from __future__ import annotations

import csv
import os
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.functions import iso_text_dayfirst, null_tokens, strip_ws

CSV_OPTIONS = {"header": "true", "inferSchema": "false", "quote": '"', "escape": '"',
               "mode": "PERMISSIVE"}
MONTH_FROM_NAME = r"(\d{2}_\d{4})\.csv$"
# The month of a file: its name MM_YYYY.csv, or its folder MONTH_YEAR=MM_YYYY.
MONTH_FROM_PATH = r"(?:/|^)(?:MONTH_YEAR=)?(\d{2}_\d{4})(?:\.csv$|/)"


class IngestError(RuntimeError):
    pass


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 multi_line: bool = False) -> DataFrame:
    """A1: read CSV with every column as text; fail when the file is missing or empty.

    Quoted fields may hold doubled quotes, and with ``multi_line`` newlines.
    With ``schema`` the columns are taken by position; without it the header
    names are kept.
    """
    from lodgeflow.sources.sinks import path_exists, path_size
    if not path_exists(spark, path) or path_size(spark, path) == 0:
        raise IngestError(f"CSV missing/empty: {path}")
    reader = spark.read.options(**CSV_OPTIONS, multiLine=str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    if schema is None:
        df = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return df


def list_month_files(names, pattern: str) -> list[str]:
    """A2: file names matching ``pattern``, ordered by the month they hold.

    Name order is not date order (``01_2021`` sorts before ``05_2020``), so
    the key is (year, month) parsed from ``MM_YYYY``.
    """
    rx = re.compile(pattern)
    picked = [n for n in names if rx.match(os.path.basename(n))]

    def key(n):
        m = re.search(r"(\d{2})_(\d{4})", os.path.basename(n))
        return (int(m.group(2)), int(m.group(1))) if m else (0, 0)
    return sorted(picked, key=key)


def with_file_month(df: DataFrame, out: str = "MONTH_YEAR") -> DataFrame:
    """A10: tag each row with the ``MM_YYYY`` month of its file (name or folder)."""
    return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), MONTH_FROM_PATH, 1))


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A4: match columns by exact, upper or lower name; missing ones become NULL,
    extra ones are dropped, and the target order is used."""
    present = {c: c for c in df.columns}
    cols = []
    for field in schema.fields:
        name = field.name
        src = next((present[n] for n in (name, name.upper(), name.lower()) if n in present), None)
        c = F.col(f"`{src}`") if src else F.lit(None)
        cols.append(c.cast(field.dataType).alias(name))
    return df.select(*cols)


def read_aligned(spark: SparkSession, files, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """A1 + A4 + A10 over many month files: each file's columns are matched by its own header.

    Files with one header are one scan by names; the scans are united after
    each is aligned. A file is read under the month of its path where it has one: the month is taken
    from a path once a file, and rows meet it by their file.
    """
    by_header: dict[tuple, list[str]] = {}
    months = []
    for path, names, month in _headers(spark, files):
        by_header.setdefault(names, []).append(unquote(path))
        months.append((path, month))
    out = None
    # one row a file, which the driver has: small beside the rows of any file
    month_of = F.broadcast(spark.createDataFrame(months, "__path string, __month string")) if months else None
    for names, paths in sorted(by_header.items()):
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        raw = (spark.read.schema(text).options(**CSV_OPTIONS, multiLine=str(multi_line).lower())
               .csv(paths))
        tagged = raw.select("*", F.col("_metadata.file_path").alias("__path")).join(month_of, "__path", "left").drop("__path")
        part = _with_month(tagged, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def _with_month(tagged: DataFrame, schema: T.StructType) -> DataFrame:
    has = next((c for c in tagged.columns if c.upper() == "MONTH_YEAR"), None)
    month = F.coalesce(F.col("__month"), F.col(f"`{has}`")) if has else F.col("__month")
    kept = tagged.withColumn("__m", month).drop("__month", *([has] if has else []))
    return align_columns(kept.withColumnRenamed("__m", "MONTH_YEAR"), schema)


def headers(spark: SparkSession, files) -> dict[str, tuple[str, ...]]:
    """Column names of each CSV file, from its first line. Tasks read them, in one job for all files:
    the first line of the block a file begins with. Empty files have none and are left out."""
    return {unquote(path): names for path, names, _ in _headers(spark, files)}


def _headers(spark: SparkSession, files) -> list[tuple[str, tuple[str, ...], str | None]]:
    """Of each file its path as rows have it (``_metadata.file_path``), its header and the month of its path."""
    files = list(files)
    if not files:
        return []
    lines = spark.read.text(files).select("value", "_metadata.file_path", "_metadata.file_block_start").filter("file_block_start = 0")
    month = F.nullif(F.regexp_extract("file_path", MONTH_FROM_PATH, 1), F.lit(""))
    out = []
    for path, line, of in lines.groupBy("file_path").agg(F.first("value").alias("line")).select("file_path", "line", month).collect():
        line = line.lstrip("\ufeff")
        if line:
            names = [n.strip().strip('"') for n in next(csv.reader([line]))]
            out.append((path, tuple(n or f"_blank{i}" for i, n in enumerate(names)), of))
    return out


def take_first(df: DataFrame, names) -> DataFrame:
    """A5: keep the first ``len(names)`` columns by position, renamed and stripped."""
    picked = df.columns[: len(names)]
    return df.select([strip_ws(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(n)
                      for c, n in zip(picked, names)])


def assert_width(df: DataFrame, n: int, label: str = "") -> DataFrame:
    """Plan-time column-count check."""
    if len(df.columns) != n:
        raise IngestError(f"column mismatch {label}: file={len(df.columns)} table={n}")
    return df


def clean_fact_text(df: DataFrame, date_cols=("SCRAPED_DATE", "HOST_SINCE"),
                    price_col: str = "PRICE") -> DataFrame:
    """B1-B3, B11 (loader part): null tokens to '', dates to ISO text, price scrubbed."""
    def cleaned(c: str) -> Column:
        v = F.coalesce(null_tokens(F.col(c)), F.lit(""))
        if c in date_cols:
            return iso_text_dayfirst(v)
        return F.regexp_replace(v, r"[^0-9.\-]", "") if c == price_col else v

    return df.select(*(cleaned(c).alias(c) for c in df.columns))


def blank_as_null(df: DataFrame) -> DataFrame:
    """A8 (COPY NULL ''): empty text becomes NULL before the append."""
    return df.select([F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c)
                      for c, t in df.dtypes])


def keys_present(keys) -> Column:
    """B18 predicate: every natural-key field is non-blank."""
    ok: Column = F.lit(True)
    for k in keys:
        ok = ok & (F.trim(F.coalesce(F.col(k), F.lit(""))) != "")
    return ok


def split_valid(df: DataFrame, keys) -> tuple[DataFrame, DataFrame]:
    """Rows whose natural-key fields are all non-blank, and the quarantine rest.

    The rows without a key are observed, as ``refused``. What stands above the observation isn't moved below
    it: the fields of ``df`` are made once, not again in the filter, and in code small enough to be compiled.
    """
    marked = df.select("*", keys_present(keys).alias("_ok")).observe(f"keys-{uuid.uuid4().hex[:12]}", F.count_if(~F.col("_ok")).alias("refused"))
    return marked.filter("_ok").drop("_ok"), marked.filter(~F.col("_ok")).drop("_ok")
