"""Date cleansers (B3, B4, B13) written as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgeflow.functions.text import null_tokens, strip_ws

# Accepted date layouts. ``\z`` anchors at the true end of input
# (Java ``$`` would also accept a trailing newline).
_DATE_SHAPE = r"^(\d{4}-\d{1,2}-\d{1,2}|\d{1,2}-\d{1,2}-\d{4})\z"
_ISO_STRICT = r"^\d{4}-\d{2}-\d{2}\z"
_DMY_ANY_SEP = r"^\d{1,2}[./-]\d{1,2}[./-]\d{4}\z"
_MONTH_KEY = r"^\d{2}_\d{4}\z"


def iso_text_dayfirst(c: Column) -> Column:
    """Loader normaliser, text in / ISO text out, '' when not a day-first date.

    Separators ``.`` and ``/`` count as ``-``; ``Y-m-d`` and ``d-m-Y`` are
    accepted, fields are zero-padded, and only ``1<=M<=12`` and ``1<=D<=31`` are
    checked (so ``31-02-2020`` passes here and is rejected later). One anchored
    shape check and one split; the 4-digit field tells the layout apart.
    """
    s = F.translate(strip_ws(F.coalesce(null_tokens(c), F.lit(""))), "./", "--")
    parts = F.split(s, "-")
    first, mid, last = F.get(parts, 0), F.get(parts, 1), F.get(parts, 2)
    year_first = F.length(first) == 4
    year = F.when(year_first, first).otherwise(last)
    m_int = mid.try_cast("int")
    d_int = F.when(year_first, last).otherwise(first).try_cast("int")
    ok = s.rlike(_DATE_SHAPE) & m_int.between(1, 12) & d_int.between(1, 31)
    iso = F.concat_ws("-", year, F.lpad(m_int.cast("string"), 2, "0"),
                      F.lpad(d_int.cast("string"), 2, "0"))
    return F.when(ok, iso).otherwise(F.lit(""))


def parse_text_date(c: Column, strict: bool = False) -> Column:
    """Text to DATE; ISO ``yyyy-MM-dd`` or day-first with ``.``/``/``/``-``.

    Anything else is NULL. Impossible dates (``2020-02-31``) are NULL, or raise
    when ``strict=True`` (ANSI ``to_date``).
    """
    to_date = F.to_date if strict else F.try_to_date
    dmy = F.regexp_replace(c, r"[./]", "-")
    return (F.when(c.rlike(_ISO_STRICT), to_date(c, "yyyy-MM-dd"))
            .when(c.rlike(_DMY_ANY_SEP), to_date(dmy, "d-M-yyyy")))


def parse_month_key(c: Column) -> Column:
    """``MM_YYYY`` month key to the first day of that month, else NULL."""
    return F.when(c.rlike(_MONTH_KEY),
                  F.try_to_date(F.concat(F.lit("01_"), c), "dd_MM_yyyy"))


def month_start(c: Column) -> Column:
    """First day of the month as DATE (``date_trunc`` would return a timestamp)."""
    return F.trunc(c, "month")
