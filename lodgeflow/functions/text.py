"""Text cleansers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens the loader treats as missing text: those that a CSV reader of the kind
# the reference uses takes as missing, and the text of a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def null_tokens(c: Column, tokens=NA_TOKENS) -> Column:
    """B1: missing-value tokens become NULL."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


# The whitespace characters stripped from both ends of a field.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c: Column) -> Column:
    """B2: strip leading/trailing whitespace of any kind (plain ``trim`` strips
    spaces only). A character-set trim, not a regex, so it stays cheap."""
    return F.trim(c, F.lit(WHITESPACE))


def upper_trim(c: Column) -> Column:
    """Upper-case and trim spaces."""
    return F.upper(F.trim(c))


def collapse_ws(c: Column) -> Column:
    """Collapse inner whitespace runs to one space and upper-case."""
    return F.upper(F.regexp_replace(c, r"\s+", " "))


def blank_to_null(c: Column) -> Column:
    """Trimmed blank text becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def first_non_null(*cols: Column) -> Column:
    """First non-NULL value (host area, else listing area)."""
    return F.coalesce(*cols)


def digits_key(c: Column, width: int = 5) -> Column:
    """Keep digits only and left-pad with zeros to ``width`` (longer keys truncate)."""
    return F.lpad(F.regexp_replace(c.cast("string"), r"\D", ""), width, "0")
