"""Value cleansers and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted boolean spellings.
TRUE_TOKENS = ("t", "true", "1", "y", "yes")
FALSE_TOKENS = ("f", "false", "0", "n", "no")


def parse_bool(c: Column, true_set=TRUE_TOKENS, false_set=FALSE_TOKENS) -> Column:
    """Text to boolean; unknown or blank spellings are NULL."""
    v = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    return F.when(v.isin(*true_set), F.lit(True)).when(v.isin(*false_set), F.lit(False))


def renormalise_bool(c: Column, true_set=TRUE_TOKENS) -> Column:
    """NULL stays NULL, otherwise membership of the lower-cased text in ``true_set``.

    On a real boolean column this is the identity.
    """
    return F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.lower(F.nullif(c.cast("string"), F.lit(""))).isin(*true_set))


def parse_money(c: Column, precision: int = 18, scale: int = 4) -> Column:
    """Drop everything but digits, ``.`` and ``-``; blank is NULL; cast to decimal.

    Text that still is not a number (``1-2``) or does not fit the precision gives
    NULL; ``models.split_silver`` routes such rows to quarantine.
    """
    digits = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[^0-9.\-]", "")
    return F.nullif(digits, F.lit("")).try_cast(T.DecimalType(precision, scale))


def zero_to_null(c: Column) -> Column:
    """Zero becomes NULL."""
    return F.nullif(c, F.lit(0))


def stays(available: Column, free_days: Column, days: int = 30) -> Column:
    """Estimated booked nights: ``max(0, days - free_days)`` when available, else 0."""
    booked = F.greatest(F.lit(0), F.lit(days) - F.coalesce(free_days, F.lit(0)))
    return F.when(available, booked).otherwise(F.lit(0))


def ratio(a: Column, b: Column) -> Column:
    """E14 as DOUBLE: exact operands converted once, one IEEE division."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation, NULL for constant input or a single row.

    ``corr`` raises DIVIDE_BY_ZERO under ANSI on constant input; this form
    returns the same value otherwise.
    """
    den = F.stddev_pop(a) * F.stddev_pop(b)
    return F.covar_pop(a, b) / F.nullif(den, F.lit(0.0))


def desc_pg(c) -> Column:
    """Descending with NULLs first (the reference engine's default)."""
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def asc_pg(c) -> Column:
    """Ascending with NULLs last."""
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()

