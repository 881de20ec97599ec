"""Column-level cleansers: every function maps ``Column -> Column`` and stays
inside whole-stage codegen (no Python on rows)."""

from lodgeflow.functions.dates import (
    iso_text_dayfirst,
    month_start,
    parse_month_key,
    parse_text_date,
)
from lodgeflow.functions.text import (
    blank_to_null,
    collapse_ws,
    digits_key,
    first_non_null,
    null_tokens,
    strip_ws,
    upper_trim,
)
from lodgeflow.functions.values import (
    FALSE_TOKENS,
    TRUE_TOKENS,
    asc_pg,
    desc_pg,
    parse_bool,
    parse_money,
    ratio,
    renormalise_bool,
    safe_corr,
    stays,
    zero_to_null,
)

__all__ = [
    "FALSE_TOKENS", "TRUE_TOKENS", "asc_pg", "blank_to_null", "collapse_ws",
    "desc_pg", "digits_key", "first_non_null", "iso_text_dayfirst", "month_start",
    "null_tokens", "parse_bool", "parse_money", "parse_month_key", "parse_text_date",
    "ratio", "renormalise_bool", "safe_corr", "stays", "strip_ws",
    "upper_trim", "zero_to_null",
]
