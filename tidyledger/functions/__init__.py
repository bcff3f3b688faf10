"""Column functions; every one is an expression of built-in Spark functions."""

from tidyledger.functions.casts import binary_flag, to_double, to_integer, to_key
from tidyledger.functions.dates import canonical_date, month_key, parse_date, parse_timestamp
from tidyledger.functions.numbers import double_text, ieee_ratio, ratio, report_value, round_scaled
from tidyledger.functions.text import TIERS, TYPOS, clean_text, map_typos, strip_first_non_letter

__all__ = [
    "TIERS",
    "TYPOS",
    "binary_flag",
    "canonical_date",
    "clean_text",
    "double_text",
    "ieee_ratio",
    "map_typos",
    "month_key",
    "parse_date",
    "parse_timestamp",
    "ratio",
    "report_value",
    "round_scaled",
    "strip_first_non_letter",
    "to_double",
    "to_integer",
    "to_key",
]
