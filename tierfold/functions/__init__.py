"""Column expressions. All of them stay inside the JVM: no Python UDFs."""

from tierfold.functions.dates import age_gap_years, parse_iso_ts, try_date
from tierfold.functions.numbers import bin_label, bin_low, clip, digits_to_int, safe_ratio
from tierfold.functions.text import (
    bucket_label,
    format_feet_inches,
    normalize_label,
    normalize_name,
    parse_feet_inches,
    strip_text,
)

__all__ = [
    "age_gap_years",
    "bin_label",
    "bin_low",
    "bucket_label",
    "clip",
    "digits_to_int",
    "format_feet_inches",
    "normalize_label",
    "normalize_name",
    "parse_feet_inches",
    "parse_iso_ts",
    "safe_ratio",
    "strip_text",
    "try_date",
]
