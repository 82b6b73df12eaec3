"""Lenient date and time parsing that yields NULL on bad input, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted timestamp shapes. Within a shape they are tried in this order; a zone
# written as Z is tried as it is first and as +00:00 second.
ZONED = {True: "yyyy-MM-dd'T'HH:mm:ssX", False: "yyyy-MM-dd'T'HH:mmX"}
OFFSET = {True: "yyyy-MM-dd'T'HH:mm:ssXXX", False: "yyyy-MM-dd'T'HH:mmXXX"}
PLAIN = {True: "yyyy-MM-dd HH:mm:ss", False: "yyyy-MM-dd HH:mm"}


def parse_iso_ts(text: Column) -> Column:
    """Timestamp from ISO-like text with or without seconds and zone, else NULL.

    Fractional seconds belong to none of the accepted shapes. A text is tried only against the
    patterns of its own shape, since a failed attempt costs many times a successful one.
    """

    def attempt(value: Column, pattern: str) -> Column:
        return F.try_to_timestamp(value, F.lit(pattern))

    def shaped(seconds: bool) -> Column:
        zoned = F.coalesce(
            attempt(text, ZONED[seconds]),
            attempt(F.regexp_replace(text, "Z$", "+00:00"), OFFSET[seconds]),
        )
        plain = attempt(F.replace(text, F.lit("T"), F.lit(" ")), PLAIN[seconds])
        return F.when(text.rlike(r"(Z|[+-]\d{2}(:?\d{2})?)$"), zoned).otherwise(plain)

    return F.when(text.rlike(r"\d{2}:\d{2}:\d{2}"), shaped(True)).otherwise(shaped(False))


def try_date(text: Column) -> Column:
    """Date part of a date or timestamp text, else NULL."""
    return text.try_cast("date")


def age_gap_years(on: Column, born: Column, other_born: Column) -> Column:
    """Age difference in years on a given day; NULL when either birth date is unknown."""
    return F.months_between(on, born) / F.lit(12.0) - F.months_between(on, other_born) / F.lit(12.0)
