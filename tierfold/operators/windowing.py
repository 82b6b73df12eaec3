"""Batch watermark, day spines and incremental windows."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25
DAYS_AHEAD = 7


def resolve_watermark(*candidates: tuple[DataFrame, str]) -> DataFrame:
    """One row: the latest date over all candidate (table, column) pairs; NULL if there is none.

    Each candidate is reduced to one row before they meet.
    """
    latest = [df.agg(F.max(F.col(c).cast("date")).alias("last_event_date")) for df, c in candidates]
    return reduce(DataFrame.unionByName, latest).agg(
        F.max("last_event_date").alias("last_event_date")
    )


def advance_watermark(batch: DataFrame, column: str, cap: date | None = None) -> DataFrame:
    """One row with the batch's latest date; no row for an empty batch.

    ``cap`` keeps the mark from passing a given day. Loads do not use it: their mark is the latest
    date they have seen.
    """
    latest = F.max(F.col(column).cast("date"))
    if cap is not None:
        latest = F.when(latest > F.lit(cap), F.lit(cap)).otherwise(latest)
    return batch.agg(latest.alias("last_event_date")).where("last_event_date IS NOT NULL")


def backfill_start(end: date, years: int) -> date:
    return end - timedelta(days=int(DAYS_PER_YEAR * years))


def day_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per calendar day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("day")
    )


def load_bounds(
    watermark: date | None, today: date, overlap_days: int = 1, years_back: int = 7
) -> tuple[date, date]:
    """First and last day to load: the overlap window, or the backfill when there is no mark."""
    if watermark is None:
        return backfill_start(today, years_back), today
    return watermark - timedelta(days=overlap_days), today + timedelta(days=DAYS_AHEAD)


def incremental_window(
    df: DataFrame, column: str, bounds: tuple[date, date], year_column: str | None = None
) -> DataFrame:
    """Rows dated within the bounds.

    The bounds are literals on the bare column, so they reach the scan; with a partition column
    of years the scan also skips every other year.
    """
    first, last = bounds
    inside = (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(last + timedelta(days=1)))
    if year_column:
        inside = F.col(year_column).between(first.year, last.year) & inside
    return df.where(inside)
