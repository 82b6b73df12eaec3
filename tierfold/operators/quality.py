"""Null profiles, sparse columns, reject gates and partition checks: one pass each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPARSE_THRESHOLD = 0.98


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of NULLs of each column."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns))


def null_ratio(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the share of NULLs of each column; 0.0 for an empty input."""
    rows = F.count(F.lit(1))
    return df.agg(
        *(
            F.when(rows > 0, F.count_if(F.col(c).isNull()) / rows).otherwise(F.lit(0.0)).alias(c)
            for c in columns or df.columns
        )
    )


def to_long(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """Turn a one-row profile into (name, value) rows."""
    return one_row.unpivot([], one_row.columns, name, value)


def dense_columns(
    df: DataFrame, candidates: Sequence[str], threshold: float = SPARSE_THRESHOLD
) -> list[str]:
    """The candidates whose share of NULLs lies below the threshold (runs one aggregate)."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return []
    ratios = null_ratio(df, present).first()
    return [c for c in present if ratios[c] < threshold]


def prune_sparse(
    df: DataFrame, keep: Iterable[str], threshold: float = SPARSE_THRESHOLD
) -> DataFrame:
    """Drop columns that are almost always NULL; ``keep`` is never dropped."""
    protected = set(keep)
    dense = set(dense_columns(df, [c for c in df.columns if c not in protected], threshold))
    return df.select(*(c for c in df.columns if c in protected or c in dense))


def all_present(required: Sequence[str]) -> Column:
    """Whether a row has all of the required columns."""
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in required))


def split_rejects(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows miss one of the required columns."""
    complete = all_present(required)
    return df.where(complete), df.where(~complete)


def reject_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row with valid and rejected counts, in a single pass."""
    complete = all_present(required)
    return df.agg(F.count_if(complete).alias("valid"), F.count_if(~complete).alias("rejected"))


def partition_consistency(df: DataFrame, stored: str, date_column: str) -> DataFrame:
    """Rows per (stored partition year, year derived from the date)."""
    return df.groupBy(
        F.col(stored).alias("stored_event_year"),
        F.year(date_column).alias("derived_event_year"),
    ).count()
