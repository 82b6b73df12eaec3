"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _descending(columns: Sequence[str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in columns]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    tiebreak: Sequence[str | Column] = (),
) -> DataFrame:
    """The row with the highest ``order`` values per key; NULLs count as oldest.

    ``row_number() = 1`` lets Catalyst limit each key inside every map task before the shuffle
    (WindowGroupLimit), so a key that holds much of the table still sends one row per task.
    ``tiebreak`` columns make the choice repeatable when versions are equal.
    """
    by = [*_descending(order), *_descending(tiebreak)] or [F.lit(0)]
    ranked = Window.partitionBy(*keys).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def version_columns(df: DataFrame) -> list[str]:
    """Columns that order versions: load day and run where present, else the event date."""
    present = [c for c in ("ingestion_date", "run_id") if c in df.columns]
    return present or [c for c in ("event_date",) if c in df.columns]


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()
