"""Array elements as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(
    df: DataFrame, keep: Sequence[Column | str], array: Column | str, value: str,
    position: str = "position",
) -> DataFrame:
    """One row per element; a missing or empty array gives none.

    Equal to ``posexplode``, for which Catalyst infers a not-empty filter on the array and pushes
    it down to the scan. Where the array comes out of a document, that would parse every document
    a second and a third time; filtering on the position avoids it.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, value))
    return rows.where(F.col(position).isNotNull())
