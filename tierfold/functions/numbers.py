"""Clipping, binning and ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0.0 where the denominator is not positive."""
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def clip(value: Column, low: int, high: int) -> Column:
    """Bound a value; NULL stays NULL (``greatest``/``least`` would skip it)."""
    return F.when(value > high, F.lit(high)).when(value < low, F.lit(low)).otherwise(value)


def _binned(value: Column, edges: Sequence[int], results: Sequence, kind: str) -> Column:
    """The result of the bin a value falls in. ``value`` appears once per bin, so it should be a
    plain column: a long expression repeated that often is more code than the JIT compiles."""
    chain = F.when(value < edges[0], F.lit(None).cast(kind))
    for high, result in zip(edges[1:-1], results):
        chain = chain.when(value < high, F.lit(result))
    return chain.when(value <= edges[-1], F.lit(results[-1]))


def bin_label(value: Column, edges: Sequence[int]) -> Column:
    """Interval text: half-open bins, the last one closed; NULL outside the edges."""
    labels = [f"[{lo},{hi})" for lo, hi in zip(edges, edges[1:])]
    labels[-1] = labels[-1][:-1] + "]"
    return _binned(value, edges, labels, "string")


def bin_low(value: Column, edges: Sequence[int]) -> Column:
    """Lower edge of the bin, for sorting bins by number rather than by label."""
    return _binned(value, edges, edges[:-1], "int")


def digits_to_int(text: Column) -> Column:
    """Integer from text that is digits only, else NULL."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
