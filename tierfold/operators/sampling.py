"""Workload profile over days and documents, and evenly spaced day samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.operators import ranks


def percentile_by(
    df: DataFrame, dims: Sequence[str], value: str, share: float, alias: str
) -> DataFrame:
    """Number of rows, mean and exact interpolated percentile of a numeric measure per group.

    The percentile comes from ranges of the values that are put in order one by one, so a group may
    have any number of rows and of distinct values. A group without values has neither.
    """
    ranged = ranks.ranged_counts(df.select(*dims, value), value, dims)
    known = F.when(F.col(value).isNotNull(), F.col("_n"))
    totals = ranged.groupBy(*dims).agg(
        F.sum("_n").alias("rows"), F.try_divide(F.sum(F.col(value) * F.col("_n")), F.sum(known)).alias("mean")
    )
    found = ranks.percentiles(ranged, value, {alias: share}, dims)
    if not dims:
        return totals.select("rows", "mean", found.scalar().alias(alias))
    theirs = found.select(*(F.col(d).alias(f"_r_{d}") for d in dims), alias)
    same = reduce(lambda a, b: a & b, (F.col(d).eqNullSafe(F.col(f"_r_{d}")) for d in dims))
    return totals.join(theirs, same, "left").drop(*(f"_r_{d}" for d in dims))


def workload_profile(
    documents: DataFrame, spine: DataFrame, sampled: DataFrame | None = None
) -> DataFrame:
    """One row about documents (day, num_fights, chars) over a spine of days.

    Averages come from the ``sampled`` days, or from all of them; totals are projected on the
    whole spine. Days without documents count as zero. Documents are reduced per day before
    anything else, so what follows works on one row per calendar day.
    """
    per_day = documents.groupBy("day").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("num_fights").alias("fights"),
        F.sum("chars").alias("chars"),
    )
    days = spine.join(per_day, "day", "left").na.fill(0, ["events", "fights", "chars"])
    if sampled is not None:
        picked = sampled.select("day", F.lit(True).alias("_picked"))
        unpicked = [F.when(F.col("_picked"), F.col(c)).alias(c) for c in ("events", "fights", "chars")]
        days = days.join(picked, "day", "left").select("day", *unpicked)
    events = F.sum("events")
    measured = days.agg(
        F.count(F.lit(1)).alias("days_total"),
        F.count("events").alias("sample_days"),
        events.alias("sampled_events"),
        F.avg("events").alias("avg_events_per_day"),
        F.when(events > 0, F.sum("fights") / events).alias("avg_fights_per_event"),
        F.coalesce(F.floor(F.try_divide(F.sum("chars"), events)), F.lit(0)).alias(
            "avg_payload_chars"
        ),
        F.percentile("events", 0.9).alias("p90_events_per_day"),
    )
    projected = F.rint(F.col("avg_events_per_day") * F.col("days_total")).cast("long")
    return (
        measured.withColumn("estimated_events_total", projected)
        .withColumn("estimated_requests_total", F.col("days_total") + projected)
        .withColumn("estimated_total_chars", projected * F.col("avg_payload_chars"))
    )


def even_sample(days: DataFrame, column: str, k: int) -> DataFrame:
    """k evenly spaced values out of the ordered distinct values of a column of any size.

    Positions are i * (n - 1) / (k - 1) rounded half-even, first and last included; all values
    when there are at most k, the first alone when k is 1.
    """

    def positions(n: Column) -> Column:
        if k <= 1:
            return F.array(F.lit(0))
        spread = F.transform(
            F.sequence(F.lit(0), F.lit(k - 1)), lambda step: F.rint(step * (n - 1) / F.lit(k - 1)).cast("long")
        )
        every = F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(k)) - 1)
        return F.when(n <= k, every).otherwise(spread)

    ranged = ranks.ranged_counts(days.select(column).distinct(), column)
    return ranks.at_ranks(ranged, column, positions).select(column)
