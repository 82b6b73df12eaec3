"""Values at given ranks of a column that is too large to be put in order in one place.

Equal values are counted first. The counts are dealt over ranges of the values, one range a task, and
written, since the bounds of ranges are drawn anew whenever they are computed. The sizes of the
ranges tell which of them holds a wanted rank and how many rows come before it; only those are put
in order. There is no step through which all values of a group go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierfold.sources import storage

N, RANGE = "_n", "_range"


def ranged_counts(df: DataFrame, value: str, dims: Sequence[str] = ()) -> DataFrame:
    """(*dims, value, _n, _range): each value with its number of rows and the range it lies in.

    Ranges follow each other in the order of ``dims`` and the value; there are as many as shuffle
    partitions. The table is written below the shared root and stays there for those who read it.
    """
    spark = df.sparkSession
    counted = df.groupBy(*dims, value).agg(F.count(F.lit(1)).alias(N))
    ranged = counted.repartitionByRange(*dims, value).withColumn(RANGE, F.spark_partition_id())
    path = storage.new_folder(spark, "ranges")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, dims: Sequence[str], *more: str) -> DataFrame:
    """Join on columns of which the dimensions may be NULL; the left side's columns stay."""
    renamed = right.select(*(F.col(c).alias(f"_r_{c}" if c in (*dims, *more) else c) for c in right.columns))
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in dims] + [F.col(c) == F.col(f"_r_{c}") for c in more]
    return left.join(renamed, reduce(lambda a, b: a & b, on)).drop(*(f"_r_{c}" for c in (*dims, *more)))


def at_ranks(
    ranged: DataFrame, value: str, wanted: Callable[[Column], Column], dims: Sequence[str] = ()
) -> DataFrame:
    """(*dims, rank, value, rows): the values at ranks of each group, NULLs left out.

    ``wanted`` gives the ranks, an array of whole numbers from 0 on, from the group's number of
    rows. Ranks that a group does not have give no row.
    """
    known = ranged.where(F.col(value).isNotNull())
    sizes = known.groupBy(*dims, RANGE).agg(F.sum(N).alias(N))
    ordered = F.array_sort(F.collect_list(F.struct(RANGE, N))).alias("ranges")  # one entry a range
    groups = sizes.groupBy(*dims).agg(ordered, F.sum(N).alias("rows"))
    nothing = F.struct(
        F.lit(0).cast("long").alias("before"), F.lit(None).cast("int").alias(RANGE), F.lit(None).cast("long").alias("begin")
    )

    def step(rank: Column) -> Callable[[Column, Column], Column]:
        def look(at: Column, x: Column) -> Column:
            here = (rank >= at["before"]) & (rank < at["before"] + x[N])
            return F.struct(
                (at["before"] + x[N]).alias("before"),
                F.when(here, x[RANGE]).otherwise(at[RANGE]).alias(RANGE),
                F.when(here, at["before"]).otherwise(at["begin"]).alias("begin"),
            )

        return look

    def found(rank: Column) -> Column:
        at = F.aggregate("ranges", nothing, step(rank))
        return F.struct(rank.alias("rank"), at[RANGE].alias(RANGE), at["begin"].alias("begin"))

    ranks = F.array_distinct(F.transform(wanted(F.col("rows")), lambda r: r.cast("long")))
    hits = groups.select(*dims, "rows", F.inline(F.transform(ranks, found))).where(f"{RANGE} IS NOT NULL")
    hits = hits.groupBy(*dims, "rows", RANGE, "begin").agg(F.collect_list("rank").alias("ranks"))
    chosen = _same(known, hits, dims, RANGE)
    earlier = Window.partitionBy(*dims, RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("begin") + F.coalesce(F.sum(N).over(earlier), F.lit(0))
    placed = chosen.withColumn("_first", first)
    here = F.filter("ranks", lambda r: (r >= F.col("_first")) & (r < F.col("_first") + F.col(N)))
    return placed.select(*dims, F.explode(here).alias("rank"), value, "rows")


def percentiles(
    ranged: DataFrame, value: str, shares: dict[str, float], dims: Sequence[str] = ()
) -> DataFrame:
    """(*dims, one column per share): exact interpolated percentiles of a numeric measure, as
    doubles. A group without a value has no row."""
    position = lambda rows, share: (rows - 1) * F.lit(float(share))

    def wanted(rows: Column) -> Column:
        return F.array(*(f(position(rows, s)) for s in shares.values() for f in (F.floor, F.ceil)))

    def interpolated(share: float) -> Column:
        at = position(F.col("rows"), share)
        low, high = (F.max(F.when(F.col("rank") == f(at), F.col(value).cast("double"))) for f in (F.floor, F.ceil))
        return low + (high - low) * F.max(at - F.floor(at))

    found = at_ranks(ranged, value, wanted, dims)
    return found.groupBy(*dims).agg(*(interpolated(s).alias(name) for name, s in shares.items()))
