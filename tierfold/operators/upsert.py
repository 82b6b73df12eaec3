"""Keyed upserts as joins, since plain parquet tables have no MERGE.

The target is the large side. It is narrowed by a semi-join on the source keys, which Catalyst
runs as a broadcast when the batch is small, so an incremental batch never shuffles the target.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALWAYS, NEWER, VERSION, NEVER = "always", "newer", "version", "never"


def _old(column: str) -> str:
    return f"_old_{column}"


def is_later(order: Sequence[str]) -> Column:
    """Source versions compare higher, column by column; equal or unknown is not later."""

    def step(rest: Column | None, c: str) -> Column:
        new, old = F.col(c), F.col(_old(c))
        later = new > old
        return later if rest is None else later | ((new == old) & rest)

    return F.coalesce(reduce(step, reversed(list(order)), None), F.lit(False))


def _matched(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """The source with the given columns of its target row, and ``_known`` where there is one."""
    known = (
        target.join(source.select(*keys), list(keys), "left_semi")
        .select(*keys, *(F.col(c).alias(_old(c)) for c in columns))
        .withColumn("_known", F.lit(True))
    )
    return source.join(known, list(keys), "left")


def _wins(order: Sequence[str], when: str) -> Column:
    """Whether a source row replaces the target row whose ``order`` columns are beside its own."""
    if when == NEWER:
        return F.col(_old(order[0])).isNull() | is_later(order)
    return F.lit(when == ALWAYS) if when in (ALWAYS, NEVER) else is_later(order)


def met_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    when: str,
    partition: str,
) -> DataFrame:
    """The keys that both sides hold, with the partition of the source's row, ``_known`` (whether it
    is known to replace the target's, for any of the key's rows) and ``_old_<partition>``, where the
    target's row is. No other columns travel, and a small source does not shuffle the target."""
    old = target.select(*keys, *(F.col(c).alias(_old(c)) for c in dict.fromkeys([*order, partition])))
    met = source.select(*dict.fromkeys([*keys, *order, partition])).join(old, list(keys))
    known = F.max(_wins(order, when)).over(Window.partitionBy(*keys)).alias("_known")
    return met.select(*dict.fromkeys([*keys, partition]), known, _old(partition))


def changed_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    when: str = VERSION,
) -> DataFrame:
    """The source rows that are new to the target or supersede its row."""
    if when == ALWAYS:
        return source
    if when == NEVER:
        return new_rows(source, target, keys)
    found = _matched(source, target, keys, order)
    return found.where(F.col("_known").isNull() | _wins(order, when)).select(*source.columns)


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows whose key the target does not have."""
    known = target.join(source.select(*keys), list(keys), "left_semi").select(*keys).distinct()
    return source.join(known, list(keys), "left_anti")


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Give a batch the columns of the target, missing ones as NULL.

    A column that the target lacks raises: dropping it would lose its values without a word.
    """
    unknown = [c for c in df.columns if c not in like.columns]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")
    return df.select(
        *(
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema
        )
    )


def check_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key occurs twice: which of its rows a merge would store is undefined."""
    twice = batch.groupBy(*keys).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"the batch holds the key {[twice[k] for k in keys]} more than once")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    when: str = ALWAYS,
    order: Sequence[str] = (),
) -> DataFrame:
    """Target with the source rows applied.

    ``when`` says which matched rows are replaced: ``always``; ``newer`` (target value NULL or
    lower in ``order[0]``); ``version`` (lower in ``order``, compared left to right); ``never``
    (insert new keys only). Unmatched source rows are inserted. Keys must be unique in the
    source: run ``latest_per_key`` first.
    """
    applied = changed_rows(align(source, target), target, keys, order, when)
    if when == NEVER:
        return target.unionByName(applied)
    kept = target.join(applied.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(applied)
