"""Merges that are stopped at each of their steps, against the states before and after."""

import random

import pytest
from pyspark.sql import functions as F

from tierfold.operators.windowing import advance_watermark
from tierfold.sources import journal, storage, tables

SCHEMA = "k INT, v INT, p STRING"


class Stopped(Exception):
    pass


def stopping(count):
    """Stops at the given step of all that are taken; ``names`` holds those that came before."""
    names = []

    def step(name):
        if len(names) == count:
            raise Stopped(name)
        names.append(name)

    return step, names


def bag(df):
    return sorted(map(tuple, df.select("k", "v", "p").collect()), key=str)


def partitioned(spark, path, batch, **more):
    return tables.merge_partitioned(spark, path, batch, ["k"], "p", **more)


def plain(spark, path, batch, **more):
    return tables.merge_table(spark, path, batch, ["k"], **more)


@pytest.mark.parametrize("merge, partition", [(partitioned, "p"), (plain, None)])
def test_stopped_at_every_step(spark, tmp_path, merge, partition):
    path, rng, state = str(tmp_path / "table"), random.Random(1), {}
    total = 0
    for count in range(60):
        keys = rng.sample(range(30), 6) if count else range(30)
        rows = [(k, 100 * count + k, rng.choice([None, "x", "a b/c", "7"] if partition else ["-"])) for k in keys]
        batch = spark.createDataFrame(rows, SCHEMA).coalesce(2)
        before, after = dict(state), {**state, **{r[0]: r for r in rows}}
        step, names = stopping(count)
        try:
            table = merge(spark, path, batch, step=step)
            assert set(names) == set(journal.STEPS)
            total = count
        except Stopped:
            if storage.exists(spark, path) or storage.exists(spark, f"{path}.journal/plan.json"):
                seen = bag(tables.stored(spark, path, batch, partition))
                assert seen == sorted((before if len(names) < 2 else after).values(), key=str)
            else:
                assert len(names) < 2
            table = merge(spark, path, batch)  # the same batch again
        state = after
        assert bag(table) == sorted(state.values(), key=str)
        assert not storage.exists(spark, f"{path}.journal")
        if total:
            break
    assert total >= 5


def test_next_batch_finishes_a_stopped_one(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, 1, "a"), (2, 2, "a"), (3, 3, "b")], SCHEMA)
    partitioned(spark, path, first)
    moved = spark.createDataFrame([(1, 10, "c"), (2, 20, "c")], SCHEMA)
    with pytest.raises(Stopped):
        partitioned(spark, path, moved, step=stopping(3)[0])
    other = spark.createDataFrame([(3, 30, "b")], SCHEMA)
    assert bag(partitioned(spark, path, other)) == [(1, 10, "c"), (2, 20, "c"), (3, 30, "b")]
    assert sorted(storage.subfolders(spark, path)) == ["p=b", "p=c"]


def test_reset_forgets_a_planned_merge(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, 1, "a")], SCHEMA)
    with pytest.raises(Stopped):
        partitioned(spark, path, rows, step=stopping(2)[0])
    tables.reset(spark, path)
    assert not journal.recover(spark, path) and not storage.exists(spark, path)


def test_rejects_and_marks_of_a_run_again(spark, tmp_path):
    path = str(tmp_path / "rejects")
    rows = spark.createDataFrame([(1, 1, "run1"), (2, 2, "run2")], SCHEMA)
    tables.replace_partitions(spark, path, rows, "p")
    tables.replace_partitions(spark, path, rows.where("k = 1").limit(0), "p", ["run1"])
    assert bag(spark.read.parquet(path)) == [(2, 2, "run2")]
    state = str(tmp_path / "state")
    for day in ("2024-01-01", "2024-02-01", "2024-01-15", "2024-03-01"):
        dated = spark.createDataFrame([(day,)], "d STRING").select(F.col("d").cast("date").alias("d"))
        tables.save_watermark(advance_watermark(dated, "d"), state)
        assert str(tables.load_state(spark, state).first()[0]) == day
    assert len(storage.subfolders(spark, state)) == 2
    storage.write_text(spark, f"{state}/{tables.GENERATION}{9:012d}/part-0.parquet", "PAR1")
    assert str(tables.load_state(spark, state).first()[0]) == "2024-03-01"
