"""Upserts as expressions and into folders, against a row-by-row merge."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierfold.operators import upsert as U
from tierfold.operators.dedupe import latest_per_key, version_columns
from tierfold.sources import storage, tables

SCHEMA = "k INT, j INT, day DATE, run STRING, v INT, year INT"
KEYS, ORDER = ["k", "j"], ["day", "run"]


def rows(seed, keys, salt):
    rng = random.Random(seed)
    out = []
    for k in keys:
        day = rng.choice([None, date(2020, 1, 1), date(2021, 1, 1), date(2022, 1, 1)])
        out.append((k, k % 2, day, rng.choice([None, "a", "b"]), salt + k, day.year if day else None))
    return out


TARGET, SOURCE = rows(1, range(60), 1000), rows(2, range(30, 90), 2000)


def merged(target, source, when):
    result = {r[:2]: r for r in target}
    for s in source:
        t = result.get(s[:2])
        if t is None or when == U.ALWAYS:
            result[s[:2]] = s
        elif when == U.NEWER:
            if t[2] is None or (s[2] is not None and s[2] > t[2]):
                result[s[:2]] = s
        elif when == U.VERSION and None not in (s[2], t[2]):
            if s[2] > t[2] or (s[2] == t[2] and None not in (s[3], t[3]) and s[3] > t[3]):
                result[s[:2]] = s
    return sorted(result.values(), key=str)


def bag(df):
    return sorted((tuple(r) for r in df.select("k", "j", "day", "run", "v", "year").collect()), key=str)


MODES = [(U.ALWAYS, []), (U.NEWER, ["day"]), (U.VERSION, ORDER), (U.NEVER, [])]


@pytest.mark.parametrize("when, order", MODES)
def test_upsert(spark, when, order):
    t, s = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    once = U.upsert(t, s, KEYS, when, order)
    assert bag(once) == merged(TARGET, SOURCE, when)
    assert bag(U.upsert(once, s, KEYS, when, order)) == bag(once)
    changed = U.changed_rows(s, t, KEYS, order, when)
    assert set(bag(changed)) == {r for r in merged(TARGET, SOURCE, when) if r[4] >= 2000}


@pytest.mark.parametrize("when, order", MODES)
def test_merge_into_partitioned_folder(spark, tmp_path, when, order):
    t, s = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    path = str(tmp_path / "table")
    assert bag(tables.merge_partitioned(spark, path, t, KEYS, "year")) == sorted(TARGET, key=str)
    for _ in range(2):
        table = tables.merge_partitioned(spark, path, s, KEYS, "year", when, order)
        assert bag(table) == merged(TARGET, SOURCE, when)


def test_a_moved_row_leaves_its_old_partition(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([(1, 1, None, "a", 1, 2020), (2, 0, None, "a", 2, 2021)], SCHEMA)
    tables.merge_partitioned(spark, path, first, KEYS, "year")

    def untouched():
        return {f for f in spark.read.parquet(path).inputFiles() if "year=2021" in f}

    before = untouched()
    moved = spark.createDataFrame([(1, 1, None, "b", 3, 2022)], SCHEMA)
    table = tables.merge_partitioned(spark, path, moved, KEYS, "year")
    assert bag(table) == [(1, 1, None, "b", 3, 2022), (2, 0, None, "a", 2, 2021)]
    assert not storage.exists(spark, f"{path}/year=2020")
    assert untouched() == before != set()
    nothing = tables.merge_partitioned(spark, path, moved.limit(0), KEYS, "year")
    assert bag(nothing) == bag(table)


def test_first_load_may_be_empty(spark, tmp_path):
    path = str(tmp_path / "table")
    s = spark.createDataFrame(SOURCE, SCHEMA)
    assert tables.merge_partitioned(spark, path, s.limit(0), KEYS, "year").count() == 0
    assert bag(tables.merge_partitioned(spark, path, s, KEYS, "year")) == sorted(SOURCE, key=str)


def test_batches_are_aligned_to_the_target(spark):
    t = spark.createDataFrame([(1, "a", "x")], "k INT, name STRING, venue STRING")
    s = spark.createDataFrame([(2, "b")], "k BIGINT, name STRING")
    result = U.upsert(t, s, ["k"])
    assert result.schema.simpleString() == "struct<k:int,name:string,venue:string>"
    assert sorted(map(tuple, result.collect())) == [(1, "a", "x"), (2, "b", None)]
    with pytest.raises(ValueError, match="extra"):
        U.upsert(t, s.withColumn("extra", F.lit(7)), ["k"])


def test_repeated_keys_in_a_batch_raise(spark, tmp_path):
    twice = spark.createDataFrame(TARGET[:2] + TARGET[:1], SCHEMA)
    for merge, more in ((tables.merge_partitioned, ["year"]), (tables.merge_table, [])):
        path = str(tmp_path / merge.__name__)
        with pytest.raises(ValueError, match="more than once"):
            merge(spark, path, twice, KEYS, *more)
        merge(spark, path, twice.distinct(), KEYS, *more)
        with pytest.raises(ValueError, match="more than once"):
            merge(spark, path, twice, KEYS, *more)
        assert spark.read.parquet(path).count() == 2


def test_partition_names_are_kept_and_emptied(spark, tmp_path):
    path = str(tmp_path / "names")
    values = ["007", "7", "a b/c:1", "a=b%", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k INT, p STRING")
    tables.merge_partitioned(spark, path, rows, ["k"], "p")
    moved = spark.createDataFrame([(i, "x") for i in range(5)], "k INT, p STRING")
    some = tables.merge_partitioned(spark, path, moved.where("k IN (0, 2)"), ["k"], "p")
    assert sorted(map(tuple, some.collect())) == [(0, "x"), (1, "7"), (2, "x"), (3, "a=b%"), (4, None)]
    table = tables.merge_partitioned(spark, path, moved, ["k"], "p")
    assert sorted(map(tuple, table.collect())) == [(i, "x") for i in range(5)]


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, None, "z", 0), (1, date(2020, 1, 1), "a", 1), (1, date(2020, 1, 1), "b", 2),
         (2, None, None, 3), (2, None, "a", 4)],
        "k INT, ingestion_date DATE, run_id STRING, v INT",
    )
    latest = latest_per_key(df, ["k"], version_columns(df), ["v"])
    assert sorted(r.v for r in latest.collect()) == [2, 4]
    assert version_columns(df.select("k", F.lit(datetime.now()).alias("event_date"))) == ["event_date"]
    assert version_columns(df.select("k")) == []


def test_hot_key_is_limited_before_the_shuffle(spark, plan):
    df = spark.range(9000).select((F.col("id") * (F.col("id") % 3 > 0).cast("int")).alias("k"), "id")
    latest = latest_per_key(df, ["k"], ["id"])
    steps = [line for line in plan(latest).splitlines() if "WindowGroupLimit" in line]
    assert len(steps) == 2 and "Partial" in steps[1]
    assert latest.where("k = 0").first().id == 8997


def test_small_batches_do_not_shuffle_the_target(spark, plan, tmp_path):
    path = str(tmp_path / "big")
    spark.range(1000).withColumn("v", F.lit(0)).write.parquet(path)
    batch = str(tmp_path / "batch")
    spark.range(5).withColumn("v", F.lit(1)).write.parquet(batch)
    result = U.upsert(spark.read.parquet(path), spark.read.parquet(batch), ["id"])
    assert "BroadcastHashJoin" in plan(result) and "hashpartitioning" not in plan(result)


def test_batch_that_applies_as_a_whole_is_staged_once(spark, tmp_path, monkeypatch):
    """What tells the touched partitions holds keys only, and no row's other columns."""
    path, staged, real = str(tmp_path / "t"), {}, tables.storage.staged

    def watched(df, purpose):
        staged.setdefault(purpose, []).append(df.columns)
        return real(df, purpose)

    monkeypatch.setattr(tables.storage, "staged", watched)
    rows = spark.range(20).select("id", (F.col("id") % 3).cast("int").alias("p"), F.repeat(F.lit("x"), 50).alias("text"))
    tables.merge_partitioned(spark, path, rows, ["id"], "p")
    moved = rows.where("id < 5").withColumns({"p": F.lit(7), "text": F.lit("new")})
    table = tables.merge_partitioned(spark, path, moved, ["id"], "p")
    assert staged["applied"] == [["id", "p", "_known", "_old_p"]]
    want = [(k, 7, "new") if k < 5 else (k, k % 3, "x" * 50) for k in range(20)]
    assert sorted(tuple(r) for r in table.select("id", "p", "text").collect()) == want


@pytest.mark.parametrize("when, order", MODES)
def test_large_merges_write_rows_without_gathering_them(spark, tmp_path, monkeypatch, when, order):
    """Whole rows of a batch meet neither the target nor a shuffle; files that would be small are gathered."""
    tables_of, staged, stage, replace = {}, [], tables.storage.staged, tables.journal.replace

    def watched(df, purpose):
        staged.extend((df.columns, df.count()) for _ in [0] if purpose == "applied")
        return stage(df, purpose)

    def replaced(spark, path, rows, *args, **more):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        replace(spark, path, rows, *args, **more)

    monkeypatch.setattr(tables.storage, "staged", watched)
    monkeypatch.setattr(tables.journal, "replace", replaced)
    t, s = spark.createDataFrame(TARGET, SCHEMA), spark.createDataFrame(SOURCE, SCHEMA)
    for rows_a_file, gathered in ((1000, True), (0, False)):
        monkeypatch.setattr(tables, "ROWS_A_FILE", rows_a_file, raising=False)
        path, plans = str(tmp_path / str(rows_a_file)), []
        tables.merge_partitioned(spark, path, t, KEYS, "year")
        tables_of[gathered] = bag(tables.merge_partitioned(spark, path, s, KEYS, "year", when, order))
        assert len(plans) == 2 and all(("Rebalance" in p) == gathered for p in plans)
    assert tables_of[True] == tables_of[False] == merged(TARGET, SOURCE, when)
    both = {r[:2] for r in TARGET if None not in r[:2]} & {r[:2] for r in SOURCE}
    assert staged == [([*KEYS, "year", "_known", "_old_year"], len(both))] * 2
