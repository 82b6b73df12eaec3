from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierfold.operators import quality, sampling, windowing
from tierfold.plans import bronze, silver
from tierfold.sources import landing, storage, tables


def test_sparse_columns_at_the_threshold(spark):
    df = spark.range(100).select(
        "id",
        F.when(F.col("id") < 2, 1).alias("at"),
        F.when(F.col("id") < 3, 1).alias("below"),
        F.lit(None).cast("int").alias("never"),
    )
    assert quality.prune_sparse(df, ["id"]).columns == ["id", "below"]
    assert quality.prune_sparse(df, ["id", "never"]).columns == ["id", "below", "never"]
    empty = df.limit(0)
    assert quality.prune_sparse(empty, ["id"]).columns == df.columns
    assert quality.null_ratio(empty, ["at"]).first()["at"] == 0.0
    long = quality.to_long(quality.null_profile(df), "c", "n")
    assert dict(map(tuple, long.collect())) == {"id": 0, "at": 98, "below": 97, "never": 100}


def test_profiles_run_in_one_pass(spark, plan):
    df = spark.range(10).select(*(F.col("id").alias(f"c{i}") for i in range(20)))
    assert plan(quality.null_ratio(df)).count("Range") == 1


def test_rejects(spark):
    df = spark.createDataFrame([(1, 2020), (None, 2020), (1, None)], "a INT, b INT")
    valid, rejected = quality.split_rejects(df, ["a", "b"])
    assert (valid.count(), rejected.count()) == (1, 2)
    assert tuple(quality.reject_counts(df, ["a", "b"]).first()) == (1, 2)


def test_watermark(spark, tmp_path):
    state = str(tmp_path / "state")
    dated = spark.createDataFrame([(datetime(2024, 5, 1),), (datetime(2024, 5, 3),)], "d TIMESTAMP")
    nothing = dated.limit(0)

    def mark(*candidates):
        return windowing.resolve_watermark(
            (tables.load_state(spark, state), "last_event_date"), *candidates
        ).first()[0]

    assert mark() is None and mark((nothing, "d")) is None
    assert mark((nothing, "d"), (dated, "d")) == date(2024, 5, 3)
    tables.save_watermark(windowing.advance_watermark(nothing, "d"), state)
    assert mark() is None
    tables.save_watermark(windowing.advance_watermark(dated, "d", date(2024, 5, 2)), state)
    assert mark() == date(2024, 5, 2)
    tables.save_watermark(windowing.advance_watermark(dated, "d"), state)
    assert mark() == date(2024, 5, 3)
    assert windowing.load_bounds(None, date(2024, 5, 3)) == (date(2017, 5, 4), date(2024, 5, 3))
    assert windowing.load_bounds(date(2024, 5, 3), date(2024, 5, 5), 2) == (
        date(2024, 5, 1), date(2024, 5, 12)
    )
    start = windowing.backfill_start(date(2024, 5, 3), 7)
    assert windowing.day_spine(spark, start, date(2024, 5, 3)).count() == 2557


def test_windows_prune_partitions(spark, plan, tmp_path):
    path = str(tmp_path / "events")
    days = windowing.day_spine(spark, date(2020, 1, 1), date(2023, 12, 31))
    tables.write_partitioned(days.withColumn("year", F.year("day")), path, "year")
    bounds = (date(2021, 12, 31), date(2022, 1, 2))
    window = windowing.incremental_window(spark.read.parquet(path), "day", bounds, "year")
    assert window.count() == 3
    scan = next(line for line in plan(window).splitlines() if "FileScan" in line)
    assert "(year#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(day,2021-12-31)" in scan


def test_even_sample(spark):
    days = windowing.day_spine(spark, date(2024, 1, 1), date(2024, 1, 20))
    twice = days.union(days)

    def picked(k):
        return sorted(r.day.day for r in sampling.even_sample(twice, "day", k).collect())

    for k in (2, 3, 7, 12, 19):
        assert picked(k) == sorted({round(i * 19 / (k - 1)) + 1 for i in range(k)})
    assert picked(1) == [1] and picked(20) == picked(50) == list(range(1, 21))


def test_workload_profile_over_sampled_days(spark):
    spine = windowing.day_spine(spark, date(2024, 1, 1), date(2024, 1, 4))
    docs = spark.createDataFrame(
        [(date(2024, 1, 1), 3, 10), (date(2024, 1, 1), 1, 15), (date(2024, 1, 3), 2, 20)],
        "day DATE, num_fights INT, chars INT",
    )
    whole = sampling.workload_profile(docs, spine).first()
    assert (whole.days_total, whole.sampled_events, whole.avg_events_per_day) == (4, 3, 0.75)
    assert (whole.avg_fights_per_event, whole.avg_payload_chars) == (2.0, 15)
    assert whole.p90_events_per_day == pytest.approx(1.7)
    assert whole.estimated_requests_total == 7
    some = sampling.workload_profile(docs, spine, sampling.even_sample(spine, "day", 2)).first()
    assert (some.sample_days, some.avg_events_per_day, some.estimated_events_total) == (2, 1.0, 4)
    none = sampling.workload_profile(docs.limit(0), spine).first()
    assert (none.avg_fights_per_event, none.estimated_total_chars) == (None, 0)


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 4), ("b", 5), ("b", 5)], "g STRING, v INT")
    rows = {r.g: (r.rows, r.mean, r.p90) for r in
            sampling.percentile_by(df, ["g"], "v", 0.9, "p90").collect()}
    assert rows == {"a": (3, 7 / 3, 3.6), "b": (2, 5.0, 5.0)}


def test_landing_and_raw_mirror(spark, tmp_path):
    land, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    day = date(2024, 1, 1)
    rows = spark.createDataFrame(
        [(day, 1, 1, "ä"), (day, 1, 2, "b"), (day, 2, 1, None)], "day DATE, k INT, n INT, t STRING"
    )
    for run in ("r1", "r2", "r2"):
        landing.write_landing(rows, land, run)
    schema = "k INT, n INT, t STRING"
    assert landing.scan_raw_json(spark, land, f"{schema}, run_id STRING").count() == 6
    landing.mirror_raw(rows, raw, "day", ["k"], ["n"])
    other = rows.withColumn("day", F.lit(date(2024, 1, 2)))
    landing.mirror_raw(other, raw, "day", ["k"], ["n"])
    landing.mirror_raw(rows.where("k = 1"), raw, "day", ["k"], ["n"])  # replaces the first day
    found = landing.scan_raw_json(spark, raw, f"{schema}, ingestion_date DATE", "part-*")
    assert sorted((r.ingestion_date.day, r.k, r.n, r.t) for r in found.collect()) == [
        (1, 1, 2, "b"), (2, 1, 2, "b"), (2, 2, 1, None)
    ]


def test_read_or_rebuild(spark, tmp_path):
    good = lambda: spark.range(3)
    assert landing.read_or_rebuild(good, lambda: spark.range(9)).count() == 3
    missing = lambda: spark.read.parquet(str(tmp_path / "none"))
    assert landing.read_or_rebuild(missing, good).count() == 3
    damaged = tmp_path / "damaged"
    damaged.mkdir()
    (damaged / "part-0.parquet").write_bytes(b"no parquet at all, not even close")
    broken = lambda: spark.read.schema("id BIGINT").parquet(str(damaged))
    assert landing.read_or_rebuild(broken, good).count() == 3
    with pytest.raises(ZeroDivisionError):
        landing.read_or_rebuild(lambda: 1 / 0, good)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        landing.read_or_rebuild(lambda: spark.range(3).selectExpr("id / 0 AS x"), good)


def test_silver_without_versions_only_adds(spark, tmp_path):
    schema = (
        "event_id STRING, competition_id STRING, event_date DATE, weight_class STRING, "
        "card_order STRING, status STRING, fighter_a_name STRING, fighter_a_winner BOOLEAN, "
        "fighter_b_name STRING, fighter_b_winner BOOLEAN"
    )

    def batch(*rows):
        return spark.createDataFrame(
            [(k, "1", d, " light HEAVY ", "3", s, " A ", None, "B", True) for k, d, s in rows], schema
        )

    path = str(tmp_path / "bouts")
    silver.load_bouts(spark, path, batch(("1", date(2020, 1, 1), "old"), ("1", date(2020, 1, 2), "new")))
    table = silver.load_bouts(
        spark, path, batch(("1", date(2021, 1, 1), "late"), ("2", date(2021, 1, 1), "first"))
    )
    assert {(r.event_id, r.status, r.weight_class, r.card_order, r.fighter_a_name)
            for r in table.collect()} == {
        ("1", "new", "Light Heavy", 3, "A"), ("2", "first", "Light Heavy", 3, "A")
    }


def test_bronze_gate_rejects_and_logs(spark, tmp_path):
    docs = spark.createDataFrame(
        [('{"id": 1, "date": "2024-01-01T10:00Z", "competitions": [{"id": 5}, {"name": "no id"}]}',),
         ('{"id": 2, "date": "TBD"}',), ('{"date": "2024-01-01T10:00Z"}',), ("{broken",)],
        "payload STRING",
    )
    root = bronze.Bronze(str(tmp_path))
    for run_id in ("1", "2"):
        events, bouts = bronze.load_bronze(
            spark, root, docs, bronze.Run(run_id, date(2023, 12, 31))
        )
    assert [(r.event_id, r.event_year, r.run_id) for r in events.collect()] == [("1", 2024, "2")]
    assert [r.competition_id for r in bouts.collect()] == ["5"]
    log = spark.read.parquet(root.runs).orderBy("run_id").collect()
    assert [(r.run_id, r.events_count, r.fights_count, r.errors, r.status) for r in log] == [
        ("1", 1, 1, 4, "SUCCESS"), ("2", 1, 1, 4, "SUCCESS")
    ]
    with pytest.raises(Exception):
        bronze.load_bronze(spark, root, docs.drop("payload"), bronze.Run("3", date(2024, 1, 2)))
    assert spark.read.parquet(root.runs).where("run_id = 3").first().status == "FAILED"
    assert bronze.current_watermark(spark, root).first()[0] == date(2024, 1, 1)
    held = spark.read.parquet(root.rejects("events")).groupBy("run_id").count().collect()
    assert {(int(r.run_id), r["count"]) for r in held} == {(1, 3), (2, 3)}
    assert bronze.current_watermark(spark, root, events).first()[0] == date(2024, 1, 1)
    tables.reset(spark, root.events, root.watermark)
    assert not storage.exists(spark, root.events)


def test_profiles_load_keeps_good_rows(spark, tmp_path):
    root = bronze.Bronze(str(tmp_path))

    def load(run_id, *texts):
        docs = spark.createDataFrame(texts, "athlete_id STRING, payload STRING")
        return bronze.load_profiles(spark, root, docs, bronze.Run(run_id, date(2024, 1, 1)))

    load("1", ("7", '{"fullName": "Good"}'), ("8", '{"fullName": "Old"}'))
    table = load(
        "2", ("7", '{"error": "timed out"}'), ("8", '{"fullName": "New"}'), ("9", '{"error": "x"}'),
        ("8", "{broken"), (None, '{"fullName": "Who"}'),
    )
    assert {(r.athlete_id, r.full_name, r.run_id) for r in table.collect()} == {
        ("7", "Good", "1"), ("8", "New", "2"), ("9", None, "2")
    }
    held = spark.read.parquet(root.rejects("profiles")).collect()
    assert sorted((r.reason, r.athlete_id or "") for r in held) == [
        ("failed", "7"), ("failed", "9"), ("no id", ""), ("unreadable", "8")
    ]


def test_the_later_payload_of_an_athlete_wins(spark, tmp_path):
    for i in range(6):
        root = bronze.Bronze(str(tmp_path / str(i)))
        docs = spark.createDataFrame(
            [("7", 1, f'{{"fullName": "Old {i}"}}'), ("7", 2, f'{{"fullName": "New {i}"}}')],
            "athlete_id STRING, loaded_at INT, payload STRING",
        )
        run = bronze.Run("1", date(2024, 1, 1))
        (row,) = bronze.load_profiles(spark, root, docs, run, order=["loaded_at"]).collect()
        assert row.full_name == f"New {i}"


def test_shared_root_comes_from_the_session(spark):
    assert storage.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
