"""Plans that have to hold when tables are large: pruning, pushdown and skew handling."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tierfold.operators import matchup
from tierfold.plans import bronze, gold


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run when neither side is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def wide_tables(spark, tmp_path):
    """Bouts with a payload nobody asks for, a third of them under one name; and profiles."""
    n = F.col("id")
    name = F.when(n % 3 == 0, "Hot Name").otherwise(F.concat(F.lit("Name "), (n % 5000).cast("string")))
    (
        spark.range(60000)
        .select(
            n.cast("string").alias("competition_id"),
            F.lit("x").alias("weight_class"),
            name.alias("fighter_a_name"),
            (n % 2 == 0).alias("fighter_a_winner"),
            F.concat(F.lit("NAME "), (n % 4999).cast("string")).alias("fighter_b_name"),
            (n % 2 == 1).alias("fighter_b_winner"),
            F.repeat(F.lit("payload"), 20).alias("raw_payload"),
        )
        .write.parquet(str(tmp_path / "bouts"))
    )
    (
        spark.range(5000)
        .select(
            n.cast("string").alias("athlete_id"),
            F.concat(F.lit("name "), n.cast("string")).alias("full_name"),
            F.when(n % 3 == 0, "HOT name").alias("display_name"),
            F.when(n % 2 == 0, "Orthodox").alias("stance"),
            F.lit("t").alias("team"),
        )
        .write.parquet(str(tmp_path / "profiles"))
    )
    read = spark.read.parquet
    return read(str(tmp_path / "bouts")), read(str(tmp_path / "profiles"))


def scans(text):
    return [line.split("ReadSchema:")[1] for line in text.splitlines() if "ReadSchema:" in line]


def test_marts_read_only_their_columns(wide_tables, plan):
    text = plan(gold.stance_by_class(*wide_tables))
    assert scans(text) and not any("raw_payload" in s or "athlete_id" in s for s in scans(text))
    assert "Join" in text


def test_splitting_by_key_runs_no_job(spark, wide_tables):
    bouts, _ = wide_tables
    spark.sparkContext.setJobGroup("split", "split")
    matchup.split_by_key(bouts)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("split")
    spark.sparkContext.setJobGroup("other", "other")


def test_hot_name_is_counted_before_it_is_joined(spark, wide_tables, no_broadcast, plan):
    """With a third of the bouts and of the profiles under one name, pairs are counted by names
    below every join with the profiles, and the counts stay whole."""
    bouts, profiles = wide_tables
    index = matchup.name_index(profiles, gold.PROFILE_NAMES, ["stance"])
    pairs = matchup.attributed(matchup.name_pairs(bouts, []), index, ["stance"], [])
    lines = plan(pairs).splitlines()
    last = max(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_sum" in line for line in lines[last:])
    rows = gold.stance_overall(bouts, profiles).collect()
    hot_fights, copies = 20000, 1667  # a third of the bouts, and as many namesakes
    assert sum(r.fights for r in rows) >= 2 * hot_fights * copies


def test_teams_count_per_name_before_they_join(wide_tables, no_broadcast, plan):
    bouts, profiles = wide_tables
    text = plan(gold.team_overall(bouts, profiles))
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    below = "\n".join(lines[join:])
    assert "HashAggregate" in below and "partial_count" in below


def test_large_sides_are_not_broadcast(wide_tables, no_broadcast, plan):
    bouts, profiles = wide_tables
    long = matchup.unpivot_sides(bouts, ["competition_id"], matchup.FIGHTER_SIDES)
    found = matchup.resolve_by_name(
        long, profiles, "athlete_name", gold.PROFILE_NAMES, ["athlete_id"]
    )
    assert "SortMergeJoin" in plan(found) and "Broadcast" not in plan(found)
    assert plan(long).count("FileScan") == 1


def test_the_gate_parses_no_document_again(spark):
    """Documents that are dealt out before they are parsed: nothing is parsed in the stage before."""
    run = bronze.Run("20250101T000000Z", date(2025, 1, 1))
    bout = '{"id": 3, "competitors": []}'
    texts = [
        f'{{"id": 1, "date": "2024-05-01T10:00Z", "competitions": [{bout}]}}',
        f'{{"id": 2, "competitions": [{bout}]}}', f'{{"date": "2024-05-01T10:00Z", "competitions": [{bout}]}}', "no JSON",
    ]
    documents = spark.createDataFrame([(t,) for t in texts], "payload STRING").repartition(2, "payload")
    for gated, kept in ((bronze.valid_events, ["1"]), (bronze.valid_bouts, ["1"])):
        rows = gated(documents, run)
        lines = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()
        below = lines[next(i for i, line in enumerate(lines) if "RepartitionByExpression" in line):]
        assert len(below) > 1 and "from_json" not in "".join(below)
        assert [r.event_id for r in rows.collect()] == kept


def measured(profiles):
    k = F.col("athlete_id").cast("int")
    return profiles.withColumns({"height_cm": 150 + k % 60, "reach_cm": F.when(k % 9 != 0, 150 + k * 3 % 70)})


def test_bins_are_found_without_lambdas(wide_tables, plan):
    """Lambdas over the values of a key with very many records take minutes in one task."""
    bouts, profiles = wide_tables
    text = plan(gold.height_by_reach(bouts, measured(profiles)))
    assert not any(f" {name}(" in text or f"({name}(" in text for name in ("transform", "aggregate", "array_max"))


def test_stored_shared_keys_spare_the_pairings_a_shuffle(spark, wide_tables, plan, tmp_path):
    bouts, profiles = wide_tables[0].where("competition_id % 3 <> 0"), measured(wide_tables[1])
    twice = bouts.unionByName(bouts.where("competition_id < 20"))
    matchup.shared_keys(twice).write.parquet(str(tmp_path / "shared"))
    stored = spark.read.parquet(str(tmp_path / "shared"))
    split = matchup.split_by_key(twice, shared=stored)
    assert split.shared.select("competition_id").distinct().count() == stored.count() > 0
    own = plan(matchup.name_pairs(split.own, []))
    assert "hashpartitioning(competition_id" not in own and "BroadcastHashJoin" in own
    for mart in (gold.stance_overall, gold.height_by_reach):
        assert set(mart(split, profiles).collect()) == set(mart(twice, profiles).collect())
