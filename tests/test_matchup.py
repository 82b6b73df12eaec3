"""Pairing, name resolution and marts against brute force over small made-up bouts."""

import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from tierfold.operators import matchup
from tierfold.plans import gold
from tierfold.sources import publishing

BOUT_SCHEMA = (
    "competition_id STRING, event_id STRING, event_date TIMESTAMP, event_year INT, "
    "weight_class STRING, fighter_a_name STRING, fighter_a_winner BOOLEAN, "
    "fighter_b_name STRING, fighter_b_winner BOOLEAN"
)
PROFILE_SCHEMA = (
    "athlete_id STRING, full_name STRING, display_name STRING, stance STRING, team STRING, "
    "combat_style STRING, height_cm INT, reach_cm INT"
)


def made_up(seed, competitions=40, bouts=60, hot=True):
    """Bouts with repeated competition ids and, if hot, a third of them under one name."""
    rng = random.Random(seed)
    names = [f"Name {i}" for i in range(12)] + ["Nobody", None]

    def name():
        return "hot NAME" if hot and rng.random() < 1 / 3 else rng.choice(names)

    rows = []
    for i in range(bouts):
        won = rng.choice([True, False, None])
        key = rng.choice([None] + [str(k) for k in range(competitions)])
        rows.append((key, str(i), None, 2000 + i % 3, rng.choice("XY"), name(), won, name(),
                     None if won is None else not won))
    people = [
        (str(i), rng.choice(["Hot Name", f"name {i % 12}"]), rng.choice([None, "HOT NAME", f"NAME {i % 12}"]),
         rng.choice([None, " ", "South Paw", "Orthodox"]), rng.choice([None, "", " Red ", "blue"]),
         rng.choice([None, "0", "Boxing", "Judo"]), rng.choice([None, 170, 175, 200]),
         rng.choice([None, 170, 190]))
        for i in range(30)
    ]
    return rows, people


def sides(rows):
    for r in rows:
        yield r[0], "A", r[4], r[3], r[5], r[6]
        yield r[0], "B", r[4], r[3], r[7], r[8]


def expanded(rows, people):
    """Side rows joined with every matching person, as (key, side, class, year, won, person)."""
    out = []
    for key, side, cls, year, name, won in sides(rows):
        found = [
            p for p in people
            if name is not None and name.lower() in {n.lower() for n in p[1:3] if n is not None}
        ]
        out += [(key, side, cls, year, won, p) for p in found or [None]]
    return out


def facing(rows, people):
    found = expanded(rows, people)
    return [
        (x, y) for x, y in product(found, found)
        if x[0] is not None and x[0] == y[0] and x[1] != y[1]
    ]


def rates(pairs, key):
    fights, wins = Counter(), Counter()
    for x, y in pairs:
        k = key(x, y)
        if k is not None:
            fights[k] += 1
            wins[k] += x[4] is True
    return {k: (n, wins[k], wins[k] / n) for k, n in fights.items()}


def collected(df, *dims):
    return {tuple(r[d] for d in dims): (r.fights, r.wins, r.win_rate) for r in df.collect()}


def stance(p):
    if p is None:
        return None
    return "unknown" if not (p[3] or "").strip() else p[3].strip().lower().replace(" ", "_")


def style(p):
    return {"Boxing": "striker", "Judo": "wrestler"}.get(p[5] if p else None, "mma")


@pytest.fixture(params=[0, 1])
def case(request, spark):
    rows, people = made_up(request.param)
    return (
        rows, people,
        spark.createDataFrame(rows, BOUT_SCHEMA), spark.createDataFrame(people, PROFILE_SCHEMA),
    )


def test_stance_marts(case):
    rows, people, bouts, profiles = case
    pairs = facing(rows, people)
    by_class = rates(pairs, lambda x, y: (x[2], stance(x[5]), stance(y[5])))
    mart = gold.stance_by_class(bouts, profiles)
    assert collected(mart, "weight_class", "stance", "opp_stance") == by_class
    overall = rates(pairs, lambda x, y: (stance(x[5]), stance(y[5])))
    assert collected(gold.stance_overall(bouts, profiles), "stance", "opp_stance") == overall
    rolled = gold.rolled_up(mart, ["stance", "opp_stance"])
    assert collected(rolled, "stance", "opp_stance") == overall


def test_style_mart(case):
    rows, people, bouts, profiles = case
    expected = rates(facing(rows, people), lambda x, y: (style(x[5]), style(y[5])))
    assert collected(gold.style_overall(bouts, profiles), "style", "opp_style") == expected


def test_height_marts(case):
    rows, people, bouts, profiles = case

    def binned(x, y):
        if x[5] is None or y[5] is None or x[5][6] is None or y[5][6] is None:
            return None
        h = max(-25, min(25, x[5][6] - y[5][6]))
        low = 20 if h == 25 else h // 5 * 5
        if x[5][7] is None or y[5][7] is None:
            return low, None
        r = max(-30, min(30, x[5][7] - y[5][7]))
        return low, 20 if r == 30 else r // 10 * 10

    def start(label):
        return None if label is None else int(label[1:].split(",")[0])

    expected = rates(facing(rows, people), binned)
    mart = gold.height_by_reach(bouts, profiles)
    found = {(start(h), start(r)): v for (h, r), v in
             collected(mart, "height_adv_bin", "reach_adv_bin").items()}
    assert found == expected
    rolled = collected(gold.rolled_up(mart, ["height_adv_bin"]), "height_adv_bin")
    assert rolled == collected(gold.height_bins(bouts, profiles), "height_adv_bin")


def test_team_marts(case):
    rows, people, bouts, profiles = case
    bouts = bouts.withColumn("event_date", F.make_date("event_year", F.lit(1), F.lit(1)))
    members = {}
    for _, _, _, year, won, p in expanded(rows, people):
        if p is not None and (p[4] or "").strip():
            members.setdefault((p[4].strip().lower(), year), []).append((p[0], won is True))
    found = {
        (r.team_norm, r.event_year): (r.fights, r.wins, r.fighters, r.fights_per_fighter)
        for r in gold.team_by_year(bouts, profiles).collect()
    }
    assert found == {
        k: (len(v), sum(w for _, w in v), len({i for i, _ in v}), len(v) / len({i for i, _ in v}))
        for k, v in members.items()
    }


def test_pairing_paths_agree(case):
    """Pairs within records and pairs across records count the same where keys are unique."""
    rows, _, bouts, profiles = case
    once = bouts.withColumn("competition_id", F.col("event_id"))
    index = matchup.name_index(profiles, gold.PROFILE_NAMES, ["height_cm"])
    within = matchup.attributed(
        matchup.name_pairs(once, ["weight_class"]), index, ["height_cm"], ["weight_class"]
    )
    across = matchup.pairs_across_records(once, index, ["height_cm"], ["weight_class"], "competition_id")

    def counted(df):
        dims = ["weight_class", "height_cm", "opp_height_cm", "is_winner"]
        return Counter({tuple(r[:-1]): r[-1] for r in df.groupBy(*dims).agg(F.sum("weight")).collect()})

    assert counted(within) == counted(across) and sum(counted(within).values()) > len(rows)


def test_a_thousand_namesakes_on_each_side_stay_few_rows(spark):
    bouts = spark.createDataFrame(
        [("1", "e", None, 2000, "X", "Same A", True, "Same B", False)], BOUT_SCHEMA
    )
    people = [
        (f"{s}{i}", f"same {s}", None, f"stance {i % 5}", None, None, 150 + i % 50, 150 + i // 50)
        for s in "ab" for i in range(1000)
    ]
    profiles = spark.createDataFrame(people, PROFILE_SCHEMA)
    pairs = gold.advantage_pairs(bouts, profiles)
    mart = gold.height_by_reach(bouts, profiles)
    assert mart.agg(F.sum("fights")).first()[0] == 2 * 1000 * 1000
    assert pairs.count() < 200
    text = pairs._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" in text
    index = matchup.name_index(profiles, gold.PROFILE_NAMES, ["stance"])
    assert index.count() == 10
    assert gold.stance_overall(bouts, profiles).agg(F.sum("fights")).first()[0] == 2 * 1000 * 1000


def test_hot_competition_id_is_paired_on_summary_rows(spark):
    """All A rows of one key face all its B rows: 4 million pairs from a few summary rows."""
    rows = spark.range(4000).select(
        F.lit("same").alias("k"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("side"),
        (F.col("id") % 3).alias("kind"),
    )
    pairs = matchup.pair_opponents(rows, "k", "side", ["kind"], ["kind"])
    assert pairs.count() == 18
    assert pairs.agg(F.sum("weight")).first()[0] == 2 * 2000 * 2000


def test_name_resolution_equals_the_literal_condition(case):
    rows, people, bouts, profiles = case
    long = matchup.unpivot_sides(bouts, ["competition_id"], matchup.FIGHTER_SIDES)
    found = matchup.resolve_by_name(
        long, profiles, "athlete_name", gold.PROFILE_NAMES, ["athlete_id"]
    )
    literal = long.join(
        profiles.select("full_name", "display_name", "athlete_id"),
        (F.lower("athlete_name") == F.lower("full_name"))
        | (F.lower("athlete_name") == F.lower("display_name")),
        "left",
    )
    columns = ["competition_id", "side", "athlete_name", "athlete_id"]
    assert Counter(found.select(columns).collect()) == Counter(literal.select(columns).collect())


def test_sides_are_symmetric(case):
    rows, _, bouts, profiles = case
    mart = collected(gold.stance_overall(bouts, profiles), "stance", "opp_stance")
    assert all(mart[(b, a)][0] == n for (a, b), (n, _, _) in mart.items())


def test_grains_in_one_pass(case):
    _, _, bouts, profiles = case
    pairs = gold.stance_pairs(bouts, profiles, ["weight_class"])
    grains = {"class": ["weight_class", "stance"], "all": ["stance"]}
    both = matchup.win_rate_grains(pairs, grains, weight="weight")
    for grain, dims in grains.items():
        one = matchup.win_rate(pairs, dims, weight="weight")
        assert collected(both.where(F.col("grain") == grain), *dims) == collected(one, *dims)


def test_matrix(spark):
    rates = spark.createDataFrame([("x", "x", 0.5), ("x", "y", 0.25), ("y", "x", 0.75)],
                                  "a STRING, b STRING, r DOUBLE")
    wide = matchup.matrix(rates, "a", "b", "r", ["x", "y", "z"], 0.0)
    assert {r.a: (r.x, r.y, r.z) for r in wide.collect()} == {
        "x": (0.5, 0.25, 0.0), "y": (0.75, 0.0, 0.0)
    }
    found = matchup.matrix(rates.union(spark.sql("SELECT 'x', NULL, 0.1D")), "a", "b", "r")
    assert found.columns == ["a", "null", "x", "y"]
    assert {r.a: tuple(r)[1:] for r in found.collect()} == {"x": (0.1, 0.5, 0.25), "y": (None, 0.75, None)}


def test_gold_tables_and_views(case, spark, tmp_path):
    _, _, bouts, profiles = case
    bouts = bouts.withColumn("event_date", F.make_date("event_year", F.lit(1), F.lit(1)))
    database = f"gold_{tmp_path.name}"
    for _ in range(2):  # a second run replaces every mart
        marts = gold.build_gold(spark, database, bouts, profiles, str(tmp_path / "gold"))
    assert len(marts) == 7 and spark.catalog.tableExists(f"{database}.v_team_performance")
    versions = {t.name[-6:] for t in spark.catalog.listTables(database) if t.tableType != "VIEW"}
    assert versions == {"000001", "000002"} and publishing.published_version(spark, database) == 2
    assert collected(marts["height_advantage_bins_overall"], "height_adv_bin") == collected(
        gold.height_bins(bouts, profiles), "height_adv_bin"
    )
