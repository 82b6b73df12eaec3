"""Name resolution, pairing, rates, matrices and the gold marts."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from checks.inputs import BOUTS, GOLD, PROFILES, RESOLVED, SIDES, bouts, profiles, with_
from checks.registry import query, table
from tierfold.functions import dates
from tierfold.operators import matchup
from tierfold.plans import gold
from tierfold.sources import journal, publishing, storage

# Fixed values, written out here and not taken from the library that is checked: separators, the
# tokens of each style bucket, bin edges, and the stances of the made-up profiles.
STYLE_SEPARATORS = [",", ";", "&", "|", "\\", " and ", " vs ", "/"]
STYLE_BUCKETS = {
    "wrestler": ["grappling", "wrestling", "thugjistu", "sambo", "judo", "jiu_jitsu"],
    "striker": [
        "sanda", "muay_thai", "kung_fu", "teakwondo", "taekwondo",
        "ninja", "nikidokai", "boxing", "kickboxing", "karate",
    ],
    "street_fighting": ["street_fighting", "brawler"],
    "mma": ["mixed_martial_artist", "mixed_martial_arts", "freestyle"],
}
HEIGHT_EDGES = [-25, -20, -15, -10, -5, 0, 5, 10, 15, 20, 25]
REACH_EDGES = [-30, -20, -10, 0, 10, 20, 30]

FOE = "JOIN resolved y ON x.competition_id = y.competition_id AND x.side <> y.side"
RATES = """count(*) AS fights,
       CAST(sum(CASE WHEN x.is_winner THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       sum(CASE WHEN x.is_winner THEN 1 ELSE 0 END) / count(*) AS win_rate"""


def _stance(row: str) -> str:
    return f"""CASE WHEN {row}.athlete_id IS NULL THEN NULL
       WHEN {row}.stance IS NULL OR trim({row}.stance) = '' THEN 'unknown'
       ELSE replace(lower(trim({row}.stance)), ' ', '_') END"""


def style_sql(column: str) -> str:
    """The bucketing rule as SQL."""
    base = f"""CASE WHEN {column} IS NULL OR trim({column}) = '' THEN 'mixed martial arts'
       ELSE lower(trim({column})) END"""
    for sep in STYLE_SEPARATORS:
        base = f"replace({base}, '{sep}', '/')"
    token = f"replace(replace(trim(split_part({base}, '/', 1)), '-', '_'), ' ', '_')"
    token = f"""CASE WHEN contains({token}, 'brazilian_jiu') OR contains({token}, 'jiu_jitsu')
       THEN 'jiu_jitsu' ELSE {token} END"""
    cases = " ".join(
        "WHEN ({t}) IN ({v}) THEN '{b}'".format(
            t=token, v=", ".join(f"'{x}'" for x in tokens), b=bucket
        )
        for bucket, tokens in STYLE_BUCKETS.items()
    )
    return f"CASE WHEN ({token}) = '0' THEN NULL {cases} ELSE 'mma' END"


STANCE_MART = f"""
SELECT x.weight_class, {_stance("x")} AS stance, {_stance("y")} AS opp_stance, {RATES}
FROM resolved x {FOE} GROUP BY 1, 2, 3"""
STANCE_OVERALL = f"""
SELECT {_stance("x")} AS stance, {_stance("y")} AS opp_stance, {RATES}
FROM resolved x {FOE} GROUP BY 1, 2"""
STYLED = f"""styled AS (
  SELECT competition_id, side, is_winner,
         coalesce(CASE WHEN athlete_id IS NOT NULL THEN {style_sql("combat_style")} END, 'mma')
           AS style
  FROM resolved)"""
STYLE_MART = """
SELECT x.style, y.style AS opp_style, {rates}
FROM styled x JOIN styled y ON x.competition_id = y.competition_id AND x.side <> y.side
GROUP BY 1, 2""".format(rates=RATES)
GOLD_STYLED = GOLD.rstrip() + ",\n" + STYLED


def _in(spark, sf):
    return bouts(spark, sf), profiles(spark, sf)


@query("mart_stance_by_class", GOLD + STANCE_MART)
def mart_stance_by_class(spark, sf):
    return gold.stance_by_class(*_in(spark, sf))


@query("mart_stance_overall", GOLD + STANCE_OVERALL)
def mart_stance_overall(spark, sf):
    return gold.stance_overall(*_in(spark, sf))


@query("mart_style_overall", GOLD_STYLED + STYLE_MART)
def mart_style_overall(spark, sf):
    return gold.style_overall(*_in(spark, sf))


def _matrix_sql(source: str, row: str, column: str, values: list[str], fill: bool) -> str:
    cells = []
    for v in values:
        cell = f"max(CASE WHEN coalesce({column}, 'null') = '{v}' THEN win_rate END)"
        cells.append(f'coalesce({cell}, 0.0) AS "{v}"' if fill else f'{cell} AS "{v}"')
    return f"SELECT {row}, {', '.join(cells)} FROM ({source}) GROUP BY {row}"


STYLE_NAMES = list(STYLE_BUCKETS)
STANCE_NAMES = ["automobile", "building", "furniture", "household", "machinery", "null", "unknown"]


@query(
    "mart_style_matrix",
    GOLD_STYLED + "\n" + _matrix_sql(STYLE_MART, "style", "opp_style", STYLE_NAMES, True),
)
def mart_style_matrix(spark, sf):
    return gold.style_matrix(gold.style_overall(*_in(spark, sf)))


@query(
    "matchup_matrix",
    GOLD + _matrix_sql(STANCE_OVERALL, "stance", "opp_stance", STANCE_NAMES, False),
)
def matchup_matrix(spark, sf):
    mart = gold.stance_overall(*_in(spark, sf))
    return matchup.matrix(mart, "stance", "opp_stance", "win_rate")


@query(
    "matchup_matrix_filled",
    GOLD + _matrix_sql(
        f"""SELECT x.weight_class, {_stance("y")} AS opp_stance, {RATES}
        FROM resolved x {FOE} GROUP BY 1, 2""",
        "weight_class", "opp_stance", STANCE_NAMES, True,
    ),
)
def matchup_matrix_filled(spark, sf):
    pairs = gold.stance_pairs(*_in(spark, sf), ["weight_class"])
    rates = matchup.win_rate(pairs, ["weight_class", "opp_stance"], weight="weight")
    return matchup.matrix(rates, "weight_class", "opp_stance", "win_rate", fill=0.0)


TEAM = """CASE WHEN team IS NULL OR trim(team) = '' THEN NULL ELSE lower(trim(team)) END"""
TEAM_RATES = """count(*) AS fights,
       CAST(sum(CASE WHEN is_winner THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       count(DISTINCT athlete_id) AS fighters,
       sum(CASE WHEN is_winner THEN 1 ELSE 0 END) / count(*) AS win_rate,
       count(*) / count(DISTINCT athlete_id) AS fights_per_fighter
FROM resolved WHERE team IS NOT NULL AND trim(team) <> ''"""


@query("mart_team", f"{GOLD} SELECT {TEAM} AS team_norm, {TEAM_RATES} GROUP BY 1")
def mart_team(spark, sf):
    return gold.team_overall(*_in(spark, sf))


@query(
    "mart_team_year", f"{GOLD} SELECT {TEAM} AS team_norm, event_year, {TEAM_RATES} GROUP BY 1, 2"
)
def mart_team_year(spark, sf):
    return gold.team_by_year(*_in(spark, sf))


@query(
    "topk_leaderboard",
    f"""{GOLD} SELECT {TEAM} AS team_norm, event_year, {TEAM_RATES} GROUP BY 1, 2
    ORDER BY win_rate DESC, fights DESC, team_norm, event_year LIMIT 50""",
)
def topk_leaderboard(spark, sf):
    order = [F.desc("win_rate"), F.desc("fights"), F.asc("team_norm"), F.asc("event_year")]
    return gold.team_by_year(*_in(spark, sf)).orderBy(*order).limit(50)


def bin_sql(column: str, edges: list[int], label: bool = True) -> str:
    cases = []
    for lo, hi in zip(edges, edges[1:]):
        last = hi == edges[-1]
        name = f"'[{lo},{hi}{']' if last else ')'}'" if label else str(lo)
        cases.append(f"WHEN {column} >= {lo} AND {column} {'<=' if last else '<'} {hi} THEN {name}")
    return f"CASE {' '.join(cases)} END"


ADVANTAGE = GOLD.rstrip() + f""",
feat AS (
  SELECT x.is_winner,
         greatest(least(x.height_cm - y.height_cm, 25), -25) AS h,
         CASE WHEN x.reach_cm IS NOT NULL AND y.reach_cm IS NOT NULL
              THEN greatest(least(x.reach_cm - y.reach_cm, 30), -30) END AS r
  FROM resolved x {FOE}
  WHERE x.height_cm IS NOT NULL AND y.height_cm IS NOT NULL),
x AS (
  SELECT is_winner, {bin_sql("h", HEIGHT_EDGES)} AS height_adv_bin,
         CAST({bin_sql("h", HEIGHT_EDGES, False)} AS INTEGER) AS height_adv_low,
         {bin_sql("r", REACH_EDGES)} AS reach_adv_bin
  FROM feat)
"""


@query(
    "mart_height_bins",
    f"{ADVANTAGE} SELECT height_adv_bin, height_adv_low, {RATES} FROM x GROUP BY 1, 2",
)
def mart_height_bins(spark, sf):
    return gold.height_bins(*_in(spark, sf))


@query(
    "mart_height_reach",
    f"{ADVANTAGE} SELECT height_adv_bin, reach_adv_bin, {RATES} FROM x GROUP BY 1, 2",
)
def mart_height_reach(spark, sf):
    return gold.height_by_reach(*_in(spark, sf))


@query(
    "matchup_two_grains",
    f"""{GOLD} SELECT 'by_class' AS grain, * FROM ({STANCE_MART})
    UNION ALL BY NAME SELECT 'overall' AS grain, NULL AS weight_class, * FROM ({STANCE_OVERALL})""",
)
def matchup_two_grains(spark, sf):
    pairs = gold.stance_pairs(*_in(spark, sf), ["weight_class"])
    grains = {
        "by_class": ["weight_class", "stance", "opp_stance"],
        "overall": ["stance", "opp_stance"],
    }
    return matchup.win_rate_grains(pairs, grains, weight="weight")


@query(
    "resolve_entity_by_name",
    f"""{GOLD} SELECT competition_id, strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date,
      side, athlete_name, athlete_id FROM resolved""",
)
def resolve_entity_by_name(spark, sf):
    b, p = _in(spark, sf)
    rows = matchup.unpivot_sides(b, ["competition_id", "event_date"], matchup.FIGHTER_SIDES)
    return matchup.resolve_by_name(
        rows.drop("is_winner"), p, "athlete_name", gold.PROFILE_NAMES, ["athlete_id"]
    )


@query(
    "unpivot_sides",
    f"""{with_(BOUTS, SIDES)} SELECT competition_id, weight_class, side, athlete_name, is_winner
    FROM sides""",
)
def unpivot_sides(spark, sf):
    return matchup.unpivot_sides(
        bouts(spark, sf), ["competition_id", "weight_class"], matchup.FIGHTER_SIDES
    )


@query(
    "pair_opponents",
    """SELECT x.l_orderkey, x.l_returnflag, y.l_returnflag AS opp_l_returnflag, x.l_linestatus,
         x.l_shipmonth, y.l_linestatus AS opp_l_linestatus, count(*) AS weight
    FROM (SELECT *, CAST(month(l_shipdate) AS INTEGER) AS l_shipmonth FROM lineitem) x
    JOIN lineitem y ON x.l_orderkey = y.l_orderkey AND x.l_returnflag <> y.l_returnflag
    GROUP BY 1, 2, 3, 4, 5, 6""",
)
def pair_opponents(spark, sf):
    """Lines of an order with different return flags face each other."""
    lines = table(spark, sf, "lineitem").withColumn("l_shipmonth", F.month("l_shipdate"))
    return matchup.pair_opponents(
        lines, "l_orderkey", "l_returnflag", ["l_linestatus", "l_shipmonth"], ["l_linestatus"]
    )


@query(
    "conditional_win_rate",
    f"""{with_(BOUTS, SIDES)} SELECT weight_class, event_year, {RATES} FROM sides x GROUP BY 1, 2""",
)
def conditional_win_rate(spark, sf):
    rows = matchup.unpivot_sides(
        bouts(spark, sf), ["weight_class", "event_year"], matchup.FIGHTER_SIDES
    )
    return matchup.win_rate(rows, ["weight_class", "event_year"])


@query(
    "distinct_per_group",
    """SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS customers
    FROM orders GROUP BY 1, 2""",
)
def distinct_per_group(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus")
    return orders.agg(F.count_distinct("o_custkey").alias("customers"))


@query(
    "age_gap_years",
    f"""{with_(BOUTS, PROFILES)}, a AS (
      SELECT b.competition_id, b.event_date, p.birth_date AS d1, q.birth_date AS d2
      FROM bouts b
      LEFT JOIN profiles p ON lower(b.fighter_a_name) = lower(p.full_name)
        OR lower(b.fighter_a_name) = lower(p.display_name)
      LEFT JOIN profiles q ON lower(b.fighter_b_name) = lower(q.full_name)
        OR lower(b.fighter_b_name) = lower(q.display_name)),
    m AS (SELECT *,
      (year(event_date) - year(d1)) * 12 + month(event_date) - month(d1) AS m1,
      (year(event_date) - year(d2)) * 12 + month(event_date) - month(d2) AS m2,
      day(event_date) = day(d1) OR (last_day(event_date) = CAST(event_date AS DATE)
        AND last_day(d1) = d1) AS whole1,
      day(event_date) = day(d2) OR (last_day(event_date) = CAST(event_date AS DATE)
        AND last_day(d2) = d2) AS whole2 FROM a)
    SELECT competition_id, round(
      (m1 + CASE WHEN whole1 THEN 0 ELSE (day(event_date) - day(d1)) / 31.0 END) / 12.0
      - (m2 + CASE WHEN whole2 THEN 0 ELSE (day(event_date) - day(d2)) / 31.0 END) / 12.0, 5)
      AS age_adv_years FROM m""",
)
def age_gap_years(spark, sf):
    """Every bout, with the gap where both competitors are known by either name."""
    b, p = _in(spark, sf)
    found = b.select("competition_id", "event_date", "fighter_a_name", "fighter_b_name")
    for side in "ab":
        people = p.withColumnRenamed("birth_date", f"born_{side}")
        found = matchup.resolve_by_name(
            found, people, f"fighter_{side}_name", gold.PROFILE_NAMES, [f"born_{side}"]
        )
    gap = dates.age_gap_years(F.col("event_date"), F.col("born_a"), F.col("born_b"))
    return found.select("competition_id", F.round(gap, 5).alias("age_adv_years"))


# --- bouts that share a competition, all marts at once ------------------------------------------

# A tenth of the bouts under one key, two tenths in small groups, the others on their own.
SHARED_KEY = """CASE WHEN k % 10 = 0 THEN 'hot' WHEN k % 10 < 3 THEN 'group ' || (k // 20)
  ELSE CAST(k AS VARCHAR) END"""
SHARED_GOLD = with_(
    BOUTS.replace("bouts AS", "base AS", 1),
    f"""bouts AS (SELECT * EXCLUDE (k) REPLACE ({SHARED_KEY} AS competition_id)
      FROM (SELECT *, CAST(competition_id AS BIGINT) AS k FROM base))""",
    PROFILES, SIDES, RESOLVED,
)


def _shared(spark, sf):
    b, p = _in(spark, sf)
    k = F.col("competition_id").cast("bigint")
    group = F.concat(F.lit("group "), F.floor(k / 20).cast("string"))
    key = F.when(k % 10 == 0, "hot").when(k % 10 < 3, group).otherwise(F.col("competition_id"))
    return b.withColumn("competition_id", key), p


@query("mart_shared_competitions", SHARED_GOLD + STANCE_MART)
def mart_shared_competitions(spark, sf):
    return gold.stance_by_class(*_shared(spark, sf))


@query(
    "mart_shared_heights",
    f"{ADVANTAGE.replace(GOLD.rstrip(), SHARED_GOLD.rstrip())} "
    f"SELECT height_adv_bin, reach_adv_bin, {RATES} FROM x GROUP BY 1, 2",
)
def mart_shared_heights(spark, sf):
    return gold.height_by_reach(*_shared(spark, sf))


# Mart, its dimensions, and the SQL that gives them with fights and wins.
SEVEN = {
    "stance_matchups": (["weight_class", "stance", "opp_stance"], STANCE_MART),
    "stance_matchups_overall": (["stance", "opp_stance"], STANCE_OVERALL),
    "style_matchups_overall": (["style", "opp_style"], STYLE_MART),
    "team_performance": (["team_norm"], f"SELECT {TEAM} AS team_norm, {TEAM_RATES} GROUP BY 1"),
    "team_performance_year": (
        ["team_norm", "event_year"],
        f"SELECT {TEAM} AS team_norm, event_year, {TEAM_RATES} GROUP BY 1, 2",
    ),
    "height_vs_reach_heatmap": (
        ["height_adv_bin", "reach_adv_bin"],
        f"SELECT height_adv_bin, reach_adv_bin, {RATES} FROM x GROUP BY 1, 2",
    ),
    "height_advantage_bins_overall": (
        ["height_adv_bin"], f"SELECT height_adv_bin, {RATES} FROM x GROUP BY 1"
    ),
}


def _label_sql(dims: list[str]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({d} AS VARCHAR), '-')" for d in dims)


@query(
    "build_gold",
    ADVANTAGE.rstrip() + ",\n" + STYLED + " UNION ALL ".join(
        f"SELECT '{name}' AS mart, {_label_sql(dims)} AS label, fights, wins FROM ({sql})"
        for name, (dims, sql) in SEVEN.items()
    ),
)
def build_gold(spark, sf):
    """All rows of the seven views."""
    database = f"gold_{uuid.uuid4().hex[:12]}"
    b, p = _in(spark, sf)
    views = gold.build_gold(spark, database, b, p, storage.new_folder(spark, database))
    parts = []
    for name, (dims, _) in SEVEN.items():
        label = F.concat_ws("|", *(F.coalesce(F.col(d).cast("string"), F.lit("-")) for d in dims))
        parts.append(views[name].select(F.lit(name).alias("mart"), label.alias("label"), "fights", "wins"))
    return reduce(lambda x, y: x.unionAll(y), parts)


#: The marts of a refresh in SQL.
REFRESHED = {
    "stance_matchups": GOLD + STANCE_MART,
    "stance_matchups_overall": GOLD + STANCE_OVERALL,
    "style_matchups_overall": GOLD_STYLED + STYLE_MART,
    "team_performance": f"{GOLD} SELECT {TEAM} AS team_norm, {TEAM_RATES} GROUP BY 1",
    "team_performance_year": f"{GOLD} SELECT {TEAM} AS team_norm, event_year, {TEAM_RATES} GROUP BY 1, 2",
    "height_vs_reach_heatmap": f"{ADVANTAGE} SELECT height_adv_bin, reach_adv_bin, {RATES} FROM x GROUP BY 1, 2",
    "height_advantage_bins_overall": f"{ADVANTAGE} SELECT height_adv_bin, {RATES} FROM x GROUP BY 1",
}


def _totals_sql(state: str, bouts_where: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{state}' AS state, '{mart}' AS mart, count(*) AS groups, CAST(sum(fights) AS BIGINT) AS fights,
        CAST(sum(wins) AS BIGINT) AS wins FROM ({sql.replace("FROM orders)", f"FROM orders WHERE {bouts_where})")})"""
        for mart, sql in REFRESHED.items()
    )


class Stopped(Exception):
    """A refresh that ended at one of its steps."""


def _stop_at(step: str, time: int) -> journal.Step:
    """A step function that ends a job the n-th time it comes to this step."""
    met = []

    def check(name):
        met.extend([name] * (name == step))
        if len(met) == time:
            raise Stopped(f"{step} {time}")

    return check


@query(
    "gold_published_at_once",
    f"""{_totals_sql("stopped among the marts", "o_orderkey % 2 = 0")}
    UNION ALL {_totals_sql("stopped among the views", "true")}""",
)
def gold_published_at_once(spark, sf):
    """A refresh over half of the bouts; one over all of them that ends at its fourth mart, after
    which all views show the first; one that ends among its views, which the next reader finishes."""
    b, p = _in(spark, sf)
    database = f"gold_{uuid.uuid4().hex[:12]}"
    location, states = storage.new_folder(spark, database), []

    def keep(state):
        totals = [F.count(F.lit(1)).alias("groups"), F.sum("fights").alias("fights"), F.sum("wins").alias("wins")]
        for mart in REFRESHED:
            found = publishing.read_mart(spark, database, mart).agg(*totals).first()
            states.append((state, mart, *found))

    gold.build_gold(spark, database, b.where(F.col("competition_id").cast("long") % 2 == 0), p, location)
    for state, step, time in (("stopped among the marts", "mart", 4), ("stopped among the views", "turn", 3)):
        try:
            gold.build_gold(spark, database, b, p, location, _stop_at(step, time))
        except Stopped:
            keep(state)
    return spark.createDataFrame(states, "state STRING, mart STRING, groups LONG, fights LONG, wins LONG")
