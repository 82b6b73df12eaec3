"""Gold marts over silver bouts and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.functions.numbers import bin_label, clip, safe_ratio
from tierfold.functions.text import (
    DEFAULT_STYLE,
    STYLE_BUCKETS,
    bucket_label,
    normalize_label,
    normalize_name,
)
from tierfold.operators.matchup import (
    FIGHTER_SIDES,
    KeySplit,
    binned_pairs,
    matrix,
    name_index,
    name_rows,
    shared_keys,
    split_by_key,
    unpivot_sides,
    weighted_pairs,
    win_counts,
    win_rate,
    with_win_rate,
)
from tierfold.sources import journal, publishing, storage, tables

Bouts = DataFrame | KeySplit
PROFILE_NAMES = ["full_name", "display_name"]

# Bin edges in centimetres.
HEIGHT_EDGES = [-25, -20, -15, -10, -5, 0, 5, 10, 15, 20, 25]
REACH_EDGES = [-30, -20, -10, 0, 10, 20, 30]


def stance_pairs(bouts: Bouts, profiles: DataFrame, dims: Sequence[str] = ()) -> DataFrame:
    """Weighted (stance, opp_stance) pairs: ``unknown`` for a known athlete without a stance,
    NULL for a name nobody has."""
    stances = profiles.withColumn("stance", normalize_label(F.col("stance")))
    return weighted_pairs(bouts, name_index(stances, PROFILE_NAMES, ["stance"]), ["stance"], dims)


def stance_by_class(bouts: Bouts, profiles: DataFrame) -> DataFrame:
    pairs = stance_pairs(bouts, profiles, ["weight_class"])
    return win_rate(pairs, ["weight_class", "stance", "opp_stance"], weight="weight")


def stance_overall(bouts: Bouts, profiles: DataFrame) -> DataFrame:
    return win_rate(stance_pairs(bouts, profiles), ["stance", "opp_stance"], weight="weight")


def style_overall(bouts: Bouts, profiles: DataFrame) -> DataFrame:
    """Unknown names and explicitly dropped styles both count as the default style."""
    styles = profiles.withColumn("style", bucket_label(F.col("combat_style")))
    pairs = weighted_pairs(bouts, name_index(styles, PROFILE_NAMES, ["style"]), ["style"])
    named = {c: F.coalesce(F.col(c), F.lit(DEFAULT_STYLE)) for c in ("style", "opp_style")}
    return win_rate(pairs.withColumns(named), ["style", "opp_style"], weight="weight")


def style_matrix(styles: DataFrame, fill: float | None = 0.0) -> DataFrame:
    """Win rate of each style (rows) against each style (columns)."""
    return matrix(styles, "style", "opp_style", "win_rate", list(STYLE_BUCKETS), fill)


def team_results(
    bouts: DataFrame, profiles: DataFrame, dims: dict[str, Column] | None = None
) -> DataFrame:
    """fights, wins, fighters and ratios per team (and per ``dims``); unknown teams are left out.

    Results are counted per name before the names meet the profiles, so a name with very many
    bouts is one row by then, and a name shared by athletes multiplies counts and not bouts.
    """
    dims = dims or {}
    sides = unpivot_sides(bouts.withColumns(dims), list(dims), FIGHTER_SIDES)
    per_name = (
        sides.groupBy(F.lower("athlete_name").alias("name"), *dims)
        .agg(*win_counts())
    )
    teams = profiles.withColumn("team_norm", normalize_name(F.col("team"))).where(
        "team_norm IS NOT NULL"
    )
    members = name_rows(teams, PROFILE_NAMES, "athlete_id", "team_norm")
    per_team = (
        per_name.join(members, "name")
        .groupBy("team_norm", *dims)
        .agg(
            F.sum("fights").alias("fights"),
            F.sum("wins").alias("wins"),
            F.count_distinct("athlete_id").alias("fighters"),
        )
    )
    return with_win_rate(per_team).withColumn(
        "fights_per_fighter", safe_ratio(F.col("fights"), F.col("fighters"))
    )


def team_overall(bouts: DataFrame, profiles: DataFrame) -> DataFrame:
    return team_results(bouts, profiles)


def team_by_year(bouts: DataFrame, profiles: DataFrame) -> DataFrame:
    return team_results(bouts, profiles, {"event_year": F.year("event_date")})


def advantage_pairs(bouts: Bouts, profiles: DataFrame) -> DataFrame:
    """Counted pairs by clipped and binned height and reach advantage, where the height advantage
    is known."""
    body = ["height_cm", "reach_cm"]

    def advantages(own: Column, opponent: Column) -> Column:
        height = own["height_cm"] - opponent["height_cm"]
        reach = own["reach_cm"] - opponent["reach_cm"]
        return F.struct(
            clip(height, HEIGHT_EDGES[0], HEIGHT_EDGES[-1]).alias("height_adv_low"),
            clip(reach, REACH_EDGES[0], REACH_EDGES[-1]).alias("reach_adv_low"),
        )

    edges = {"height_adv_low": HEIGHT_EDGES, "reach_adv_low": REACH_EDGES}
    index = name_index(profiles, PROFILE_NAMES, body)
    pairs = binned_pairs(bouts, index, body, advantages, edges).where("height_adv_low IS NOT NULL")
    return pairs.withColumns(
        {
            "height_adv_bin": bin_label(F.col("height_adv_low"), HEIGHT_EDGES),
            "reach_adv_bin": bin_label(F.col("reach_adv_low"), REACH_EDGES),
        }
    )


def height_bins(bouts: Bouts, profiles: DataFrame) -> DataFrame:
    """Win rate per height advantage; ``height_adv_low`` sorts the bins by number."""
    return win_rate(
        advantage_pairs(bouts, profiles), ["height_adv_bin", "height_adv_low"], weight="weight"
    )


def height_by_reach(bouts: Bouts, profiles: DataFrame) -> DataFrame:
    """Win rate per height and reach advantage; an unknown reach is a group of its own."""
    return win_rate(
        advantage_pairs(bouts, profiles), ["height_adv_bin", "reach_adv_bin"], weight="weight"
    )


def rolled_up(mart: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Coarser grain of a mart with fights and wins: counts add up, the rate is taken anew."""
    return with_win_rate(
        mart.groupBy(*dims).agg(F.sum("fights").alias("fights"), F.sum("wins").alias("wins"))
    )


def build_gold(
    spark: SparkSession, database: str, bouts: DataFrame, profiles: DataFrame,
    location: str | None = None, step: journal.Step = journal._nothing,
) -> dict[str, DataFrame]:
    """Refresh every mart and turn its views (``mv_*``, ``v_*``) to it; returns the views by name.

    Each pairing runs once, at its finest grain; coarser marts are rolled up from the stored one.
    Readers see the marts of the last refresh until all of this one stand.
    """
    tables.create_database(spark, database, location)
    version, marts = publishing.next_version(spark, database), {}

    def store(name: str, df: DataFrame) -> None:
        step("mart")
        marts[name] = tables.materialize_mart(df, publishing.table_of(database, name, version))

    # a small table, in general, that spares each pairing to deal out the bouts by key
    with storage.staged(shared_keys(bouts), "shared") as shared:
        paired = split_by_key(bouts, shared=shared)
        store("stance_matchups", stance_by_class(paired, profiles))
        store("stance_matchups_overall", rolled_up(marts["stance_matchups"], ["stance", "opp_stance"]))
        store("style_matchups_overall", style_overall(paired, profiles))
        store("team_performance", team_overall(bouts, profiles))
        store("team_performance_year", team_by_year(bouts, profiles))
        store("height_vs_reach_heatmap", height_by_reach(paired, profiles))
        store("height_advantage_bins_overall", rolled_up(marts["height_vs_reach_heatmap"], ["height_adv_bin"]))
    return publishing.publish(spark, database, list(marts), version, step)
