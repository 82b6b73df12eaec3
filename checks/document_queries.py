"""Rows out of JSON documents, pointer resolution and id harvesting."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.documents import (
    BOUT_ROWS, EVENTS, PROFILE_ROWS, athlete_url, event_documents, event_refs, place_refs,
    profile_documents,
)
from checks.inputs import with_
from checks.registry import query, table
from tierfold.operators import refs
from tierfold.operators.unnest import unnest
from tierfold.plans import event_documents as E
from tierfold.plans import profile_documents as P

POINTERS = "ARRAY<STRUCT<competitors: ARRAY<STRUCT<athlete: STRUCT<`$ref`: STRING>>>>>"
POINTER_SCHEMA = f"competitions {POINTERS}, header STRUCT<competitions: {POINTERS}>"


@query("json_event_rows", f"{with_(EVENTS)} SELECT * FROM event_rows")
def json_event_rows(spark, sf):
    return E.event_rows(event_documents(spark, sf)).drop("raw_payload")


@query(
    "json_explode_nested",
    f"""{with_(EVENTS)} SELECT CAST(k AS VARCHAR) AS event_id,
      CAST(k * 10 + i AS VARCHAR) AS competition_id, CAST(position AS INTEGER) AS position,
      CASE st WHEN 'F' THEN position = 0 WHEN 'O' THEN position = 1 END AS winner
    FROM (SELECT *, unnest(range(2)) AS position FROM (SELECT *, unnest(range(n)) AS i FROM ev))""",
)
def json_explode_nested(spark, sf):
    competitors = E.exploded_competitors(event_documents(spark, sf))
    return competitors.select("event_id", "competition_id", "position", "winner")


@query("json_bout_rows", f"{with_(EVENTS, BOUT_ROWS)} SELECT * FROM bout_rows")
def json_bout_rows(spark, sf):
    return E.bout_rows(event_documents(spark, sf), event_refs(spark, sf)).drop("raw_payload")


# Flags as documents may hold them, and whether each counts as true.
FLAGS = {
    "true": True, "false": False, '"false"': True, '"true"': True, '""': False, '"0"': True, "0": False,
    "1": True, "0.0": False, "-0.5": True, "1e3": True, "null": None, "": None, "{}": False, "[]": False,
    '{"x": 0}': True, "[0]": True,
}


@query(
    "typed_flags",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS competition_id, f[1 + o_orderkey % {len(FLAGS)}] AS fighter_a_winner,
      f[1 + o_custkey % {len(FLAGS)}] AS fighter_b_winner
    FROM orders, (SELECT [{", ".join("NULL" if f is None else str(f).lower() for f in FLAGS.values())}] AS f)""",
)
def typed_flags(spark, sf):
    """Winners given as flags, texts, numbers, lists, objects or not at all; every other second
    competitor is behind a pointer."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    written = F.array(*(F.lit(f', "winner": {flag}' if flag else "") for flag in FLAGS))
    flag = lambda key: F.get(written, (key % len(FLAGS)).cast("int"))
    url = F.concat(F.lit("http://x/competitors/"), (c % len(FLAGS)).cast("string"))
    inline = F.concat(F.lit('{"athlete": {}'), flag(c), F.lit("}"))
    second = F.when(k % 2 == 0, inline).otherwise(F.concat(F.lit('{"$ref": "'), url, F.lit('"}')))
    payload = F.concat(
        F.lit('{"id": 1, "competitions": [{"id": '), k.cast("string"), F.lit(', "competitors": [{"athlete": {}'),
        flag(k), F.lit("}, "), second, F.lit("]}]}"),
    )
    documents = table(spark, sf, "orders").select(payload.alias("payload"))
    pointed = table(spark, sf, "orders").select(
        url.alias("url"), F.concat(F.lit('{"uid": 1'), flag(c), F.lit("}")).alias("payload")
    )
    rows = E.bout_rows(documents, pointed)
    return rows.select("competition_id", "fighter_a_winner", "fighter_b_winner")


@query(
    "json_stats_map",
    f"""{with_(EVENTS)} SELECT CAST(k * 10 + i AS VARCHAR) AS competition_id, stat,
      CASE stat WHEN 'kd' THEN CAST(k AS VARCHAR) ELSE CAST(i AS VARCHAR) END AS value
    FROM (SELECT *, unnest(range(n)) AS i FROM ev), (VALUES ('kd'), ('td')) v(stat)""",
)
def json_stats_map(spark, sf):
    competitors = E.exploded_competitors(event_documents(spark, sf))
    stats = E.stats_map(E.statistics(F.col("statistics")))
    pairs = unnest(competitors, ["competition_id"], F.map_entries(stats), "pair")
    return pairs.select(
        "competition_id", F.col("pair.key").alias("stat"), F.col("pair.value").alias("value")
    )


@query(
    "resolve_refs",
    """SELECT o_orderkey, coalesce(c_name, NULL) AS full_name, o_orderkey % 4 = 1 AS inline
    FROM orders LEFT JOIN customer ON o_orderkey % 4 <> 1
      AND c_custkey = CASE WHEN o_orderkey % 4 = 2 THEN -1 ELSE o_custkey END
    WHERE o_orderkey % 4 <> 1
    UNION ALL SELECT o_orderkey, 'Inline ' || o_orderkey, true FROM orders
    WHERE o_orderkey % 4 = 1""",
)
def resolve_refs(spark, sf):
    """Orders that point to a customer, to nobody, or hold the name themselves."""
    k = F.col("o_orderkey")
    missing = F.lit('{"$ref": "http://x/athletes/none"}')
    pointer = F.to_json(F.struct(athlete_url(F.col("o_custkey")).alias("$ref")))
    inline = F.to_json(F.struct(F.concat(F.lit("Inline "), k.cast("string")).alias("fullName")))
    written = F.when(k % 4 == 1, inline).when(k % 4 == 2, missing).otherwise(pointer)
    rows = table(spark, sf, "orders").select(
        k, (k % 4 == 1).alias("inline"), F.from_json(written, E.ATHLETE).alias("athlete")
    )
    found = refs.resolve_refs(
        rows, event_refs(spark, sf), {"athlete": E.ATHLETE}, ["o_orderkey"]
    )
    return found.select("o_orderkey", F.col("athlete.fullName").alias("full_name"), "inline")


@query("ids_from_refs", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS athlete_id FROM orders")
def ids_from_refs(spark, sf):
    parsed = F.from_json("payload", POINTER_SCHEMA)
    documents = event_documents(spark, sf).select(parsed.alias("e"))
    competitions = F.coalesce("e.header.competitions", "e.competitions")
    return refs.ids_from_refs(documents.select(competitions.alias("competitions")))


@query("ids_from_payload", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS athlete_id FROM orders")
def ids_from_payload(spark, sf):
    return refs.ids_from_payload(event_documents(spark, sf), "payload")


def _profile(*fields: str) -> str:
    return f"{with_(PROFILE_ROWS)} SELECT athlete_id, {', '.join(fields)} FROM profile_rows"


def _profiles(spark, sf):
    return P.profile_rows(profile_documents(spark, sf), place_refs(spark, sf)).drop("raw_payload")


@query("profile_country", _profile("country"))
def profile_country(spark, sf):
    return _profiles(spark, sf).select("athlete_id", "country")


@query("profile_height_cm", _profile("height", "height_cm"))
def profile_height_cm(spark, sf):
    return _profiles(spark, sf).select("athlete_id", "height", "height_cm")


@query("profile_reach_cm", _profile("reach_cm"))
def profile_reach_cm(spark, sf):
    return _profiles(spark, sf).select("athlete_id", "reach_cm")


@query("profile_attributes", _profile("stance", "team", "weight_class"))
def profile_attributes(spark, sf):
    return _profiles(spark, sf).select("athlete_id", "stance", "team", "weight_class")


@query("profile_style_list", _profile("combat_style"))
def profile_style_list(spark, sf):
    return _profiles(spark, sf).select("athlete_id", "combat_style")


@query("json_profile_rows", f"{with_(PROFILE_ROWS)} SELECT * FROM profile_rows")
def json_profile_rows(spark, sf):
    return _profiles(spark, sf)
