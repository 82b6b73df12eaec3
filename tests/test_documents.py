import json

import pytest
from pyspark.sql import functions as F

from tierfold.operators.refs import ids_from_payload, ids_from_refs, resolve_refs
from tierfold.plans import event_documents as E
from tierfold.plans import profile_documents as P


def documents(spark, *objects):
    texts = [(o if isinstance(o, str) else json.dumps(o, ensure_ascii=False),) for o in objects]
    return spark.createDataFrame(texts, "payload STRING")


def references(spark, **payloads):
    rows = [(f"http://{k}", json.dumps(v, ensure_ascii=False)) for k, v in payloads.items()]
    return spark.createDataFrame(rows, "url STRING, payload STRING")


def ref(name):
    return {"$ref": f"http://{name}"}


ENVELOPED = {
    "header": {
        "id": 7,
        "shortName": "Short",
        "competitions": [
            {
                "id": "9", "date": "2020-01-02T10:00Z", "name": "", "notes": [{"headline": "Head"}],
                "matchNumber": None, "order": "3", "weightClass": ref("light"),
                "status": {"type": {"name": "FINAL"}},
                "competitors": [
                    {
                        "winner": True, "athlete": ref("first"),
                        "statistics": [
                            {"name": "a ", "displayValue": "", "value": 0},
                            {"shortDisplayName": "b", "value": 1.50},
                            {"name": "c", "value": 70.0},
                            {"name": "a", "displayValue": " z "},
                            {"name": ""},
                        ],
                    },
                    ref("gone"),
                ],
            },
            ref("bout"),
        ],
    }
}
REFS = {
    "light": {"name": "Light"},
    "first": {"fullName": "Čapek"},
    "bout": {"id": 10, "competitors": ref("pair"), "type": {"text": "Heavy"}, "matchNumber": 0},
    "pair": {"items": [ref("winner")]},
    "winner": {"winner": False, "athlete": {"displayName": "Q"}, "statistics": ref("stats")},
    "stats": {"stats": [{"name": "k", "displayValue": "5"}]},
}


def test_event_rows(spark):
    docs = documents(
        spark,
        ENVELOPED,
        {"id": "x"},
        "{broken",
        {"id": "1", "name": "N", "date": "2020-02-02", "header": "text", "competitions": []},
        {"id": "2", "name": "", "status": {"name": "S"}, "venue": {"fullName": ""},
         "competitions": [{"name": "B", "venue": {"fullName": "V", "address": {"country": "C"}}}]},
    )
    rows = {r.event_id: r for r in E.event_rows(docs).collect()}
    assert set(rows) == {"7", "x", "", "1", "2"}
    assert rows["7"][1:7] == ("2020-01-02T10:00Z", "Short", None, None, "FINAL", 2)
    assert rows["x"][1:7] == (None, None, None, None, None, 0)
    assert rows["1"][1:7] == ("2020-02-02", "N", None, None, None, 0)
    assert rows["2"][1:7] == (None, "B", "V", "C", "S", 1)
    assert json.loads(rows["7"].raw_payload) == ENVELOPED


def test_bout_rows_follow_pointers_level_by_level(spark):
    rows = E.bout_rows(documents(spark, ENVELOPED), references(spark, **REFS)).collect()
    first, second = sorted(rows, key=lambda r: r.competition_id, reverse=True)
    assert first.asDict() | {"raw_payload": None} == {
        "competition_id": "9", "event_id": "7", "event_date": "2020-01-02T10:00Z",
        "bout_name": "Head", "weight_class": "Light", "card_order": 3, "status": "FINAL",
        "fighter_a_name": "Čapek", "fighter_a_winner": True,
        "fighter_a_stats": '{"a":"z","b":"1.5","c":"70.0"}',
        "fighter_b_name": None, "fighter_b_winner": None, "fighter_b_stats": "{}",
        "raw_payload": None,
    }
    assert (second.competition_id, second.weight_class, second.card_order) == ("10", "Heavy", 0)
    assert (second.fighter_a_name, second.fighter_a_winner) == ("Q", False)
    assert second.fighter_a_stats == '{"k":"5"}'
    assert second.fighter_b_name is None


def test_bouts_are_shuffled_once_whatever_they_point_to(spark, plan):
    """Bouts alike in event and place, half of them pointing to one document."""
    event = lambda k: {"id": 1, "competitions": [{"id": k, "competitors": [
        {"athlete": {"fullName": f"A{k}"}}, ref("hot") if k % 2 else {"athlete": ref("gone")}]}]}
    found = references(spark, hot={"athlete": ref("star")}, star={"fullName": "Star"})
    docs = documents(spark, *map(event, range(40)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = E.bout_rows(docs, found.union(found))
        text = plan(rows)
        got = {r.competition_id: (r.fighter_a_name, r.fighter_b_name) for r in rows.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {str(k): (f"A{k}", "Star" if k % 2 else None) for k in range(40)}
    assert text.count("Exchange hashpartitioning(_key") == 1


def test_bout_rows_without_references_keep_inline_parts(spark):
    event = {"id": 1, "competitions": [{"id": 2, "competitors": [
        {"winner": None, "athlete": {"displayName": "", "fullName": "F"}, "statistics": None}]}]}
    row = E.bout_rows(documents(spark, event)).first()
    assert (row.fighter_a_name, row.fighter_a_winner, row.fighter_a_stats) == ("F", None, "{}")


def test_pointers_to_one_hot_document(spark):
    """A third of the rows share one pointer; the rest hold the object or point nowhere."""
    rows = spark.range(300).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.struct(F.lit("http://hot").alias("$ref"),
                                              F.lit(None).cast("string").alias("name")))
        .when(F.col("id") % 3 == 1, F.struct(F.lit(None).cast("string").alias("$ref"),
                                             F.lit("inline").alias("name")))
        .otherwise(F.struct(F.lit("http://gone").alias("$ref"),
                            F.lit(None).cast("string").alias("name"))).alias("o"),
    )
    kind = "STRUCT<`$ref`: STRING, name: STRING>"
    once = references(spark, hot={"name": "shared"})
    found = resolve_refs(rows, once.union(once), {"o": kind}, ["id"])
    counts = {r["name"]: r["count"] for r in found.groupBy("o.name").count().collect()}
    assert counts == {"shared": 100, "inline": 100, None: 100}


def test_ids(spark):
    payload = {"competitions": [{"competitors": [
        {"athlete": {"$ref": "http://x/athletes/12?lang=en"}},
        {"athlete": {"$ref": "http://x/teams/5"}}, {"athlete": {"$ref": None}}, {}]},
        {"competitors": []}, {}], "other": "http://y/athletes/7"}
    docs = documents(spark, payload, payload, {"competitions": None})
    schema = "competitions ARRAY<STRUCT<competitors: ARRAY<STRUCT<athlete: STRUCT<`$ref`: STRING>>>>>"
    events = docs.select(F.from_json("payload", schema).alias("e")).select("e.*")
    assert [r[0] for r in ids_from_refs(events).collect()] == ["12"]
    assert sorted(r[0] for r in ids_from_payload(docs, "payload").collect()) == ["12", "7"]


def profile(spark, refs=None, **fields):
    docs = documents(spark, fields).withColumn("athlete_id", F.lit(1))
    return P.profile_rows(docs, references(spark, **refs) if refs else None).first()


@pytest.mark.parametrize(
    "fields, cm, text",
    [
        ({"heightCentimeters": 180.9, "height": 10}, 180, "0' 10\""),
        ({"height": {"centimeters": 0, "cm": 177.9}}, 177, None),
        ({"height": 71.6}, 182, "5' 12\""),
        ({"height": "71", "displayHeight": " 6' 1\" "}, 185, "6' 1\""),
        ({"displayHeight": "tall", "measurements": [
            {"type": "reach", "value": 1}, {"type": "Height", "value": "x"},
            {"type": "height", "value": 0, "centimeters": 170.2}]}, 170, "tall"),
        ({}, None, None),
    ],
)
def test_height_ladder(spark, fields, cm, text):
    row = profile(spark, **fields)
    assert (row.height_cm, row.height) == (cm, text)


@pytest.mark.parametrize(
    "fields, cm",
    [
        ({"reachCentimeters": 181.7}, 181), ({"reach": {"cm": 190}}, 190), ({"reach": 70}, 178),
        ({"displayReach": '72.5"'}, 184), ({"displayReach": "72d"}, None),
        ({"displayReach": "?", "measurements": [{"type": "reach", "centimeters": 188}]}, 188),
    ],
)
def test_reach_ladder(spark, fields, cm):
    assert profile(spark, **fields).reach_cm == cm


@pytest.mark.parametrize(
    "fields, country",
    [
        ({"citizenship": "CZ", "citizenshipCountry": {"alt": "X"}}, "CZ"),
        ({"citizenship": "", "association": {"location": {"country": "USA"}}}, "USA"),
        ({"birthPlace": {"country": "", "name": "Brno"}}, "Brno"),
        ({"birthPlace": ref("place")}, "Praha"),
        ({"birthPlace": ref("gone"), "citizenshipCountry": {"alt": "X"}}, None),
        ({"citizenshipCountry": {"alt": "", "name": "Y"}}, "Y"),
        ({}, None),
    ],
)
def test_country(spark, fields, country):
    refs = {"place": {"country": "", "name": "Praha"}}
    assert profile(spark, refs, **fields).country == country


def test_profile_attributes(spark):
    row = profile(
        spark, fullName="", name="N", birthDate=None, dateOfBirth="1990-05-06", stance={},
        fightingStyle="F", association={"name": "T"}, weightClass={"shortName": "LW"},
        styles=[{"text": "Judo"}, {"name": "Boxing"}, {"text": "Judo"}, {}], headshot={"href": "u"},
    )
    assert (row.full_name, str(row.birth_date), row.stance, row.team) == (
        "N", "1990-05-06", None, "T"
    )
    assert (row.weight_class, row.combat_style, row.image_url) == ("LW", "Boxing, Judo", "u")
    assert profile(spark, stance="South").stance == "South"
    assert profile(spark, fightingStyle="F").stance == "F"
    assert profile(spark, stance={"name": "S"}, styles=[]).combat_style is None


def test_failed_fetches_are_marked(spark):
    docs = documents(spark, {"error": "timed out"}, "{broken", {"fullName": "A"})
    rows = P.profile_rows(docs.withColumn("athlete_id", F.lit(1))).collect()
    assert [(r.full_name, r.failed) for r in rows] == [(None, True), ("A", False)]


@pytest.mark.parametrize(
    "fields",
    [
        {"heightCentimeters": 1e12, "reachCentimeters": 1e12}, {"height": 1e300, "reach": -1e300},
        {"displayHeight": "999999999' 1", "displayReach": "1e99"},
        {"displayHeight": "99999999999999999999' 1"}, {"displayHeight": "5' 99999999999"},
        {"height": {"centimeters": 1e12}, "reach": {"cm": 1e12}},
        {"measurements": [{"type": "height", "value": 1e12}, {"type": "reach", "value": 1e12}]},
    ],
)
def test_numbers_out_of_range_give_null(spark, fields):
    row = profile(spark, **fields)
    assert (row.height_cm, row.reach_cm) == (None, None)


def test_documents_are_parsed_once(spark, plan):
    """No inferred filter may parse the document again below the rows."""
    docs = documents(spark, ENVELOPED)
    rows = E.exploded_bouts(docs).select("event_id", "bout_text")
    assert plan(rows).count("from_json(") == 1
