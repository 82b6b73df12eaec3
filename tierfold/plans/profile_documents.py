"""Typed rows from raw athlete profile documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.functions.dates import try_date
from tierfold.functions.json_text import first_text, nonzero_or, struct_of
from tierfold.functions.text import format_feet_inches, parse_feet_inches, strip_text
from tierfold.operators.refs import REF, resolve_refs

CM_PER_INCH = 2.54
DECIMAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"

LABEL = struct_of(text="STRING", name="STRING")
LENGTH = struct_of(centimeters="DOUBLE", cm="DOUBLE")
PLACE = struct_of(**{REF: "STRING"}, country="STRING", name="STRING")
MEASUREMENT = struct_of(type="STRING", value="DOUBLE", centimeters="DOUBLE")

# Numbers are declared DOUBLE, so a quoted number is NULL here.
PROFILE = struct_of(
    error="STRING",
    fullName="STRING",
    name="STRING",
    displayName="STRING",
    birthDate="STRING",
    dateOfBirth="STRING",
    citizenship="STRING",
    association=struct_of(name="STRING", location="STRUCT<country: STRING>"),
    birthPlace=PLACE,
    citizenshipCountry=struct_of(alt="STRING", name="STRING"),
    height="DOUBLE",
    heightCentimeters="DOUBLE",
    displayHeight="STRING",
    reach="DOUBLE",
    reachCentimeters="DOUBLE",
    displayReach="STRING",
    measurements=f"ARRAY<{MEASUREMENT}>",
    stance="STRING",
    fightingStyle="STRING",
    weightClass=struct_of(text="STRING", shortName="STRING"),
    styles=f"ARRAY<{LABEL}>",
    headshot="STRUCT<href: STRING>",
)
# The fields that may also be objects, read as such.
OBJECTS = struct_of(height=LENGTH, reach=LENGTH, stance=LABEL)


def country(profile: Column, birth_place: Column) -> Column:
    """Citizenship, association, birth place, then country of citizenship.

    The first branch of the right shape decides, even when its value is missing. ``birth_place``
    is the profile's birth place as an object, with its pointer followed.
    """
    of_association = profile["association"]["location"]["country"]
    nation = profile["citizenshipCountry"]
    return (
        F.when(profile["citizenship"] != "", profile["citizenship"])
        .when(of_association.isNotNull(), of_association)
        .when(birth_place.isNotNull(), first_text(birth_place["country"], birth_place["name"]))
        .when(nation.isNotNull(), first_text(nation["alt"], nation["name"]))
    )


def _half_even(value: Column) -> Column:
    return F.rint(value).try_cast("int")


def _truncated(value: Column) -> Column:
    return value.try_cast("int")


def _measured(profile: Column, kind: str) -> Column:
    """Centimetres from the first entry of that kind that holds a number."""
    values = F.transform(
        F.filter(profile["measurements"], lambda m: F.lower(m["type"]) == kind),
        lambda m: nonzero_or(m["value"], m["centimeters"]),
    )
    return _truncated(F.get(F.array_compact(values), F.lit(0)))


def _centimeters(profile: Column, objects: Column, name: str, from_text: Column) -> Column:
    """Centimetre field, object, inches as a number, display text, then measurements."""
    in_object = nonzero_or(objects[name]["centimeters"], objects[name]["cm"])
    return F.coalesce(
        _truncated(profile[f"{name}Centimeters"]),
        _truncated(in_object),
        _half_even(profile[name] * CM_PER_INCH),
        _half_even(from_text * CM_PER_INCH),
        _measured(profile, name),
    )


def height_cm(profile: Column, objects: Column) -> Column:
    return _centimeters(profile, objects, "height", parse_feet_inches(profile["displayHeight"]))


def reach_cm(profile: Column, objects: Column) -> Column:
    shown = strip_text(F.replace(profile["displayReach"], F.lit('"'), F.lit("")))
    inches = F.when(shown.rlike(DECIMAL_TEXT), shown.try_cast("double"))
    return _centimeters(profile, objects, "reach", inches)


def height_text(profile: Column) -> Column:
    """Display text, or feet and inches made from a numeric height."""
    shown = strip_text(profile["displayHeight"])
    return F.when(shown != "", shown).otherwise(format_feet_inches(profile["height"]))


def stance(profile: Column, objects: Column) -> Column:
    """Object or text; a fighting style stands in only when there is neither."""
    value = objects["stance"]
    return F.when(value.isNotNull(), first_text(value["text"], value["name"])).otherwise(
        F.coalesce(profile["stance"], F.nullif(profile["fightingStyle"], F.lit("")))
    )


def combat_style(profile: Column) -> Column:
    """Distinct style names in order, joined by a comma; NULL when there are none."""
    names = F.transform(profile["styles"], lambda s: first_text(s["text"], s["name"]))
    distinct = F.array_distinct(F.filter(names, lambda n: n != ""))
    return F.nullif(F.array_join(F.array_sort(distinct), ", "), F.lit(""))


def unreadable(payload: Column) -> Column:
    """Whether a document is missing or is not a JSON object."""
    return F.json_object_keys(payload).isNull()


def profile_rows(
    documents: DataFrame,
    refs: DataFrame | None = None,
    payload: str = "payload",
    id_column: str = "athlete_id",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per profile document that is a JSON object; ``failed`` marks those with ``error``.
    Texts that are no object give no row: see :func:`unreadable`. ``carry`` keeps further columns."""
    parsed = documents.where(~unreadable(F.col(payload))).select(
        F.col(id_column).cast("string").alias("athlete_id"),
        F.from_json(payload, PROFILE).alias("profile"),
        F.from_json(payload, OBJECTS).alias("objects"),
        F.col(payload).alias("raw_payload"),
        *carry,
    )
    parsed = parsed.withColumn("birth_place", F.col("profile.birthPlace"))
    if refs is not None:
        parsed = resolve_refs(parsed, refs, {"birth_place": PLACE}, ["athlete_id"])
    profile, objects = F.col("profile"), F.col("objects")
    weight = profile["weightClass"]
    return parsed.select(
        "athlete_id",
        first_text(profile["fullName"], profile["name"]).alias("full_name"),
        profile["displayName"].alias("display_name"),
        try_date(first_text(profile["birthDate"], profile["dateOfBirth"])).alias("birth_date"),
        country(profile, F.col("birth_place")).alias("country"),
        height_text(profile).alias("height"),
        height_cm(profile, objects).alias("height_cm"),
        reach_cm(profile, objects).alias("reach_cm"),
        stance(profile, objects).alias("stance"),
        first_text(weight["text"], weight["shortName"]).alias("weight_class"),
        profile["association"]["name"].alias("team"),
        combat_style(profile).alias("combat_style"),
        profile["headshot"]["href"].alias("image_url"),
        profile["error"].isNotNull().alias("failed"),
        "raw_payload",
        *carry,
    )
