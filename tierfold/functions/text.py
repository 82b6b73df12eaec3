"""Label clean-up, label bucketing and feet-and-inches text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space at the ends of a label.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Separators between several styles in one text, in the order they are unified.
STYLE_SEPARATORS = [",", ";", "&", "|", "\\", " and ", " vs ", "/"]

# The style token that belongs to each bucket; all others fall in DEFAULT_STYLE.
STYLE_BUCKETS = {
    "wrestler": ["grappling", "wrestling", "thugjistu", "sambo", "judo", "jiu_jitsu"],
    "striker": [
        "sanda", "muay_thai", "kung_fu", "teakwondo", "taekwondo",
        "ninja", "nikidokai", "boxing", "kickboxing", "karate",
    ],
    "street_fighting": ["street_fighting", "brawler"],
    "mma": ["mixed_martial_artist", "mixed_martial_arts", "freestyle"],
}
DEFAULT_STYLE = "mma"
BLANK_STYLE = "mixed martial arts"
# Tokens that contain either name are jiu-jitsu; the token that stands for no style.
JIU_JITSU = r"(?s)^.*(brazilian_jiu|jiu_jitsu).*$"
DROPPED = "0"


def strip_text(text: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` removes blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def normalize_label(text: Column, unknown: str = "unknown") -> Column:
    """Lower-case label with ``_`` for blanks; missing or blank becomes ``unknown``."""
    return F.when(_blank(text), F.lit(unknown)).otherwise(
        F.replace(F.lower(strip_text(text)), F.lit(" "), F.lit("_"))
    )


def normalize_name(text: Column) -> Column:
    """Lower-case stripped name; missing or blank becomes NULL."""
    return F.when(~_blank(text), F.lower(strip_text(text)))


def bucket_label(
    text: Column,
    buckets: Mapping[str, Sequence[str]] = STYLE_BUCKETS,
    separators: Sequence[str] = STYLE_SEPARATORS,
    default: str = DEFAULT_STYLE,
    blank: str = BLANK_STYLE,
) -> Column:
    """Bucket of the first style named in a text; an explicit ``0`` gives NULL.

    Separators are unified one after the other, since their order can change the first token. The
    steps form one chain in which each value is used once, so generated code stays small.
    """
    base = F.coalesce(F.nullif(F.lower(strip_text(text)), F.lit("")), F.lit(blank))
    unified = reduce(lambda c, sep: F.replace(c, F.lit(sep), F.lit("/")), separators, base)
    first = strip_text(F.substring_index(unified, "/", 1))
    joined = F.replace(F.replace(first, F.lit("-"), F.lit("_")), F.lit(" "), F.lit("_"))
    token = F.regexp_replace(joined, JIU_JITSU, "jiu_jitsu")
    lookup = {token: bucket for bucket, tokens in buckets.items() for token in tokens}
    lookup[DROPPED] = DROPPED
    named = F.try_element_at(F.create_map(*(F.lit(x) for kv in lookup.items() for x in kv)), token)
    return F.nullif(F.coalesce(named, F.lit(default)), F.lit(DROPPED))


# Fixed value: feet, an apostrophe, then optional inches and an optional double quote.
FEET_INCHES = r"^(\d+)\s*'\s*(\d+)?\s*\"?"


def parse_feet_inches(text: Column) -> Column:
    """Inches as INT from text such as ``6' 1"``; NULL when it does not start that way, or when the
    number is out of range."""
    stripped = strip_text(text)

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(stripped, FEET_INCHES, group), F.lit(""))

    inches = F.coalesce(part(2), F.lit("0")).try_cast("int")
    return F.try_add(F.try_multiply(part(1).try_cast("int"), F.lit(12)), inches)


def format_feet_inches(inches: Column) -> Column:
    """Text such as ``6' 1"``; the rest is rounded half-even, so 71.6 gives ``5' 12"``."""
    value = inches.cast("double")
    feet = F.floor(value / 12).try_cast("int")
    rest = F.rint(value - F.floor(value / 12) * 12.0).try_cast("int")
    return F.concat(feet.cast("string"), F.lit("' "), rest.cast("string"), F.lit('"'))
