"""Reading raw JSON documents with declared schemas.

A document is parsed with ``from_json`` into typed fields. A part that may be a list or an object
is declared STRING, which keeps its JSON text, and is opened in a second step; one whose type tells
something is declared VARIANT. A field of another
type than declared is NULL and leaves the others intact. "First of
several values" means the first that is not empty, as dynamic code does with ``or``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON texts that count as false.
FALSE_TEXTS = ["false", '""', "0", "0.0", "-0.0", "{}", "[]"]


def first_text(*values: Column) -> Column:
    """The first value that is not empty; the last one is taken as it is."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values[:-1]), values[-1])


def is_object(text: Column) -> Column:
    return F.coalesce(F.startswith(text, F.lit("{")), F.lit(False))


def nonzero_or(number: Column, other: Column) -> Column:
    return F.coalesce(F.nullif(number, F.lit(0.0)), other)


def truth(value: Column) -> Column:
    """Flag from a VARIANT, as dynamic code takes it: false are the flag false, zero, and empty texts,
    lists and objects, so the text "false" is true; NULL when missing or null."""
    known = value.isNotNull() & ~F.is_variant_null(value)
    return F.when(known, ~F.to_json(value).isin(FALSE_TEXTS))


def struct_of(**fields: str) -> str:
    """Type text of an object with the given fields."""
    return f"STRUCT<{', '.join(f'`{name}`: {kind}' for name, kind in fields.items())}>"
