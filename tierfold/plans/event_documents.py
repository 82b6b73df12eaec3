"""Typed rows from raw event documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.functions.json_text import first_text, is_object, struct_of, truth
from tierfold.functions.numbers import digits_to_int
from tierfold.functions.text import strip_text
from tierfold.operators.refs import REF, resolve_refs, with_documents
from tierfold.operators.unnest import unnest

POINTER = {REF: "STRING"}
NAMED = struct_of(**POINTER, name="STRING", type="STRUCT<name: STRING>")
VENUE = struct_of(fullName="STRING", address="STRUCT<country: STRING>")
NOTES = "ARRAY<STRUCT<headline: STRING>>"

EVENT_FIELDS = {
    "id": "STRING", "date": "STRING", "name": "STRING", "shortName": "STRING", "venue": VENUE,
    "status": NAMED, "competitions": "ARRAY<STRING>",
}
EVENT = struct_of(**EVENT_FIELDS, header=struct_of(**EVENT_FIELDS))
FIRST_BOUT = struct_of(date="STRING", name="STRING", notes=NOTES, venue=VENUE, status=NAMED)
ATHLETE = struct_of(**POINTER, displayName="STRING", fullName="STRING")
# Statistics are a list or an object around one, so they stay text for now.
COMPETITOR = struct_of(**POINTER, winner="VARIANT", athlete=ATHLETE, statistics="STRING")
COMPETITORS = f"ARRAY<{COMPETITOR}>"
BOUT = struct_of(
    **POINTER, id="STRING", name="STRING", notes=NOTES, type="STRUCT<text: STRING>",
    weightClass=NAMED, weight=NAMED, matchNumber="STRING", order="STRING", status=NAMED,
    competitors=COMPETITORS,
)
COMPETITOR_BOX = struct_of(**POINTER, items=COMPETITORS)
STATISTIC = struct_of(
    name="STRING", shortDisplayName="STRING", displayValue="STRING", value="STRING"
)
STATISTICS = f"ARRAY<{STATISTIC}>"
STATISTICS_BOX = struct_of(**POINTER, stats=STATISTICS, items=STATISTICS)

# Only the pointers of a bout, or of what a bout leads to; a list or an object stays text for now.
LINK = struct_of(**POINTER)
LINKED = struct_of(**POINTER, athlete=LINK, statistics="STRING")
LINKS = struct_of(
    **POINTER, weightClass=LINK, weight=LINK, status=LINK, athlete=LINK, statistics="STRING",
    competitors="STRING", items=f"ARRAY<{LINKED}>",
)
#: The longest way: bout, competitors, competitor, athlete.
HOPS = 4

#: Columns of an event row that its bouts are read from.
BOUT_PARTS = ["bout_date", "bout_texts"]


def _opened(documents: DataFrame, payload: str) -> DataFrame:
    """(event, short_name, first, raw_payload): the event, out of its ``header`` envelope if it
    has one, and its first bout."""
    parsed = documents.select(
        F.from_json(payload, EVENT).alias("document"), F.col(payload).alias("raw_payload")
    )
    plain = F.struct(*(F.col(f"document.{name}") for name in EVENT_FIELDS))
    opened = parsed.select(
        F.coalesce("document.header", plain).alias("event"),
        F.col("document.header.shortName").alias("short_name"),
        "raw_payload",
    )
    return opened.withColumn("first", F.from_json(F.get("event.competitions", F.lit(0)), FIRST_BOUT))


def _headline(notes: Column) -> Column:
    return F.get(notes, F.lit(0))["headline"]


def event_rows(documents: DataFrame, payload: str = "payload", parts: Sequence[str] = ()) -> DataFrame:
    """One row per event document; ``event_date`` is still text.

    An unreadable document gives a row with an empty id, which the bronze gate rejects. ``parts`` may
    be ``BOUT_PARTS``, what :func:`opened_bouts` takes: stored with the rows, it spares the documents
    of a load a second parse.
    """

    def either(field: str) -> tuple[Column, Column]:
        return F.col(f"event.{field}"), F.col(f"first.{field}")

    return _opened(documents, payload).select(
        F.coalesce("event.id", F.lit("")).alias("event_id"),
        first_text(*either("date")).alias("event_date"),
        first_text(
            F.col("event.name"), F.col("short_name"), F.col("first.name"),
            _headline(F.col("first.notes")),
        ).alias("event_name"),
        first_text(*either("venue.fullName")).alias("venue"),
        first_text(*either("venue.address.country")).alias("country"),
        first_text(
            F.col("event.status.type.name"), F.col("event.status.name"),
            F.col("first.status.type.name"), F.col("first.status.name"),
        ).alias("status"),
        F.coalesce(F.size("event.competitions"), F.lit(0)).alias("num_fights"),
        "raw_payload",
        *(c for c in _bout_parts() if parts),
    )


def _bout_parts() -> list[Column]:
    """The date as an event's bouts take it, and their texts, of an opened document."""
    first = F.get("event.competitions", F.lit(0))
    date = first_text(F.col("event.date"), F.get_json_object(first, "$.date"))
    return [c.alias(name) for c, name in zip((date, F.col("event.competitions")), BOUT_PARTS)]


def opened_bouts(events: DataFrame) -> DataFrame:
    """(event_id, event_date, bout_index, bout_text): one row per bout of events with ``BOUT_PARTS``."""
    date, texts = BOUT_PARTS
    event_id = F.coalesce("event_id", F.lit("")).alias("event_id")
    return unnest(events, [event_id, F.col(date).alias("event_date")], texts, "bout_text", "bout_index")


def _bout_texts(documents: DataFrame, payload: str) -> DataFrame:
    return opened_bouts(_opened(documents, payload).select(F.col("event.id").alias("event_id"), *_bout_parts()))


def exploded_bouts(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """(event_id, event_date, bout_index, bout_text, bout): one row per bout."""
    return _bout_texts(documents, payload).withColumn("bout", F.from_json("bout_text", BOUT))


def bout_pointers(rows: DataFrame, text: str, urls: str) -> DataFrame:
    """``rows`` with the urls that a bout, or a document that a bout leads to, may be followed to.

    ``urls`` lists them, with NULLs and empty texts among them. No lambda is used, since it would not be
    compiled; each text is parsed in a step of its own, so that it is parsed once.
    """

    def of_statistics(c: Column) -> Column:
        return F.when(is_object(c["statistics"]), F.from_json(c["statistics"], LINK))[REF]

    def of_pair(competitors: Column) -> list[Column]:
        pair = [F.get(competitors, F.lit(i)) for i in range(2)]
        return [url for c in pair for url in (c[REF], c["athlete"][REF], of_statistics(c))]

    o, boxes = F.col("_links"), F.col("_links.competitors")
    parsed = rows.withColumn("_links", F.from_json(text, LINKS)).withColumns(
        {
            "_listed": F.from_json(boxes, f"ARRAY<{LINKED}>"),  # an object gives a list of one
            "_boxed": F.when(is_object(boxes), F.from_json(boxes, struct_of(items=f"ARRAY<{LINKED}>"))),
        }
    )
    own = [o[REF], *(o[c][REF] for c in ("weightClass", "weight", "status", "athlete")), of_statistics(o)]
    pairs = [url for c in (F.col("_listed"), F.col("_boxed.items"), o["items"]) for url in of_pair(c)]
    found = F.array_distinct(F.array(*own, *pairs))
    return parsed.withColumn(urls, found).drop("_links", "_listed", "_boxed")


def exploded_competitors(documents: DataFrame, payload: str = "payload") -> DataFrame:
    """(event_id, competition_id, position, winner, athlete, statistics): one row per competitor
    of each bout; ``statistics`` is JSON text."""
    rows = unnest(
        exploded_bouts(documents, payload),
        ["event_id", F.col("bout.id").alias("competition_id")],
        "bout.competitors",
        "competitor",
    )
    return rows.select(
        "event_id",
        "competition_id",
        "position",
        truth(F.col("competitor.winner")).alias("winner"),
        "competitor.athlete",
        "competitor.statistics",
    )


def statistics(text: Column, box: Column | None = None) -> Column:
    """Statistics as an array of structs, from a JSON list or from the object around it."""
    if box is None:
        box = statistics_box(text)
    return F.coalesce(
        box["stats"], box["items"], F.when(~is_object(text), F.from_json(text, STATISTICS))
    )


def statistics_box(text: Column) -> Column:
    return F.when(is_object(text), F.from_json(text, STATISTICS_BOX))


def stats_map(stats: Column) -> Column:
    """Statistics as MAP: stripped name to stripped value, the last of equal names wins.

    Entries without a name are skipped; no list gives an empty map.
    """

    def name(s: Column) -> Column:
        return first_text(s["name"], s["shortDisplayName"])

    def value(s: Column) -> Column:
        return strip_text(F.coalesce(first_text(s["displayValue"], s["value"]), F.lit("")))

    pairs = F.transform(
        F.filter(stats, lambda s: name(s) != ""),
        lambda s: F.struct(strip_text(name(s)).alias("name"), value(s).alias("text")),
    )
    none = F.array().cast("array<struct<name: string, text: string>>")

    def mapped(latest_first: Column) -> Column:
        names, texts = latest_first["name"], latest_first["text"]
        distinct = F.array_distinct(F.reverse(names))
        last = F.transform(
            distinct, lambda n: F.get(texts, F.array_position(names, n).cast("int") - 1)
        )
        return F.map_from_arrays(distinct, last)

    # Through a one-element array, so that the pairs are computed once and not per name.
    return F.get(F.transform(F.array(F.reverse(F.coalesce(pairs, none))), mapped), F.lit(0))


def bout_rows(
    documents: DataFrame, refs: DataFrame | None = None, payload: str = "payload"
) -> DataFrame:
    """One row per bout with both competitors; ``event_date`` is still text. See :func:`read_bouts`."""
    return read_bouts(_bout_texts(documents, payload), refs)


def read_bouts(texts: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """One row per bout with both competitors, from the rows of :func:`opened_bouts`.

    ``refs`` (url, payload) holds the documents that pointers may lead to. Each bout first gets all
    that it can lead to; then pointers are followed within the row, level by level, since a bout's
    competitors are known only once the bout is.
    """

    def follow(df: DataFrame, **columns: str) -> DataFrame:
        if refs is None:
            return df
        return resolve_refs(df, F.col("held"), columns, text_of={"bout": "bout_text"})

    held = [] if refs is None else ["held"]
    if refs is not None:
        by = ["event_id", "bout_index", "bout_text"]
        texts = with_documents(texts, refs, "bout_text", by, bout_pointers, HOPS)
    bouts = follow(texts.withColumn("bout", F.from_json("bout_text", BOUT)), bout=BOUT)
    # A list that was declared as such is NULL where the document has a pointer to it.
    boxed = F.from_json("bout_text", struct_of(competitors=COMPETITOR_BOX))["competitors"]
    bouts = bouts.select(
        *held,
        "event_id",
        "event_date",
        "bout_index",
        F.col("bout_text").alias("raw_payload"),
        F.coalesce("bout.id", F.lit("")).alias("competition_id"),
        first_text(F.col("bout.name"), _headline(F.col("bout.notes"))).alias("bout_name"),
        F.nullif("bout.type.text", F.lit("")).alias("named_class"),
        digits_to_int(F.coalesce("bout.matchNumber", "bout.order")).alias("card_order"),
        F.coalesce("bout.weightClass", "bout.weight").alias("weight"),
        F.col("bout.status").alias("status"),
        F.col("bout.competitors").alias("competitors"),
        F.when(F.col("bout.competitors").isNull(), boxed).alias("box"),
    )
    bouts = follow(bouts, weight=NAMED, status=NAMED, box=COMPETITOR_BOX)
    pair = F.coalesce("competitors", "box.items")
    bouts = bouts.withColumns({"a": F.get(pair, F.lit(0)), "b": F.get(pair, F.lit(1))})
    bouts = follow(bouts.drop("competitors", "box"), a=COMPETITOR, b=COMPETITOR)
    for s in "ab":
        bouts = bouts.withColumns(
            {
                f"{s}_athlete": F.col(f"{s}.athlete"),
                f"{s}_box": statistics_box(F.col(f"{s}.statistics")),
            }
        )
    bouts = follow(
        bouts, a_athlete=ATHLETE, b_athlete=ATHLETE, a_box=STATISTICS_BOX, b_box=STATISTICS_BOX
    )

    def fighter(s: str) -> list[Column]:
        names = F.col(f"{s}_athlete.displayName"), F.col(f"{s}_athlete.fullName")
        stats = statistics(F.col(f"{s}.statistics"), F.col(f"{s}_box"))
        return [
            first_text(*names).alias(f"fighter_{s}_name"),
            truth(F.col(f"{s}.winner")).alias(f"fighter_{s}_winner"),
            F.to_json(stats_map(stats)).alias(f"fighter_{s}_stats"),
        ]

    return bouts.select(
        "competition_id",
        "event_id",
        "event_date",
        "bout_name",
        F.coalesce("named_class", "weight.name").alias("weight_class"),
        "card_order",
        first_text(F.col("status.type.name"), F.col("status.name")).alias("status"),
        *fighter("a"),
        *fighter("b"),
        "raw_payload",
    )
