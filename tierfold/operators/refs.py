"""Pointers between documents and the ids inside them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierfold.operators.unnest import unnest

REF = "$ref"
ATHLETE_ID = r"/athletes/(\d+)"


def _payloads(documents: DataFrame) -> DataFrame:
    """(url, payload): each url once, with the last of its payloads in text order."""
    return documents.groupBy("url").agg(F.max("payload").alias("payload"))


def with_documents(
    rows: DataFrame,
    documents: DataFrame,
    text: str,
    by: Sequence[str],
    pointers: Callable[[DataFrame, str, str], DataFrame],
    hops: int,
    held: str = "held",
) -> DataFrame:
    """``rows`` with a map ``held`` of the (url, payload) documents that the pointers in the JSON
    text ``text`` lead to, directly or by way of other documents, NULL where there are none.

    ``pointers`` adds a list of the urls in a text column that may be followed, under the name given;
    ``hops`` is how many of them are followed one after the other. The rows are shuffled once, by a hash of ``by``, which spreads them whatever they point
    to; the urls meet the documents without the rows. Rows of equal hash hold each other's documents.
    """

    def listed(df: DataFrame, text: str, of: Column, url: str) -> DataFrame:
        return unnest(pointers(df, text, "_urls"), [of], "_urls", url).where(F.col(url) != "").drop("position")

    found = _payloads(documents)
    links = listed(found, "payload", F.col("url").alias("_from"), "_to")
    steps = [found.select("url", F.col("url").alias("to"))]
    for _ in range(hops - 1):
        further = steps[-1].join(links, F.col("to") == F.col("_from"))
        steps.append(further.select("url", F.col("_to").alias("to")).distinct())
    reached = reduce(DataFrame.unionAll, steps).distinct().withColumnRenamed("url", "_url")
    reached = reached.join(found, F.col("to") == F.col("url")).select("_url", "to", "payload")
    key = F.xxhash64(*by)
    asked = listed(rows, text, key.alias("_asking"), "_asked")
    lists = asked.join(reached, F.col("_asked") == F.col("_url")).groupBy("_asking").agg(
        F.map_from_entries(F.collect_set(F.struct("to", "payload"))).alias(held)
    )
    keyed = rows.withColumn("_key", key)
    return keyed.join(lists, F.col("_key") == F.col("_asking"), "left").drop("_key", "_asking")


def resolve_refs(
    df: DataFrame,
    documents: DataFrame | Column,
    columns: Mapping[str, str],
    spread_by: Sequence[str] = (),
    text_of: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace objects that are pointers by the (url, payload) documents they point to.

    ``columns`` maps STRUCT columns, which have a field ``$ref``, to their type text; a document is
    parsed to the same type. A url that ``documents`` holds more than once counts once, with the
    last of its payloads in text order, so that it multiplies no rows. A pointer without a document
    becomes an object without values; objects that are no pointers stay. ``text_of`` names the
    columns that hold an object's JSON text and are to follow the pointer too.

    ``documents`` may be a map that each row holds, see :func:`with_documents`; no row moves then.
    Otherwise rows without a pointer get a join key of their own from ``spread_by`` instead of NULL,
    or they would all meet in one shuffle partition.
    """
    for c, kind in columns.items():
        url = F.nullif(F.col(c)[REF], F.lit(""))
        if isinstance(documents, DataFrame):
            found = _payloads(documents).select(F.col("url").alias("_url"), F.col("payload").alias("_payload"))
            spread = F.concat(F.lit("inline "), F.xxhash64(*spread_by).cast("string"))
            df = df.withColumn("_key", F.coalesce(url, spread)).join(found, F.col("_key") == F.col("_url"), "left")
        else:
            df = df.withColumn("_payload", F.when(url.isNotNull(), F.try_element_at(documents, url)))
        payload = F.coalesce("_payload", F.lit("{}"))
        followed = {c: F.when(url.isNotNull(), F.from_json(payload, kind)).otherwise(F.col(c))}
        if text_of and c in text_of:
            text = text_of[c]
            followed[text] = F.when(url.isNotNull(), payload).otherwise(F.col(text))
        df = df.withColumns(followed).drop("_key", "_url", "_payload")
    return df


def ids_from_refs(events: DataFrame, pattern: str = ATHLETE_ID) -> DataFrame:
    """Distinct athlete ids in the competitors' pointers of parsed event documents."""
    bouts = unnest(events, [], "competitions", "comp")
    competitors = unnest(bouts, [], "comp.competitors", "cmp")
    found = F.regexp_extract(F.col("cmp.athlete.`$ref`"), pattern, 1)
    return competitors.select(found.alias("athlete_id")).where("athlete_id != ''").distinct()


def ids_from_payload(df: DataFrame, payload: str, pattern: str = ATHLETE_ID) -> DataFrame:
    """Distinct ids found anywhere in the text of raw documents."""
    found = F.regexp_extract_all(F.col(payload), F.lit(pattern), F.lit(1))
    return unnest(df, [], F.array_distinct(found), "athlete_id").select("athlete_id").distinct()
