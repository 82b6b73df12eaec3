"""Silver tables: cleaned, deduplicated, merged incrementally.

A table stores every optional column. Which of them are too sparse to be published is decided on
the whole table, when it is read for that, and never on a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierfold.operators.dedupe import latest_per_key, version_columns
from tierfold.operators.quality import SPARSE_THRESHOLD, prune_sparse
from tierfold.operators.upsert import NEVER, NEWER, VERSION
from tierfold.plans import bronze as bronze_plan
from tierfold.sources import landing, null_counts, tables

# Optional columns of silver tables, and the columns that are trimmed.
OPTIONAL_EVENT_COLUMNS = ["venue", "country", "status", "num_fights"]
OPTIONAL_PROFILE_COLUMNS = [
    "country", "height", "height_cm", "reach_cm", "stance", "weight_class",
    "team", "combat_style", "image_url",
]
PROFILE_TEXTS = [
    "full_name", "display_name", "country", "stance", "weight_class", "team", "combat_style",
]


def _trimmed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in columns if c in df.columns})


def _or_null(df: DataFrame, columns: Sequence[str], ddl: str) -> list[Column]:
    kinds = dict(column.split() for column in ddl.split(", "))
    return [
        (F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns
    ]


def published(table: DataFrame, optional: Sequence[str]) -> DataFrame:
    """A silver table without the optional columns that are almost always NULL in all of it."""
    return prune_sparse(table, [c for c in table.columns if c not in optional])


def published_events(table: DataFrame) -> DataFrame:
    return published(table, OPTIONAL_EVENT_COLUMNS)


def published_profiles(table: DataFrame) -> DataFrame:
    return published(table, OPTIONAL_PROFILE_COLUMNS)


def publish_events(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored silver events as :func:`published_events` gives them, chosen by the counts that are
    kept beside the table."""
    counts = null_counts.null_counts(spark, path, like, "event_year").collect()  # one row a column
    sparse = [r.column for r in counts if r.rows and r.nulls / r.rows >= SPARSE_THRESHOLD]
    table = tables.stored(spark, path, like, "event_year")
    return table.drop(*(c for c in sparse if c in OPTIONAL_EVENT_COLUMNS))


def events_or_raw(
    spark: SparkSession, bronze: bronze_plan.Bronze, raw: Callable[[], DataFrame], run: bronze_plan.Run
) -> DataFrame:
    """Bronze events, or the same rows from the raw documents if the table cannot be read.

    ``raw`` gives the documents, with column ``payload``.
    """
    like = bronze_plan.empty(spark, bronze_plan.EVENTS_DDL)
    return landing.read_or_rebuild(
        lambda: tables.stored(spark, bronze.events, like, bronze_plan.PARTITION),
        lambda: bronze_plan.valid_events(raw(), run),
    )


def bouts_or_raw(
    spark: SparkSession,
    bronze: bronze_plan.Bronze,
    raw: Callable[[], DataFrame],
    run: bronze_plan.Run,
    refs: DataFrame | None = None,
) -> DataFrame:
    """Bronze bouts, or the same rows from the raw documents if the table cannot be read."""
    like = bronze_plan.empty(spark, bronze_plan.BOUTS_DDL)
    return landing.read_or_rebuild(
        lambda: tables.stored(spark, bronze.bouts, like, bronze_plan.PARTITION),
        lambda: bronze_plan.valid_bouts(raw(), run, refs),
    )


def clean_events(events: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row per event by event date; optional columns that are missing are NULL."""
    cleaned = latest_per_key(
        _trimmed(events, ["event_name", "venue", "country"]), ["event_id"], ["event_date"], tiebreak
    )
    return cleaned.select(
        "event_id",
        "event_date",
        F.year("event_date").alias("event_year"),
        "event_name",
        *_or_null(cleaned, OPTIONAL_EVENT_COLUMNS, bronze_plan.EVENTS_DDL),
    )


def clean_bouts(bouts: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row per bout by load version, with tidy names and weight classes."""
    tidy = bouts.withColumns(
        {
            "weight_class": F.initcap(F.trim("weight_class")),
            "card_order": F.col("card_order").cast("int"),
            "fighter_a_name": F.trim("fighter_a_name"),
            "fighter_b_name": F.trim("fighter_b_name"),
        }
    )
    versions = version_columns(bouts)
    provenance = [c for c in versions if c != "event_date"]
    latest = latest_per_key(tidy, ["event_id", "competition_id"], versions, tiebreak)
    return latest.select(
        "competition_id",
        "event_id",
        "event_date",
        F.year("event_date").alias("event_year"),
        "weight_class",
        "card_order",
        "status",
        "fighter_a_name",
        "fighter_a_winner",
        "fighter_b_name",
        "fighter_b_winner",
        *provenance,
    )


def clean_profiles(profiles: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest row per athlete by load version; optional columns that are missing are NULL."""
    cleaned = latest_per_key(
        _trimmed(profiles, PROFILE_TEXTS), ["athlete_id"], ["ingestion_date", "run_id"], tiebreak
    )
    return cleaned.select(
        "athlete_id",
        "full_name",
        "display_name",
        "birth_date",
        *_or_null(cleaned, OPTIONAL_PROFILE_COLUMNS, bronze_plan.PROFILES_DDL),
        "ingestion_date",
        "run_id",
    )


def load_events(
    spark: SparkSession, path: str, events: DataFrame, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """First load or merge; a stored event changes only for a later event date."""
    loaded = tables.merge_partitioned(
        spark, path, clean_events(events, tiebreak), ["event_id"], "event_year", NEWER,
        ["event_date"],
    )
    null_counts.renew(spark, path, loaded, "event_year")
    return loaded


def load_bouts(
    spark: SparkSession, path: str, bouts: DataFrame, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """First load or merge by load version; without versions only new bouts are added."""
    cleaned = clean_bouts(bouts, tiebreak)
    order = ["ingestion_date", "run_id"]
    versioned = set(order) <= set(cleaned.columns)
    return tables.merge_partitioned(
        spark, path, cleaned, ["event_id", "competition_id"], "event_year",
        VERSION if versioned else NEVER, order if versioned else [],
    )


def load_profiles(
    spark: SparkSession, path: str, profiles: DataFrame, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """First load or merge by load version."""
    return tables.merge_table(
        spark, path, clean_profiles(profiles, tiebreak), ["athlete_id"], VERSION,
        ["ingestion_date", "run_id"],
    )
