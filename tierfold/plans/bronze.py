"""Bronze load: typed, gated and merged rows from raw documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tierfold.functions.dates import parse_iso_ts
from tierfold.operators.dedupe import latest_per_key
from tierfold.operators.quality import all_present, reject_counts, split_rejects
from tierfold.operators.upsert import NEVER
from tierfold.operators.windowing import advance_watermark, resolve_watermark
from tierfold.plans.event_documents import BOUT_PARTS, bout_rows, event_rows, opened_bouts, read_bouts
from tierfold.plans.profile_documents import profile_rows, unreadable
from tierfold.sources import storage, tables

# Keys, partition column and columns of the bronze tables.
EVENT_KEYS = ["event_id"]
BOUT_KEYS = ["event_id", "competition_id"]
PROFILE_KEYS = ["athlete_id"]
PARTITION = "event_year"

EVENTS_DDL = (
    "event_id STRING, event_date TIMESTAMP, event_year INT, event_name STRING, venue STRING, "
    "country STRING, status STRING, num_fights INT, ingestion_date DATE, run_id STRING, "
    "raw_payload STRING"
)
BOUTS_DDL = (
    "competition_id STRING, event_id STRING, event_date TIMESTAMP, event_year INT, "
    "bout_name STRING, weight_class STRING, card_order INT, status STRING, "
    "fighter_a_name STRING, fighter_a_winner BOOLEAN, fighter_a_stats STRING, "
    "fighter_b_name STRING, fighter_b_winner BOOLEAN, fighter_b_stats STRING, "
    "ingestion_date DATE, run_id STRING, raw_payload STRING"
)
PROFILES_DDL = (
    "athlete_id STRING, full_name STRING, display_name STRING, birth_date DATE, country STRING, "
    "height STRING, height_cm INT, reach_cm INT, stance STRING, weight_class STRING, "
    "team STRING, combat_style STRING, image_url STRING, ingestion_date DATE, run_id STRING, "
    "raw_payload STRING"
)


def _columns(ddl: str) -> list[str]:
    return [c.strip().split(" ")[0] for c in ddl.split(",")]


@dataclass(frozen=True)
class Run:
    """Identity of one load; ``run_id`` sorts by time."""

    run_id: str
    day: date
    mode: str = "incremental"
    years_back: int = 7
    overlap_days: int = 1

    @classmethod
    def now(cls, **settings) -> Run:
        at = datetime.now(timezone.utc)
        return cls(at.strftime("%Y%m%dT%H%M%SZ"), at.date(), **settings)


def stamped(rows: DataFrame, run: Run) -> DataFrame:
    """Add the load day and run."""
    return rows.withColumns({"ingestion_date": F.lit(run.day), "run_id": F.lit(run.run_id)})


def _typed(rows: DataFrame, run: Run, ddl: str, more: Sequence[str] = ()) -> DataFrame:
    dated = rows.withColumn("event_date", parse_iso_ts(F.col("event_date")))
    dated = dated.withColumn("event_year", F.year("event_date"))
    for key in BOUT_KEYS:
        if key in dated.columns:
            dated = dated.withColumn(key, F.nullif(F.col(key), F.lit("")))
    return stamped(dated, run).select(*_columns(ddl), *more)


def bronze_events(documents: DataFrame, run: Run, parts: Sequence[str] = ()) -> DataFrame:
    return _typed(event_rows(documents, parts=parts), run, EVENTS_DDL, parts)


def bronze_bouts(documents: DataFrame, run: Run, refs: DataFrame | None = None) -> DataFrame:
    return _typed(bout_rows(documents, refs), run, BOUTS_DDL)


def bronze_profiles(documents: DataFrame, run: Run, refs: DataFrame | None = None) -> DataFrame:
    return stamped(profile_rows(documents, refs), run).select(*_columns(PROFILES_DDL))


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def _gated(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """The rows that the gate lets through, for rows that are parsed on the way.

    The gate filters on a generated column, which stays where it is. Catalyst would push a filter on
    the required columns below the documents' shuffle, with a parse for every mention of a field.
    """
    passed = rows.select("*", F.explode(F.array(all_present(required))).alias("_passed"))
    return passed.where("_passed").drop("_passed")


def valid_events(documents: DataFrame, run: Run) -> DataFrame:
    """The rows that the gate lets through."""
    return _gated(bronze_events(documents, run), [*EVENT_KEYS, "event_date", PARTITION])


def valid_bouts(documents: DataFrame, run: Run, refs: DataFrame | None = None) -> DataFrame:
    return _gated(bronze_bouts(documents, run, refs), [*BOUT_KEYS, "event_date", PARTITION])


@dataclass(frozen=True)
class Bronze:
    """Locations of the bronze tables below one root."""

    root: str

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    @property
    def bouts(self) -> str:
        return f"{self.root}/bouts"

    @property
    def profiles(self) -> str:
        return f"{self.root}/profiles"

    @property
    def watermark(self) -> str:
        return f"{self.root}/watermark"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def rejects(self, table: str) -> str:
        """Rows of a table's documents that its gate held back, by run."""
        return f"{self.root}/rejects/{table}"


def _tiebreak() -> list[Column]:
    """Settles equal dates by a short value instead of by whole documents."""
    return [F.xxhash64("raw_payload")]


def store_rejects(spark: SparkSession, path: str, rejected: DataFrame, run: Run, count: int) -> None:
    """Make these the rejects of the run."""
    if count or storage.exists(spark, path):
        tables.replace_partitions(spark, path, rejected, "run_id", [run.run_id])


def load_rows(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    keys: list[str],
    rejects: str | None = None,
    run: Run | None = None,
) -> tuple[DataFrame, Row]:
    """Gate, deduplicate and merge typed rows; returns the table and the counts of valid and
    rejected rows. The documents are parsed once, into a staged copy. Rejected rows of ``run`` are
    stored below ``rejects``; running a load again replaces its own, by none if it has none now."""
    with storage.staged(rows, "typed") as typed:
        return load_stored(spark, path, typed, keys, rejects, run)


def load_stored(
    spark: SparkSession,
    path: str,
    typed: DataFrame,
    keys: list[str],
    rejects: str | None = None,
    run: Run | None = None,
) -> tuple[DataFrame, Row]:
    """:func:`load_rows` for typed rows that are stored, so that reading them again costs little."""
    required = [*keys, "event_date", PARTITION]
    counts = reject_counts(typed, required).first()
    valid, rejected = split_rejects(typed, required)
    if rejects:
        store_rejects(spark, rejects, rejected, run, counts["rejected"])
    with tables.latest_stored(valid, keys, ["event_date"], _tiebreak()) as batch:
        table = tables.merge_partitioned(spark, path, batch, keys, PARTITION, prepared=True)
    return table, counts


def load_bronze(
    spark: SparkSession,
    bronze: Bronze,
    documents: DataFrame,
    run: Run,
    refs: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One load of event documents: both tables, the watermark and the run log.

    A backfill first forgets what is there. Returns (events, bouts). The documents are read and opened
    once, into staged event rows that hold the texts of their bouts. The log row counts the merged
    rows, and as errors the rejected ones; a load that fails is logged as such.
    """
    started, counts, status = datetime.now(timezone.utc), (0, 0, 0), "FAILED"
    if run.mode == "backfill":
        tables.reset(spark, bronze.events, bronze.bouts, bronze.watermark)
    try:
        with storage.staged(bronze_events(documents, run, BOUT_PARTS), "opened") as opened:
            events, e = load_stored(
                spark, bronze.events, opened.drop(*BOUT_PARTS), EVENT_KEYS, bronze.rejects("events"), run
            )
            rows = _typed(read_bouts(opened_bouts(opened), refs), run, BOUTS_DDL)
            bouts, b = load_rows(spark, bronze.bouts, rows, BOUT_KEYS, bronze.rejects("bouts"), run)
        loaded = events.where(F.col("run_id") == run.run_id)
        tables.save_watermark(advance_watermark(loaded, "event_date"), bronze.watermark)
        counts, status = (e.valid, b.valid, e.rejected + b.rejected), "SUCCESS"
    finally:
        row = (run.run_id, started, datetime.now(timezone.utc), run.mode, run.years_back,
               run.overlap_days, *counts, status)
        tables.append_run_log(spark.createDataFrame([row], tables.RUN_LOG_SCHEMA), bronze.runs)
    return events, bouts


# Columns of stored profile rejects.
PROFILE_REJECTS_DDL = "athlete_id STRING, reason STRING, raw_payload STRING, ingestion_date DATE, run_id STRING"


def load_profiles(
    spark: SparkSession,
    bronze: Bronze,
    documents: DataFrame,
    run: Run,
    refs: DataFrame | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """One load of profile documents, the last payload per athlete winning.

    ``order`` names the columns of ``documents`` that tell which payload came later; payloads that
    came together are settled by their hash. A failed document (one with ``error``) gives a row to
    an athlete who has none, but replaces no profile. Failed documents, and those that are no JSON
    object or have no athlete, are stored as rejects with a reason.
    """
    required = F.nullif(F.col("athlete_id").cast("string"), F.lit("")).isNotNull()
    broken = documents.where(unreadable(F.col("payload")) | ~required)
    rows = stamped(profile_rows(documents.where(required), refs, carry=order), run)
    with storage.staged(rows, "profiles") as typed:
        reason = F.when(~required, F.lit("no id")).otherwise(F.lit("unreadable"))
        rejected = stamped(
            broken.select(F.col("athlete_id").cast("string").alias("athlete_id"), reason.alias("reason"), F.col("payload").alias("raw_payload")),
            run,
        ).unionByName(typed.where("failed").withColumn("reason", F.lit("failed")).select(*_columns(PROFILE_REJECTS_DDL)))
        with storage.staged(rejected, "rejected") as held:
            store_rejects(spark, bronze.rejects("profiles"), held, run, held.count())
        latest = latest_per_key(typed, PROFILE_KEYS, [~F.col("failed"), *order], _tiebreak())
        good, failed = (latest.where(c).select(*_columns(PROFILES_DDL)) for c in ("NOT failed", "failed"))
        tables.merge_table(spark, bronze.profiles, good, PROFILE_KEYS)
        return tables.merge_table(spark, bronze.profiles, failed, PROFILE_KEYS, NEVER)


def current_watermark(spark: SparkSession, bronze: Bronze, *tables_read: DataFrame) -> DataFrame:
    """Latest date known to the state table or to any of the given event tables."""
    state = tables.load_state(spark, bronze.watermark)
    return resolve_watermark(
        (state, "last_event_date"), *((t, "event_date") for t in tables_read)
    )
