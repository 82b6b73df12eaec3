"""Sources and sinks, upserts, watermarks, and the bronze and silver loads.

Queries that write do so in a new folder below the shared root and return what they read back.
"""

from __future__ import annotations

import uuid
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import functions as F

from checks.documents import (
    BOUT_ROWS, EVENTS, PROFILE_ROWS, event_documents, event_refs, place_refs, profile_documents,
)
from checks.gold_queries import GOLD_STYLED, STANCE_MART, STYLE_MART, Stopped, _stop_at
from checks.inputs import (
    BOUTS, GOLD, TIEBREAK, UPSERT_PAIR, VERSIONED, bouts, profiles, upsert_source, upsert_target,
    versioned, with_,
)
from checks.registry import query, table
from tierfold.operators import quality, refs, upsert, windowing
from tierfold.operators.dedupe import latest_per_key
from tierfold.plans import bronze, gold, silver
from tierfold.sources import landing, null_counts, storage, tables

KEYS = ["event_id", "competition_id"]
TEXT_DATES = """event_id, competition_id, strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date,
  strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, run_id, amount"""

# --- upserts as expressions ---------------------------------------------------------------------


def _upsert_sql(condition: str | None) -> str:
    """The target with the source applied where the condition holds, as a full join."""
    if condition is None:
        applies = "s.event_id IS NOT NULL"
    else:
        applies = f"s.event_id IS NOT NULL AND (t.event_id IS NULL OR ({condition}))"
    cells = ", ".join(
        f"CASE WHEN {applies} THEN s.{c} ELSE t.{c} END AS {c}"
        for c in ("event_id", "competition_id", "event_date", "ingestion_date", "run_id", "amount")
    )
    return f"""{with_(UPSERT_PAIR)}, merged AS (
      SELECT {cells} FROM t FULL JOIN s
        ON t.event_id = s.event_id AND t.competition_id = s.competition_id)
    SELECT {TEXT_DATES} FROM merged"""


VERSION_WINS = """t.ingestion_date < s.ingestion_date
  OR (t.ingestion_date = s.ingestion_date AND t.run_id < s.run_id)"""


def _upserted(spark, sf, when, order=()):
    return upsert.upsert(upsert_target(spark, sf), upsert_source(spark, sf), KEYS, when, order)


@query("upsert_last_writer", _upsert_sql(None))
def upsert_last_writer(spark, sf):
    return _upserted(spark, sf, upsert.ALWAYS)


@query("upsert_if_newer", _upsert_sql("t.event_date IS NULL OR s.event_date > t.event_date"))
def upsert_if_newer(spark, sf):
    return _upserted(spark, sf, upsert.NEWER, ["event_date"])


@query("upsert_by_version", _upsert_sql(VERSION_WINS))
def upsert_by_version(spark, sf):
    return _upserted(spark, sf, upsert.VERSION, ["ingestion_date", "run_id"])


@query("insert_new_keys", _upsert_sql("false"))
def insert_new_keys(spark, sf):
    return _upserted(spark, sf, upsert.NEVER)


@query(
    "changed_rows",
    f"""{with_(UPSERT_PAIR)}, changed AS (SELECT s.* FROM s LEFT JOIN t
      ON t.event_id = s.event_id AND t.competition_id = s.competition_id
      WHERE t.event_id IS NULL OR {VERSION_WINS}) SELECT {TEXT_DATES} FROM changed""",
)
def changed_rows(spark, sf):
    return upsert.changed_rows(
        upsert_source(spark, sf), upsert_target(spark, sf), KEYS, ["ingestion_date", "run_id"]
    )


# --- watermark and windows ----------------------------------------------------------------------


def _middle(df, column):
    """The day half-way through a table: where the first of two loads ends."""
    first, last = df.agg(F.min(F.to_date(column)), F.max(F.to_date(column))).first()
    return first + timedelta(days=(last - first).days // 2)


def middle_sql(source: str, column: str) -> str:
    return f"""(SELECT min(CAST({column} AS DATE))
      + CAST(floor((max(CAST({column} AS DATE)) - min(CAST({column} AS DATE))) / 2) AS INTEGER)
      FROM {source})"""


MIDDLE = middle_sql("events", "ts")


@query(
    "watermark_resolve",
    "SELECT strftime(CAST(max(ts) AS DATE), '%Y-%m-%d') AS last_event_date FROM events",
)
def watermark_resolve(spark, sf):
    """A mark saved by an earlier load, against two tables that do not reach it: it decides."""
    events, orders = table(spark, sf, "events"), table(spark, sf, "orders")
    state, middle = storage.new_folder(spark, "watermark"), F.lit(_middle(events, "ts"))
    tables.save_watermark(windowing.advance_watermark(events, "ts"), state)
    return windowing.resolve_watermark(
        (tables.load_state(spark, state), "last_event_date"),
        (events.where(F.col("ts") < middle), "ts"),
        (orders.where(F.col("o_orderdate") < middle), "o_orderdate"),
    )


@query(
    "watermark_survives",
    """SELECT 'whole' AS state, strftime(CAST(max(ts) AS DATE), '%Y-%m-%d') AS last_event_date FROM events
    UNION ALL SELECT 'cut short', strftime(CAST(max(ts) AS DATE), '%Y-%m-%d') FROM events
    UNION ALL SELECT 'next', strftime(CAST(max(o_orderdate) AS DATE), '%Y-%m-%d') FROM orders""",
)
def watermark_survives(spark, sf):
    """A mark, then a write of the next one that ends before it is complete, then a whole one."""
    events, orders = table(spark, sf, "events"), table(spark, sf, "orders")
    state, marks = storage.new_folder(spark, "watermark"), []

    def resolve(name):
        mark = windowing.resolve_watermark((tables.load_state(spark, state), "last_event_date")).first()[0]
        marks.append((name, mark))

    tables.save_watermark(windowing.advance_watermark(events, "ts"), state)
    resolve("whole")
    storage.write_text(spark, f"{state}/{tables.GENERATION}{2:012d}/part-00000.parquet", "PAR1")
    resolve("cut short")
    tables.save_watermark(windowing.advance_watermark(orders, "o_orderdate"), state)
    resolve("next")
    return spark.createDataFrame(marks, "state STRING, last_event_date DATE")


@query(
    "incremental_window",
    f"""SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    WHERE events.ts >= {MIDDLE} - 1 AND events.ts < {MIDDLE} + 8""",
)
def incremental_window(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    day = _middle(events, "ts")
    return windowing.incremental_window(events, "ts", windowing.load_bounds(day, day, 1))


def _daily(events):
    return events.select(
        "event_id", "event_type", "value", "ts", F.date_format("ts", "yyyyMMdd").alias("day")
    )


@query(
    "incremental_idempotent",
    "SELECT event_id, event_type, value, strftime(ts, '%Y%m%d') AS day FROM events",
)
def incremental_idempotent(spark, sf):
    """First load up to the middle, then the rest with an overlap of a day, the latter twice."""
    events = _daily(table(spark, sf, "events"))
    path, middle = storage.new_folder(spark, "incremental"), _middle(events, "ts")
    last = events.agg(F.max(F.to_date("ts"))).first()[0]
    first_load = events.where(F.col("ts") < F.lit(middle + timedelta(days=1)))
    rest = windowing.incremental_window(events, "ts", (middle - timedelta(days=1), last))
    for batch in (first_load, rest, rest):
        loaded = tables.merge_partitioned(spark, path, batch, ["event_id"], "day")
    return loaded.select("event_id", "event_type", "value", "day")


@query(
    "reject_null_partition",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'rejected' ELSE 'valid' END AS status
    FROM orders""",
)
def reject_null_partition(spark, sf):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    orders = table(spark, sf, "orders").select("o_orderkey", known.alias("event_date"))
    orders = orders.withColumn("event_year", F.year("event_date"))
    valid, rejected = quality.split_rejects(orders, ["event_date", "event_year"])
    marked = lambda df, status: df.select("o_orderkey", F.lit(status).alias("status"))
    return marked(valid, "valid").union(marked(rejected, "rejected"))


# --- sources, sinks, catalog --------------------------------------------------------------------

RAW_SCHEMA = (
    "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, ts TIMESTAMP_NTZ, props STRING"
)


def _raw_events(spark, sf):
    path = storage.new_folder(spark, "raw")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    landing.mirror_raw(events, path, "day", ["event_id"], ["ts"])
    return path


@query(
    "scan_raw_json",
    """SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS ingestion_date
    FROM events""",
)
def scan_raw_json(spark, sf):
    raw = landing.scan_raw_json(
        spark, _raw_events(spark, sf), f"{RAW_SCHEMA}, ingestion_date DATE", "part-*.json"
    )
    return raw.drop("ts")


@query(
    "raw_mirror_latest",
    """SELECT user_id, event_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS ingestion_date
    FROM events QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id
      ORDER BY events.ts DESC, event_id DESC) = 1""",
)
def raw_mirror_latest(spark, sf):
    path = storage.new_folder(spark, "raw")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    for _ in range(2):  # mirroring a day again replaces it
        landing.mirror_raw(events, path, "day", ["user_id"], ["ts"], ["event_id"])
    raw = landing.scan_raw_json(spark, path, f"{RAW_SCHEMA}, ingestion_date DATE")
    return raw.drop("ts")


# Runs, the events they land, and what they add to the values; the last comes late.
RUNS = [("20250101T060000Z", 0, 0), ("20250101T120000Z", 1, 0), ("20250102T000000Z", 2, 0), ("20250101T180000Z", 0, 1)]


@query(
    "mirror_landed",
    f"""WITH landed AS (SELECT e.*, run_id, value + more AS v, strptime(run_id[:8], '%Y%m%d') AS day
      FROM events e JOIN (VALUES {", ".join(map(str, RUNS))}) r(run_id, third, more)
        ON event_id % 3 = third AND (more = 0 OR event_id % 2 = 0))
    SELECT user_id, event_id, v AS value, run_id, strftime(day, '%Y-%m-%d') AS ingestion_date, true AS read_new_only
    FROM landed QUALIFY row_number() OVER (PARTITION BY day, user_id ORDER BY run_id DESC, event_id DESC) = 1""",
)
def mirror_landed(spark, sf):
    """Three runs land and are mirrored; a second call finds nothing; a late run of the first day
    lands and is mirrored without the others being read."""
    folders = [storage.new_folder(spark, name) for name in ("landing", "raw", "ledger")]
    events, k = table(spark, sf, "events").select("user_id", "event_id", "value"), F.col("event_id")

    def land(run_id, third, more):
        some = events.where((k % 3 == third) & (F.lit(more == 0) | (k % 2 == 0)))
        landing.write_landing(some.withColumn("value", F.col("value") + more), folders[0], run_id)

    def mirror():
        schema = "user_id BIGINT, event_id BIGINT, value DOUBLE"
        return landing.mirror_landing(spark, *folders, schema, ["user_id"], ["run_id"], ["event_id"])

    for run in RUNS[:3]:
        land(*run)
    first, second = mirror(), mirror()
    land(*RUNS[3])
    late = landing.landed_files(spark, folders[0]).where(F.col("run_id") == RUNS[3][0]).count()
    new_only = first > 0 and second == 0 and mirror() == late
    raw = landing.scan_raw_json(
        spark, folders[1], "user_id BIGINT, event_id BIGINT, value DOUBLE, run_id STRING, ingestion_date DATE"
    )
    return raw.withColumn("read_new_only", F.lit(new_only))


@query(
    "landing_roundtrip",
    """SELECT doc_id, md5(text) AS body, lang, run_id FROM documents,
      (VALUES ('20250101T000000Z'), ('20250102T000000Z')) r(run_id)""",
)
def landing_roundtrip(spark, sf):
    path = storage.new_folder(spark, "landing")
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    for run_id in ("20250101T000000Z", "20250102T000000Z", "20250102T000000Z"):
        landing.write_landing(documents, path, run_id)
    landed = landing.scan_raw_json(
        spark, path, "doc_id BIGINT, text STRING, lang STRING, run_id STRING"
    )
    return landed.select("doc_id", F.md5("text").alias("body"), "lang", "run_id")


#: Bytes behind the header of a parquet file that are overwritten to damage it.
DAMAGED_BYTES = 64


def _damaged(spark, path):
    """Overwrite a few bytes behind the header of the smallest file of a parquet folder, its footer
    left as it is. The rest is copied as a stream and never held."""
    fs, folder = storage._path(spark, path)
    files, found = fs.listFiles(folder, True), []
    while files.hasNext():
        status = files.next()
        if status.getPath().getName().startswith("part-"):
            found.append((status.getLen(), status.getPath().toString()))
    if not found:
        return
    size, name = min(found)
    _, file = storage._path(spark, name)
    _, copy = storage._path(spark, f"{folder.toString()}/_copy")
    stream, out = fs.open(file), fs.create(copy, True)
    stream.seek(size - 8)
    pages = size - 12 - int.from_bytes(bytes(stream.readNBytes(4)), "little")
    stream.seek(0)
    header = bytes(stream.readNBytes(4))
    junk = b"\x55" * min(DAMAGED_BYTES, pages)
    out.write(bytearray(header + junk))
    stream.seek(4 + len(junk))
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 65_536, True)
    fs.delete(file, False)
    storage.rename(spark, copy.toString(), name)


@query(
    "read_with_fallback",
    f"""{with_(EVENTS)} SELECT source, event_id, event_name, country, status, num_fights
    FROM event_rows, (VALUES ('good'), ('missing'), ('damaged')) v(source)""",
)
def read_with_fallback(spark, sf):
    """Silver events out of a good bronze table, and out of the raw documents where that table is
    missing or damaged. Every case starts from a table that would tell by its names."""
    documents, day = event_documents(spark, sf), date(2025, 1, 1)
    run = bronze.Run("20250101T000000Z", day)
    parts = []
    for source in ("good", "missing", "damaged"):
        root = bronze.Bronze(storage.new_folder(spark, "bronze"))
        if source != "missing":
            rows = bronze.valid_events(documents, run)
            if source == "damaged":
                rows = rows.withColumn("event_name", F.lit("from damaged table"))
            tables.write_partitioned(rows, root.events, bronze.PARTITION)
            if source == "damaged":
                _damaged(spark, root.events)
        found = silver.events_or_raw(spark, root, lambda: documents, run)
        loaded = silver.load_events(spark, storage.new_folder(spark, "silver"), found)
        parts.append(loaded.select(F.lit(source).alias("source"), "event_id", "event_name", "country", "status", "num_fights"))
    return reduce(lambda x, y: x.unionAll(y), parts)


@query("ids_or_fallback", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS athlete_id FROM orders")
def ids_or_fallback(spark, sf):
    handed_over = spark.createDataFrame([], "athlete_id STRING")
    return landing.ids_or_fallback(
        handed_over, lambda: refs.ids_from_payload(event_documents(spark, sf), "payload")
    )


@query("partitioned_roundtrip", f"{with_(BOUTS)} SELECT competition_id, event_year FROM bouts")
def partitioned_roundtrip(spark, sf):
    path = storage.new_folder(spark, "partitioned")
    tables.write_partitioned(bouts(spark, sf), path, "event_year")
    return spark.read.parquet(path).select("competition_id", "event_year")


@query(
    "table_partitions_profile",
    f"""{with_(BOUTS)} SELECT event_year, count(*) AS rows, true AS has_files
    FROM bouts GROUP BY 1""",
)
def table_partitions_profile(spark, sf):
    path = storage.new_folder(spark, "profiled")
    tables.write_partitioned(bouts(spark, sf), path, "event_year")
    profile = tables.partitions_profile(spark, path, "event_year")
    has_files = (F.col("files") > 0) & (F.col("bytes") > 0)
    return profile.select("event_year", "rows", has_files.alias("has_files"))


def _database(spark):
    name = f"gold_{uuid.uuid4().hex[:12]}"
    tables.create_database(spark, name, storage.new_folder(spark, name))
    return name


@query("materialize_mart", GOLD + STANCE_MART)
def materialize_mart(spark, sf):
    mart = gold.stance_by_class(bouts(spark, sf), profiles(spark, sf))
    name = f"{_database(spark)}.mv_stance_matchups"
    tables.materialize_mart(mart.where("false").withColumn("old", F.lit(1)), name)
    return tables.materialize_mart(mart, name)


@query("mart_view", GOLD_STYLED + STYLE_MART)
def mart_view(spark, sf):
    mart = gold.style_overall(bouts(spark, sf), profiles(spark, sf))
    database = _database(spark)
    tables.materialize_mart(mart, f"{database}.mv_style")
    return tables.publish_view(spark, f"{database}.v_style", f"{database}.mv_style")


@query(
    "run_log_append",
    """SELECT run_id, 'incremental' AS run_mode, (SELECT count(*) FROM events) AS events_count,
      (SELECT count(*) FROM orders) AS fights_count, 'SUCCESS' AS status
    FROM (VALUES ('20250101T000000Z'), ('20250102T000000Z')) r(run_id)""",
)
def run_log_append(spark, sf):
    path = storage.new_folder(spark, "runs")
    counts = {
        "events_count": table(spark, sf, "events").count(),
        "fights_count": table(spark, sf, "orders").count(),
    }
    for run_id in ("20250101T000000Z", "20250102T000000Z"):
        metrics = spark.range(1).select(
            F.lit(run_id).alias("run_id"),
            F.current_timestamp().alias("started_at"),
            F.current_timestamp().alias("finished_at"),
            F.lit("incremental").alias("run_mode"),
            F.lit(7).alias("years_back"),
            F.lit(1).alias("overlap_days"),
            *(F.lit(n).cast("bigint").alias(c) for c, n in counts.items()),
            F.lit(0).cast("bigint").alias("errors"),
            F.lit("SUCCESS").alias("status"),
        )
        tables.append_run_log(metrics, path)
    log = spark.read.schema(tables.RUN_LOG_SCHEMA).parquet(path)
    return log.select("run_id", "run_mode", "events_count", "fights_count", "status")


# --- bronze and silver loads --------------------------------------------------------------------

LOADED = f"""{with_(EVENTS, BOUT_ROWS)} SELECT b.* EXCLUDE (event_date),
  strftime(CASE WHEN k % 5 <> 0 THEN date_trunc('minute', d) ELSE d END, '%Y-%m-%d %H:%M:%S')
    AS event_date, CAST(year(d) AS INTEGER) AS event_year
FROM bout_rows b JOIN ev ON b.event_id = CAST(ev.k AS VARCHAR)"""
BRONZE_COLUMNS = [
    c for c in bronze._columns(bronze.BOUTS_DDL)
    if c not in ("ingestion_date", "run_id", "raw_payload")
]


def _two_loads(spark, sf, root):
    """A backfill up to the middle, then an incremental load from there on with an overlap."""
    documents, pointers = event_documents(spark, sf), event_refs(spark, sf)
    middle = _middle(documents, "day")
    last = documents.agg(F.max("day")).first()[0]
    early = documents.where(F.col("day") <= F.lit(middle))
    first = bronze.Run("20250101T000000Z", middle, "backfill")
    events, _ = bronze.load_bronze(spark, root, early, first, pointers)
    mark = bronze.current_watermark(spark, root, events).first()[0]
    rest = windowing.incremental_window(documents, "day", windowing.load_bounds(mark, last, 1))
    return bronze.load_bronze(
        spark, root, rest, bronze.Run("20250102T000000Z", last), pointers
    )


@query("bronze_load", LOADED)
def bronze_load(spark, sf):
    root = bronze.Bronze(storage.new_folder(spark, "bronze"))
    _, loaded = _two_loads(spark, sf, root)
    return loaded.select(*BRONZE_COLUMNS)


@query(
    "backfill_rebuild",
    f"""{with_(EVENTS)} SELECT event_id, event_name, venue, country, status, num_fights
    FROM event_rows""",
)
def backfill_rebuild(spark, sf):
    """A backfill over what an earlier load left gives the documents' rows and nothing else."""
    root = bronze.Bronze(storage.new_folder(spark, "bronze"))
    documents = event_documents(spark, sf)
    stale = documents.withColumn("payload", F.replace("payload", F.lit('"id":'), F.lit('"id":-')))
    last = documents.agg(F.max("day")).first()[0]
    bronze.load_rows(
        spark, root.events,
        bronze.bronze_events(stale, bronze.Run("20250101T000000Z", last)), bronze.EVENT_KEYS,
    )
    tables.reset(spark, root.events)
    rows = bronze.bronze_events(documents, bronze.Run("20250102T000000Z", last, "backfill"))
    events, _ = bronze.load_rows(spark, root.events, rows, bronze.EVENT_KEYS)
    return events.select("event_id", "event_name", "venue", "country", "status", "num_fights")


@query(
    "silver_events",
    """SELECT user_id || '-' || event_type AS event_id,
      strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_date,
      CAST(year(ts) AS INTEGER) AS event_year, event_type AS event_name, 'V' || value AS venue,
      event_type AS status
    FROM events QUALIFY row_number() OVER (
      PARTITION BY user_id, event_type ORDER BY events.ts DESC, value DESC) = 1""",
)
def silver_events(spark, sf):
    """Latest event per user and type, loaded in two parts; ``country`` is sparse and goes."""
    events = table(spark, sf, "events")
    shaped = events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("event_id"),
        F.col("ts").alias("event_date"),
        F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("event_name"),
        F.concat(F.lit(" V"), F.col("value").cast("string")).alias("venue"),
        F.when(F.col("event_id") % 1000 == 7, F.lit("CZ")).alias("country"),
        F.col("event_type").alias("status"),
        F.lit(None).cast("int").alias("num_fights"),
    )
    path, middle = storage.new_folder(spark, "silver"), F.lit(_middle(events, "ts"))
    for part in (F.col("event_date") <= middle, F.col("event_date") > middle):
        loaded = silver.load_events(spark, path, shaped.where(part), ["venue"])
    return silver.published_events(loaded)


@query(
    "silver_bouts",
    f"""{with_(VERSIONED)} SELECT competition_id, event_id,
      strftime(event_date, '%Y-%m-%d %H:%M:%S') AS event_date, event_year,
      trim(weight_class[1:4]) || ' Class' AS weight_class, card_order, status,
      trim(fighter_a_name) AS fighter_a_name, fighter_a_winner,
      trim(fighter_b_name) AS fighter_b_name, fighter_b_winner,
      strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, run_id
    FROM versioned QUALIFY row_number() OVER (PARTITION BY event_id, competition_id
      ORDER BY versioned.ingestion_date DESC, run_id DESC,
      {", ".join(f"versioned.{c} DESC" for c in TIEBREAK)}) = 1""",
)
def silver_bouts(spark, sf):
    """Versions loaded in two parts; a later version may move a bout to another year."""
    rows = versioned(spark, sf)
    path, middle = storage.new_folder(spark, "silver"), F.lit(_middle(rows, "event_date"))
    for part in (F.col("event_date") <= middle, F.col("event_date") > middle):
        loaded = silver.load_bouts(spark, path, rows.where(part), TIEBREAK)
    return loaded


@query(
    "silver_profiles",
    """SELECT CAST(o_custkey AS VARCHAR) AS athlete_id, 'Customer ' || o_custkey AS full_name,
      o_orderpriority AS display_name, strftime(o_orderdate, '%Y-%m-%d') AS birth_date,
      o_orderstatus AS country, CAST(o_orderkey % 50 AS INTEGER) AS height_cm,
      strftime(o_orderdate, '%Y-%m-%d') AS ingestion_date,
      lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS run_id
    FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
      ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def silver_profiles(spark, sf):
    """Each order is a newer version of its customer's profile; empty columns go."""
    orders, none = table(spark, sf, "orders"), F.lit(None).cast("string")
    day = F.to_date("o_orderdate")
    rows = orders.select(
        F.col("o_custkey").cast("string").alias("athlete_id"),
        F.concat(F.lit(" Customer "), F.col("o_custkey").cast("string")).alias("full_name"),
        F.concat("o_orderpriority", F.lit("  ")).alias("display_name"),
        day.alias("birth_date"),
        F.col("o_orderstatus").alias("country"),
        none.alias("height"),
        (F.col("o_orderkey") % 50).cast("int").alias("height_cm"),
        none.cast("int").alias("reach_cm"),
        *(none.alias(c) for c in ("stance", "weight_class", "team", "combat_style", "image_url")),
        day.alias("ingestion_date"),
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("run_id"),
    )
    path, middle = storage.new_folder(spark, "silver"), F.lit(_middle(rows, "ingestion_date"))
    for part in (F.col("ingestion_date") <= middle, F.col("ingestion_date") > middle):
        loaded = silver.load_profiles(spark, path, rows.where(part))
    return silver.published_profiles(loaded)


@query(
    "silver_events_columns_appear",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS event_name,
      CASE WHEN event_id % 3 = 1 OR event_id % 300 = 2 THEN 'V' || value END AS venue,
      CASE WHEN event_id % 300 = 2 THEN 'CZ' END AS country
    FROM events""",
)
def silver_events_columns_appear(spark, sf):
    """A venue that is empty in the first load, full in the second and rare in the third, and a
    country of which the third load has the first values: none of them is lost."""
    events, k = table(spark, sf, "events"), F.col("event_id")
    rare = k % 300 == 2
    shaped = events.select(
        k.cast("string").alias("event_id"),
        F.col("ts").alias("event_date"),
        F.col("event_type").alias("event_name"),
        F.when((k % 3 == 1) | rare, F.concat(F.lit("V"), F.col("value").cast("string"))).alias("venue"),
        F.when(rare, F.lit("CZ")).alias("country"),
        (k % 3).alias("load"),
    )
    path = storage.new_folder(spark, "silver")
    for load in range(3):
        loaded = silver.load_events(spark, path, shaped.where(F.col("load") == load).drop("load"))
    return loaded.select("event_id", "event_name", "venue", "country")


@query(
    "null_counts_kept",
    """WITH t AS (SELECT o_orderkey % 4 = 0 AS moved, o_orderkey % 3 <> 0 AS has_venue, o_orderkey % 200 = 4 AS has_country
      FROM orders WHERE o_orderkey % 5 <> 4 OR o_orderkey % 4 = 0)
    SELECT "column", (SELECT count(*) FROM t) AS rows, nulls, false AS counted_again, true AS country_left_out
    FROM (SELECT 'venue' AS "column", count(*) FILTER (NOT has_venue) AS nulls FROM t
      UNION ALL SELECT 'country', count(*) FILTER (NOT has_country) FROM t
      UNION ALL SELECT 'status', 0)""",
)
def null_counts_kept(spark, sf):
    """Counts after first rows and after a load that brings new ones and moves others to another year,
    which empties a year; asking for them and publishing then counts nothing."""
    orders, k = table(spark, sf, "orders"), F.col("o_orderkey")
    day = lambda year: F.make_timestamp(year, *(F.lit(1),) * 2, *(F.lit(0),) * 2, F.lit(0).cast("decimal(8,6)"))

    def rows(where, year):
        return orders.where(where).select(
            k.cast("string").alias("event_id"), day(year).alias("event_date"),
            F.lit("e").alias("event_name"), F.when(k % 3 != 0, "v").alias("venue"),
            F.when(k % 200 == 4, "c").alias("country"), F.lit("s").alias("status"), F.lit(None).cast("int").alias("num_fights"),
        )

    path = storage.new_folder(spark, "silver")
    silver.load_events(spark, path, rows(k % 5 != 4, F.when(k % 4 == 0, 2000).otherwise(2001 + (k % 3).cast("int"))))
    loaded = silver.load_events(spark, path, rows(k % 4 == 0, F.lit(2010)))
    again = bool(null_counts.renew(spark, path, loaded, "event_year"))
    left_out = "country" not in silver.publish_events(spark, path, loaded).columns
    counts = null_counts.null_counts(spark, path, loaded, "event_year")
    return counts.where(F.col("column").isin("venue", "country", "status")).select(
        "column", "rows", "nulls", F.lit(again).alias("counted_again"), F.lit(left_out).alias("country_left_out")
    )


STRING_PARTITIONS = ["007", "7", "a b/c:1", "a=b%", "x"]


@query(
    "merge_string_partitions",
    f"""SELECT c_custkey, CASE WHEN p = 'a b/c:1' OR c_custkey % 50 = 3 THEN '07' ELSE p END AS p,
      CASE WHEN p = 'a b/c:1' OR c_custkey % 50 = 3 THEN 'moved' ELSE c_name END AS name
    FROM (SELECT *, {STRING_PARTITIONS}[c_custkey % 5 + 1] AS p FROM customer)""",
)
def merge_string_partitions(spark, sf):
    """Partitions whose names look like numbers or need escaping; rows move out of each of them,
    and all of one."""
    k = F.col("c_custkey")
    names = F.array(*(F.lit(v) for v in STRING_PARTITIONS))
    rows = table(spark, sf, "customer").select(
        k, F.get(names, (k % 5).cast("int")).alias("p"), F.col("c_name").alias("name")
    )
    path = storage.new_folder(spark, "strings")
    tables.merge_partitioned(spark, path, rows, ["c_custkey"], "p")
    moved = rows.where((F.col("p") == "a b/c:1") | (k % 50 == 3))
    moved = moved.withColumns({"p": F.lit("07"), "name": F.lit("moved")})
    return tables.merge_partitioned(spark, path, moved, ["c_custkey"], "p")


#: Steps at which merges are stopped; before the third of them the table has not changed.
STOPS = [("write", 1), ("plan", 1), ("move", 2), ("clean", 1), ("forget", 1)]


@query(
    "merge_recovers",
    f"""SELECT stop, seen, c_custkey,
      CASE WHEN c_custkey % 7 > last THEN 'p' || c_custkey % 7 WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'b' END AS p,
      CASE WHEN c_custkey % 7 > last THEN c_name ELSE 'batch ' || c_custkey % 7 END AS name
    FROM customer, (
      SELECT stop, seen, CASE WHEN seen = 'stopped' AND stop < 2 THEN stop - 1 ELSE stop END AS last
      FROM (SELECT CAST(unnest(range({len(STOPS)})) AS INTEGER) AS stop), (VALUES ('stopped'), ('again')) v(seen))""",
)
def merge_recovers(spark, sf):
    """Batches that empty a partition into two others each. Their merges are stopped at one step
    after the other, the table is read, and the batch is merged again."""
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        k, F.concat(F.lit("p"), (k % 7).cast("string")).alias("p"), F.col("c_name").alias("name")
    )
    path, states = storage.new_folder(spark, "journal"), []
    tables.merge_partitioned(spark, path, rows, ["c_custkey"], "p")

    def keep(state, stop, seen):
        copy = storage.new_folder(spark, "journal-state")
        state.write.parquet(copy)
        states.append(spark.read.parquet(copy).select(F.lit(stop).alias("stop"), F.lit(seen).alias("seen"), "c_custkey", "p", "name"))

    for stop, (step, time) in enumerate(STOPS):
        batch = rows.where(k % 7 == stop).withColumns(
            {"p": F.when(k % 2 == 0, "a").otherwise("b"), "name": F.lit(f"batch {stop}")}
        )
        try:
            tables.merge_partitioned(spark, path, batch, ["c_custkey"], "p", step=_stop_at(step, time))
        except Stopped:
            keep(tables.stored(spark, path, rows, "p"), stop, "stopped")
        keep(tables.merge_partitioned(spark, path, batch, ["c_custkey"], "p"), stop, "again")
    return reduce(lambda x, y: x.unionAll(y), states)


def _profile_versions(spark, sf, *versions):
    """(athlete_id, loaded_at, payload) of customers whose names carry a version."""
    k, name = F.col("c_custkey"), F.col("c_name")
    customers = table(spark, sf, "customer")
    parts = [
        customers.where(where).select(
            k.alias("athlete_id"),
            F.lit(version).alias("loaded_at"),
            payload(F.concat(name, F.lit(f" v{version}"))).alias("payload"),
        )
        for version, where, payload in versions
    ]
    return reduce(lambda x, y: x.unionAll(y), parts)


def _named(name):
    return F.to_json(F.struct(name.alias("fullName"), F.struct(F.lit(1e12).alias("centimeters")).alias("height")))


def _failed(name):
    return F.to_json(F.struct(F.lit("timed out").alias("error")))


def _cut(name):
    return F.concat(F.lit('{"fullName": "'), name)


def _two_profile_loads(spark, sf, root):
    """Two versions at once, in either order of their names; then a third for some, failed and
    unreadable documents for others, and failed ones for athletes that nobody knows."""
    k = F.col("c_custkey")
    first = _profile_versions(spark, sf, (2, k % 7 != 6, _named), (1, k % 7 != 6, _named))
    second = _profile_versions(spark, sf, (3, k % 4 == 0, _named), (4, k % 4 == 1, _failed), (5, k % 4 == 2, _cut))
    for run_id, documents in (("20250101T000000Z", first), ("20250102T000000Z", second)):
        run = bronze.Run(run_id, date(2025, 1, 1))
        loaded = bronze.load_profiles(spark, root, documents, run, order=["loaded_at"])
    return loaded


@query(
    "bronze_profiles",
    """SELECT CAST(c_custkey AS VARCHAR) AS athlete_id, CASE WHEN c_custkey % 4 = 0 THEN c_name || ' v3'
      WHEN c_custkey % 7 <> 6 THEN c_name || ' v2' END AS full_name, CAST(NULL AS INTEGER) AS height_cm
    FROM customer WHERE c_custkey % 7 <> 6 OR c_custkey % 4 < 2""",
)
def bronze_profiles(spark, sf):
    loaded = _two_profile_loads(spark, sf, bronze.Bronze(storage.new_folder(spark, "bronze")))
    return loaded.select("athlete_id", "full_name", "height_cm")


@query(
    "rejected_rows",
    f"""{with_(EVENTS, BOUT_ROWS)} SELECT 'events' AS source, event_name AS name, NULL AS reason
      FROM event_rows WHERE CAST(event_id AS BIGINT) % 7 = 0
    UNION ALL SELECT 'bouts', bout_name, NULL FROM bout_rows WHERE CAST(event_id AS BIGINT) % 7 = 0
    UNION ALL SELECT 'profiles', CAST(c_custkey AS VARCHAR),
      CASE WHEN c_custkey % 4 = 1 THEN 'failed' ELSE 'unreadable' END
      FROM customer WHERE c_custkey % 4 IN (1, 2)""",
)
def rejected_rows(spark, sf):
    """What the gates hold back is stored, by run. A run that is loaded again without its faults keeps
    none of them."""
    root = bronze.Bronze(storage.new_folder(spark, "bronze"))
    k, payload = F.col("event_id"), F.col("payload")
    nameless = F.replace(payload, F.lit('"id":'), F.lit('"no_id":'))
    documents = event_documents(spark, sf)
    faulty = documents.withColumn("payload", F.when(k % 7 == 0, nameless).otherwise(payload))
    for run_id, loaded in (("20250101T000000Z", faulty), ("20250102T000000Z", faulty), ("20250102T000000Z", documents)):
        bronze.load_bronze(spark, root, loaded, bronze.Run(run_id, date(2025, 1, 1)))
    _two_profile_loads(spark, sf, root)
    none = F.lit(None).cast("string")
    held = [
        ("events", F.col("event_name"), none), ("bouts", F.col("bout_name"), none),
        ("profiles", F.col("athlete_id"), F.col("reason")),
    ]
    parts = [
        spark.read.parquet(root.rejects(source)).select(
            F.lit(source).alias("source"), name.alias("name"), reason.alias("reason")
        )
        for source, name, reason in held
    ]
    return reduce(lambda x, y: x.unionAll(y), parts)


@query(
    "documents_to_gold",
    f"""{with_(EVENTS, BOUT_ROWS, PROFILE_ROWS)}, known AS (
      SELECT replace(lower(p.stance), ' ', '_') AS stance, b.fighter_a_winner AS won,
             b.fighter_b_winner AS lost
      FROM bout_rows b JOIN profile_rows p ON lower(b.fighter_a_name) = lower(p.full_name))
    SELECT stance, NULL AS opp_stance, count(*) AS fights, count(*) FILTER (won) AS wins FROM known
      GROUP BY 1
    UNION ALL SELECT NULL, stance, count(*), count(*) FILTER (lost) FROM known GROUP BY 2""",
)
def documents_to_gold(spark, sf):
    """The whole chain: documents, bronze, silver, and a mart over both."""
    root = bronze.Bronze(storage.new_folder(spark, "bronze"))
    run = bronze.Run("20250101T000000Z", date(2025, 1, 1))
    _, bouts_ = bronze.load_bronze(spark, root, event_documents(spark, sf), run, event_refs(spark, sf))
    people = bronze.load_profiles(spark, root, profile_documents(spark, sf), run, place_refs(spark, sf))
    bouts_ = silver.load_bouts(spark, storage.new_folder(spark, "silver"), bouts_)
    people = silver.load_profiles(spark, storage.new_folder(spark, "silver"), people)
    return gold.stance_overall(bouts_, people).drop("win_rate")
