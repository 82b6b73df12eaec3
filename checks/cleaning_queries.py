"""Text and date functions, null profiles, deduplication, top-k and sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks.gold_queries import bin_sql, style_sql
from checks.inputs import (
    BOUTS, PROFILES, STYLES, TIEBREAK, VERSIONED, bouts, profiles, versioned, with_,
)
from checks.registry import query, table
from tierfold import functions as fn
from tierfold.operators import dedupe, quality, ranks, sampling, windowing
from tierfold.plans import gold


@query(
    "clean_text",
    """SELECT doc_id, md5(trim(text, chr(32) || chr(9) || chr(10) || chr(13))) AS body,
      upper(substr(lang, 1, 1)) || lower(substr(lang, 2)) AS lang,
      trim('  ' || source || ' ') AS source
    FROM documents""",
)
def clean_text(spark, sf):
    d = table(spark, sf, "documents")
    padded = F.concat(F.lit("  "), F.col("source"), F.lit(" "))
    return d.select(
        "doc_id",
        F.md5(fn.strip_text(F.col("text"))).alias("body"),
        F.initcap(F.trim(F.concat(F.lit(" "), F.col("lang")))).alias("lang"),
        F.trim(padded).alias("source"),
    )


@query(
    "normalize_label",
    f"""{with_(PROFILES)} SELECT athlete_id,
      CASE WHEN stance IS NULL OR trim(stance) = '' THEN 'unknown'
           ELSE replace(lower(trim(stance)), ' ', '_') END AS stance_norm,
      CASE WHEN team IS NULL OR trim(team) = '' THEN NULL ELSE lower(trim(team)) END AS team_norm
    FROM profiles""",
)
def normalize_label(spark, sf):
    return profiles(spark, sf).select(
        "athlete_id",
        fn.normalize_label(F.col("stance")).alias("stance_norm"),
        fn.normalize_name(F.col("team")).alias("team_norm"),
    )


@query(
    "bucket_label",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {style_sql("style")} AS bucket
    FROM (SELECT *, [{", ".join("NULL" if s is None else f"'{s}'" for s in STYLES)}]
            [CAST(l_partkey % 12 AS INTEGER) + 1] AS style FROM lineitem)""",
)
def bucket_label(spark, sf):
    style = F.get(F.array(*(F.lit(s) for s in STYLES)), (F.col("l_partkey") % 12).cast("int"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", fn.bucket_label(style).alias("bucket")
    )


@query(
    "parse_iso_ts",
    """SELECT event_id, CASE event_id % 9
        WHEN 6 THEN NULL WHEN 7 THEN NULL WHEN 8 THEN NULL
        WHEN 0 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
        WHEN 2 THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
        WHEN 4 THEN strftime(date_trunc('minute', ts) - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S')
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
    FROM events""",
)
def parse_iso_ts(spark, sf):
    """Each event's time written in one of nine shapes, three of which are no valid time."""
    shapes = [
        "yyyy-MM-dd'T'HH:mm'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm",
        "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm'+02:00'", "yyyy-MM-dd'T'HH:mm:ss",
        "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "'TBD' yyyy", "''",
    ]
    written = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        written = F.when(F.col("event_id") % 9 == i, F.date_format("ts", shape)).otherwise(written)
    return table(spark, sf, "events").select("event_id", fn.parse_iso_ts(written).alias("parsed"))


@query(
    "clip_and_bin",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, h AS height_adv_cm,
      {bin_sql("h", gold.HEIGHT_EDGES)} AS height_adv_bin,
      {bin_sql("r", gold.REACH_EDGES)} AS reach_adv_bin
    FROM (SELECT *, CAST(CASE WHEN d IS NOT NULL THEN greatest(least(d, 25), -25) END AS INTEGER)
                      AS h,
                 CASE WHEN d IS NOT NULL THEN greatest(least(d, 30), -30) END AS r
          FROM (SELECT *, CASE WHEN l_suppkey % 10 <> 0
                               THEN CAST(l_quantity AS INTEGER) * 2 - 50 END AS d FROM lineitem))""",
)
def clip_and_bin(spark, sf):
    d = F.when(F.col("l_suppkey") % 10 != 0, F.col("l_quantity").cast("int") * 2 - 50)
    line = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = table(spark, sf, "lineitem").select(*line, d.alias("d"))
    clipped = lines.select(
        *line,
        fn.clip(F.col("d"), gold.HEIGHT_EDGES[0], gold.HEIGHT_EDGES[-1]).alias("height_adv_cm"),
        fn.clip(F.col("d"), gold.REACH_EDGES[0], gold.REACH_EDGES[-1]).alias("reach_adv_cm"),
    )
    return clipped.select(
        *line,
        "height_adv_cm",
        fn.bin_label(F.col("height_adv_cm"), gold.HEIGHT_EDGES).alias("height_adv_bin"),
        fn.bin_label(F.col("reach_adv_cm"), gold.REACH_EDGES).alias("reach_adv_bin"),
    )


@query(
    "parse_feet_inches",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE l_suppkey % 4
        WHEN 0 THEN l_linenumber * 12 + l_partkey % 12 WHEN 1 THEN l_linenumber * 12
        WHEN 2 THEN l_linenumber * 12 + l_partkey % 12 END AS INTEGER) AS inches
    FROM lineitem""",
)
def parse_feet_inches(spark, sf):
    feet = F.col("l_linenumber").cast("string")
    inches = (F.col("l_partkey") % 12).cast("string")
    kind = F.col("l_suppkey") % 4
    text = (
        F.when(kind == 0, F.concat(feet, F.lit("' "), inches, F.lit('"')))
        .when(kind == 1, F.concat(F.lit(" "), feet, F.lit("'")))
        .when(kind == 2, F.concat(feet, F.lit(" '"), inches))
        .otherwise(F.lit("tall"))
    )
    line = ["l_orderkey", "l_linenumber", "l_partkey"]
    written = table(spark, sf, "lineitem").select(*line, text.alias("text"))
    return written.select(*line, fn.parse_feet_inches(F.col("text")).alias("inches"))


@query(
    "format_feet_inches",
    """SELECT l_orderkey, l_linenumber, l_partkey,
      CAST(CAST(floor(v / 12) AS INTEGER) AS VARCHAR) || ''' '
        || CAST(CAST(round_even(v - floor(v / 12) * 12, 0) AS INTEGER) AS VARCHAR) || '"' AS height
    FROM (SELECT *, l_quantity + 40.5 AS v FROM lineitem)""",
)
def format_feet_inches(spark, sf):
    height = fn.format_feet_inches(F.col("l_quantity") + 40.5)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", height.alias("height")
    )


PROFILED = ["full_name", "display_name", "stance", "team", "combat_style", "height_cm", "reach_cm"]


def _per_column(expression: str, value: str) -> str:
    return with_(PROFILES) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {expression.format(c=c)} AS {value} FROM profiles"
        for c in PROFILED
    )


@query("null_profile", _per_column("count(*) FILTER (WHERE {c} IS NULL)", "nulls"))
def null_profile(spark, sf):
    nulls = quality.null_profile(profiles(spark, sf), PROFILED)
    return quality.to_long(nulls, "column_name", "nulls")


@query("null_ratio", _per_column("count(*) FILTER (WHERE {c} IS NULL) / count(*)", "ratio"))
def null_ratio(spark, sf):
    return quality.to_long(quality.null_ratio(profiles(spark, sf), PROFILED), "column_name", "ratio")


@query(
    "prune_sparse_columns",
    """SELECT event_id, event_type, CASE WHEN event_id % 10 = 0 THEN value END AS often
    FROM events""",
)
def prune_sparse_columns(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 10 == 0, F.col("value")).alias("often"),
        F.when(F.col("event_id") % 100 == 0, F.col("value")).alias("rarely"),
        F.lit(None).cast("string").alias("never"),
    )
    return quality.prune_sparse(events, ["event_id", "event_type"])


@query(
    "partition_consistency",
    """SELECT CAST(year(o_orderdate + INTERVAL 3 DAY) AS INTEGER) AS stored_event_year,
      CAST(year(o_orderdate) AS INTEGER) AS derived_event_year, count(*) AS count
    FROM orders GROUP BY 1, 2""",
)
def partition_consistency(spark, sf):
    stored = F.year(F.col("o_orderdate") + F.expr("interval 3 days"))
    orders = table(spark, sf, "orders").withColumn("event_year", stored)
    return quality.partition_consistency(orders, "event_year", "o_orderdate")


@query(
    "latest_by_date",
    """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, value
    FROM events QUALIFY row_number() OVER (
      PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_by_date(spark, sf):
    events = table(spark, sf, "events").drop("props")
    return dedupe.latest_per_key(events, ["user_id", "event_type"], ["ts"], ["event_id"])


@query(
    "latest_by_version",
    f"""{with_(VERSIONED)} SELECT event_id, competition_id,
      strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date, run_id, fighter_b_name, amount
    FROM versioned QUALIFY row_number() OVER (PARTITION BY event_id, competition_id
      ORDER BY ingestion_date DESC, run_id DESC, {", ".join(f"{c} DESC" for c in TIEBREAK)}) = 1""",
)
def latest_by_version(spark, sf):
    rows = versioned(spark, sf)
    latest = dedupe.latest_per_key(
        rows, ["event_id", "competition_id"], dedupe.version_columns(rows), TIEBREAK
    )
    return latest.select(
        "event_id", "competition_id", "ingestion_date", "run_id", "fighter_b_name", "amount"
    )


@query("distinct_keys", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_keys(spark, sf):
    return dedupe.distinct_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "topk_desc",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderstatus
    FROM orders WHERE o_orderdate IS NOT NULL ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 20""",
)
def topk_desc(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    dated = orders.where("o_orderdate IS NOT NULL")
    return dated.orderBy(F.desc("o_orderdate"), F.asc("o_orderkey")).limit(20)


@query(
    "topk_mixed",
    f"""{with_(BOUTS)} SELECT competition_id, strftime(event_date, '%Y-%m-%d %H:%M:%S')
      AS event_date, card_order, status
    FROM bouts ORDER BY bouts.event_date DESC, card_order ASC, competition_id LIMIT 30""",
)
def topk_mixed(spark, sf):
    rows = bouts(spark, sf).select("competition_id", "event_date", "card_order", "status")
    order = [F.desc("event_date"), F.asc("card_order"), F.asc("competition_id")]
    return rows.orderBy(*order).limit(30)


@query(
    "percentile_profile",
    """SELECT lang, count(*) AS rows, avg(length(text)) AS mean,
      quantile_cont(length(text), 0.9) AS p90 FROM documents GROUP BY lang""",
)
def percentile_profile(spark, sf):
    texts = table(spark, sf, "documents").select("lang", F.length("text").alias("chars"))
    return sampling.percentile_by(texts, ["lang"], "chars", 0.9, "p90")


def _share_sql(share: float) -> str:
    at = f"(n - 1) * CAST({share} AS DOUBLE)"
    low, high = (f"max(x) FILTER (i = {f}({at}))" for f in ("floor", "ceil"))
    return f"{low} + ({high} - {low}) * max({at} - floor({at}))"


@query(
    "percentile_ranks",
    f"""WITH m AS (
      SELECT 'price' AS measure, l_returnflag AS part, l_extendedprice AS x FROM lineitem
      UNION ALL SELECT 'ts', event_type, CAST(epoch_us(ts) AS DOUBLE) FROM events
      UNION ALL SELECT 'all prices', NULL, l_extendedprice FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY measure, part ORDER BY x) - 1 AS i,
      count(*) OVER (PARTITION BY measure, part) AS n FROM m)
    SELECT measure, part, {_share_sql(0.5)} AS p50, {_share_sql(0.999)} AS p999 FROM r GROUP BY ALL""",
)
def percentile_ranks(spark, sf):
    """Percentiles of measures with about as many values as rows: prices, and times to the microsecond."""
    shares, prices = {"p50": 0.5, "p999": 0.999}, table(spark, sf, "lineitem")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    times = table(spark, sf, "events").select("event_type", micros.alias("us"))
    parts = [
        ("price", prices.select(F.col("l_returnflag").alias("part"), F.col("l_extendedprice").alias("x")), ["part"]),
        ("ts", times.select(F.col("event_type").alias("part"), F.col("us").alias("x")), ["part"]),
        ("all prices", prices.select(F.col("l_extendedprice").alias("x")), []),
    ]
    found = []
    for measure, rows, dims in parts:
        one = ranks.percentiles(ranks.ranged_counts(rows, "x", dims), "x", shares, dims)
        part = F.col("part") if dims else F.lit(None).cast("string")
        found.append(one.select(F.lit(measure).alias("measure"), part.alias("part"), "p50", "p999"))
    return reduce(lambda a, b: a.unionAll(b), found)


SPAN = """span AS (
  SELECT CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
  FROM orders)"""


def _last_day(spark, sf):
    return table(spark, sf, "orders").agg(F.max(F.to_date("o_orderdate"))).first()[0]


@query(
    "day_spine_backfill",
    f"""{with_(SPAN)} SELECT strftime(day, '%Y-%m-%d') AS day, count(o_orderkey) AS events
    FROM (SELECT unnest(generate_series(last_day - 2556, last_day, INTERVAL 1 DAY)) AS day
          FROM span) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1""",
)
def day_spine_backfill(spark, sf):
    """Orders per day of the seven years up to the last order, days without orders included."""
    last = _last_day(spark, sf)
    spine = windowing.day_spine(spark, windowing.backfill_start(last, 7), last)
    per_day = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("events")
    )
    return spine.join(per_day, "day", "left").na.fill(0, ["events"])


DOCUMENT_DAYS = """days AS (
  SELECT CAST(day AS DATE) AS day, count(o_orderkey) AS events,
         CAST(coalesce(sum(1 + o_orderkey % 3), 0) AS BIGINT) AS fights,
         CAST(coalesce(sum(length(o_orderpriority)), 0) AS BIGINT) AS chars
  FROM (SELECT unnest(generate_series(last_day - 2556, last_day, INTERVAL 1 DAY)) AS day FROM span)
  LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY 1)"""


@query(
    "workload_profile",
    f"""{with_(SPAN, DOCUMENT_DAYS)}, m AS (
      SELECT count(*) AS days_total, count(*) AS sample_days,
        CAST(sum(events) AS BIGINT) AS sampled_events, avg(events) AS avg_events_per_day,
        sum(fights) / sum(events) AS avg_fights_per_event,
        CAST(floor(sum(chars) / sum(events)) AS BIGINT) AS avg_payload_chars,
        quantile_cont(events, 0.9) AS p90_events_per_day FROM days),
    e AS (SELECT *, CAST(round_even(avg_events_per_day * days_total, 0) AS BIGINT)
        AS estimated_events_total FROM m)
    SELECT *, days_total + estimated_events_total AS estimated_requests_total,
      estimated_events_total * avg_payload_chars AS estimated_total_chars FROM e""",
)
def workload_profile(spark, sf):
    last = _last_day(spark, sf)
    spine = windowing.day_spine(spark, windowing.backfill_start(last, 7), last)
    documents = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("day"),
        (F.lit(1) + F.col("o_orderkey") % 3).alias("num_fights"),
        F.length("o_orderpriority").alias("chars"),
    )
    return sampling.workload_profile(documents, spine)


@query(
    "even_sample",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
    n AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM d)
    SELECT strftime(day, '%Y-%m-%d') AS day FROM n WHERE n <= 12 OR i IN (
      SELECT CAST(round_even(step * (m - 1) / 11.0, 0) AS BIGINT)
      FROM range(12) r(step), (SELECT count(*) AS m FROM d))""",
)
def even_sample(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    return sampling.even_sample(days, "day", 12)


def _even_sql(source: str, k: int) -> str:
    return f"""SELECT v FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n
      FROM (SELECT DISTINCT {source})) WHERE i IN (
        SELECT CAST(round_even(step * (n - 1) / {k - 1}.0, 0) AS BIGINT) FROM range({k}) r(step))"""


@query(
    "even_sample_values",
    f"""SELECT 'price' AS source, CAST(v AS VARCHAR) AS value FROM ({_even_sql("CAST(round(l_extendedprice * 100) AS BIGINT) AS v FROM lineitem", 25)})
    UNION ALL SELECT 'name', v FROM ({_even_sql("c_name AS v FROM customer", 8)})""",
)
def even_sample_values(spark, sf):
    """Evenly spaced prices in hundredths, and names, of which nearly every row has its own."""
    prices = table(spark, sf, "lineitem").select(F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"))
    names = table(spark, sf, "customer").select(F.col("c_name").alias("v"))
    parts = [("price", prices, 25), ("name", names, 8)]
    picked = [
        sampling.even_sample(df, "v", k).select(F.lit(source).alias("source"), F.col("v").cast("string").alias("value"))
        for source, df, k in parts
    ]
    return picked[0].unionAll(picked[1])
