"""Bouts, profiles and documents derived from the given tables, as DataFrames and as SQL.

Every row of the source table becomes a row here. Each derivation is written twice, once per
engine; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table

# --- bouts <- orders, profiles <- customer and nation -------------------------------------------

# Style texts that reach every branch of the bucketing rule.
STYLES = [
    None, "", "0", "Boxing, Judo", "Brazilian Jiu-Jitsu", "Muay Thai and Sambo",
    "Kung-Fu; Karate", "Wrestling vs Boxing", "Freestyle", "Brawler & Boxing", "Capoeira",
    "Street Fighting",
]


def _customer_name(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 9, "0"))


def bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bouts: the customer meets another one, a few of whom have no profile."""
    opponents = table(spark, sf_dir, "customer").count() + 50
    o, status = table(spark, sf_dir, "orders"), F.col("o_orderstatus")
    opponent = (F.col("o_custkey") * 7 + F.col("o_orderkey")) % opponents
    return o.select(
        F.col("o_orderkey").cast("string").alias("competition_id"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("event_id"),
        F.col("o_orderdate").alias("event_date"),
        F.year("o_orderdate").alias("event_year"),
        F.col("o_orderpriority").alias("weight_class"),
        (F.col("o_orderkey") % 12).cast("int").alias("card_order"),
        status.alias("status"),
        _customer_name("Customer#", F.col("o_custkey")).alias("fighter_a_name"),
        F.when(status == "F", True).when(status == "O", False).alias("fighter_a_winner"),
        _customer_name("CUSTOMER#", opponent).alias("fighter_b_name"),
        F.when(status == "F", False).when(status == "O", True).alias("fighter_b_winner"),
    )


BOUTS = """bouts AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS competition_id,
         strftime(o_orderdate, '%Y%m%d') AS event_id,
         o_orderdate AS event_date,
         CAST(year(o_orderdate) AS INTEGER) AS event_year,
         o_orderpriority AS weight_class,
         CAST(o_orderkey % 12 AS INTEGER) AS card_order,
         o_orderstatus AS status,
         'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS fighter_a_name,
         CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS fighter_a_winner,
         'CUSTOMER#' || lpad(CAST((o_custkey * 7 + o_orderkey)
             % ((SELECT count(*) FROM customer) + 50) AS VARCHAR), 9, '0') AS fighter_b_name,
         CASE o_orderstatus WHEN 'F' THEN false WHEN 'O' THEN true END AS fighter_b_winner
  FROM orders)"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as athletes: gaps in every attribute, and some namesakes."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    k = F.col("c_custkey")
    styles = F.array(*(F.lit(s) for s in STYLES))
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select(
        k.cast("string").alias("athlete_id"),
        F.col("c_name").alias("full_name"),
        F.when(k % 97 == 0, _customer_name("Customer#", k + 1))
        .when(k % 2 == 0, F.upper("c_name"))
        .otherwise(F.concat(F.lit("alt "), k.cast("string")))
        .alias("display_name"),
        F.date_add(F.lit("1970-01-01").cast("date"), (k % 9000).cast("int")).alias("birth_date"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .when(k % 11 == 1, F.lit(" "))
        .otherwise(F.col("c_mktsegment"))
        .alias("stance"),
        F.when(k % 13 != 0, F.concat(F.lit(" "), F.col("n_name"))).alias("team"),
        F.get(styles, (k % 12).cast("int")).alias("combat_style"),
        (F.lit(150) + k % 60).cast("int").alias("height_cm"),
        F.when(k % 9 != 0, (F.lit(150) + (k * 3) % 70).cast("int")).alias("reach_cm"),
    )


def _sql_list(values: list[str | None]) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


PROFILES = f"""profiles AS (
  SELECT CAST(c_custkey AS VARCHAR) AS athlete_id,
         c_name AS full_name,
         CASE WHEN c_custkey % 97 = 0
                THEN 'Customer#' || lpad(CAST(c_custkey + 1 AS VARCHAR), 9, '0')
              WHEN c_custkey % 2 = 0 THEN upper(c_name)
              ELSE 'alt ' || CAST(c_custkey AS VARCHAR) END AS display_name,
         DATE '1970-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS birth_date,
         CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 11 = 1 THEN ' '
              ELSE c_mktsegment END AS stance,
         CASE WHEN c_custkey % 13 <> 0 THEN ' ' || n_name END AS team,
         {_sql_list(STYLES)}[CAST(c_custkey % 12 AS INTEGER) + 1] AS combat_style,
         CAST(150 + c_custkey % 60 AS INTEGER) AS height_cm,
         CASE WHEN c_custkey % 9 <> 0
              THEN CAST(150 + (c_custkey * 3) % 70 AS INTEGER) END AS reach_cm
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

# Both orientations as rows: one per bout and side.
SIDES = """sides AS (
  SELECT competition_id, event_id, event_date, event_year, weight_class, 'A' AS side,
         fighter_a_name AS athlete_name, fighter_a_winner AS is_winner FROM bouts
  UNION ALL
  SELECT competition_id, event_id, event_date, event_year, weight_class, 'B' AS side,
         fighter_b_name AS athlete_name, fighter_b_winner AS is_winner FROM bouts)"""

# Literal name match: either name, ignoring case.
RESOLVED = """resolved AS (
  SELECT s.*, p.athlete_id, p.stance, p.team, p.combat_style, p.height_cm, p.reach_cm
  FROM sides s LEFT JOIN profiles p
    ON lower(s.athlete_name) = lower(p.full_name)
    OR lower(s.athlete_name) = lower(p.display_name))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


GOLD = with_(BOUTS, PROFILES, SIDES, RESOLVED)

# --- versioned rows <- lineitem -----------------------------------------------------------------


def versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as bout versions: many (order, line) keys occur more than once."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("event_id"),
        F.col("l_linenumber").cast("string").alias("competition_id"),
        F.col("l_shipdate").alias("event_date"),
        F.year("l_shipdate").alias("event_year"),
        F.concat(F.lit("  "), F.col("l_returnflag"), F.lit(" class ")).alias("weight_class"),
        F.col("l_linenumber").alias("card_order"),
        F.col("l_linestatus").alias("status"),
        F.concat(F.lit(" part "), F.col("l_partkey").cast("string")).alias("fighter_a_name"),
        (F.col("l_quantity") > 25).alias("fighter_a_winner"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit(" ")).alias("fighter_b_name"),
        (F.col("l_quantity") <= 25).alias("fighter_b_winner"),
        F.to_date("l_shipdate").alias("ingestion_date"),
        F.lpad(F.col("l_partkey").cast("string"), 5, "0").alias("run_id"),
        F.col("l_extendedprice").alias("amount"),
    )


VERSIONED = """versioned AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS event_id,
         CAST(l_linenumber AS VARCHAR) AS competition_id,
         l_shipdate AS event_date,
         CAST(year(l_shipdate) AS INTEGER) AS event_year,
         '  ' || l_returnflag || ' class ' AS weight_class,
         CAST(l_linenumber AS INTEGER) AS card_order,
         l_linestatus AS status,
         ' part ' || CAST(l_partkey AS VARCHAR) AS fighter_a_name,
         l_quantity > 25 AS fighter_a_winner,
         CAST(l_suppkey AS VARCHAR) || ' ' AS fighter_b_name,
         l_quantity <= 25 AS fighter_b_winner,
         CAST(l_shipdate AS DATE) AS ingestion_date,
         lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS run_id,
         l_extendedprice AS amount
  FROM lineitem)"""
# Order that settles equal versions of a key.
TIEBREAK = ["fighter_b_name", "amount", "weight_class", "status"]

# --- upsert pair: target <- orders (line 1 of each order), source <- lineitem --------------------


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"),
        F.lit(1).alias("competition_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("event_date"),
        F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate")).alias("ingestion_date"),
        F.col("o_orderpriority").alias("run_id"),
        F.col("o_totalprice").alias("amount"),
    )


def upsert_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest line per key; dated so that some lines match their order's day exactly."""
    from tierfold.operators.dedupe import latest_per_key

    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_linenumber").alias("competition_id"),
        F.col("l_shipdate").alias("event_date"),
        F.to_date("l_shipdate").alias("ingestion_date"),
        F.concat(F.lit("3-"), F.col("l_returnflag"), F.lit("X")).alias("run_id"),
        F.col("l_extendedprice").alias("amount"),
    )
    return latest_per_key(
        lines, ["event_id", "competition_id"], ["event_date"], ["amount", "run_id"]
    )


UPSERT_PAIR = """t AS (
  SELECT o_orderkey AS event_id, CAST(1 AS INTEGER) AS competition_id,
         CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS event_date,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS ingestion_date,
         o_orderpriority AS run_id, o_totalprice AS amount
  FROM orders),
s AS (
  SELECT l_orderkey AS event_id, CAST(l_linenumber AS INTEGER) AS competition_id,
         l_shipdate AS event_date, CAST(l_shipdate AS DATE) AS ingestion_date,
         '3-' || l_returnflag || 'X' AS run_id, l_extendedprice AS amount
  FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_extendedprice DESC, l_returnflag DESC) = 1)"""
