"""Event and profile documents built row by row from orders and customers.

No grouping is needed to build them: an order is an event with one to three bouts of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import table


def _obj(**fields: Column) -> Column:
    """JSON object; fields that are NULL are left out of the text."""
    return F.struct(*(value.alias(name) for name, value in fields.items()))


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


#: Documents would be read from files in many splits; the compact rows that they are made of come
#: in one, so they are dealt out, the same way at every size.
PARTS = 32


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    return rows.repartition(PARTS, key)


def athlete_url(key: Column) -> Column:
    return F.concat(F.lit("http://x/athletes/"), key.cast("string"), F.lit("?lang=en"))


def _stat(name=None, short=None, shown=None, value=None) -> Column:
    def text(c):
        return _none("string") if c is None else c

    return _obj(
        name=text(name), shortDisplayName=text(short), displayValue=text(shown),
        value=_none("bigint") if value is None else value,
    )


def _bout(i: Column) -> Column:
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    number = i + 1
    stats = F.array(
        _stat(name=F.lit("kd "), shown=F.lit("1")),
        _stat(short=F.lit("td"), shown=F.lit(""), value=i.cast("bigint")),
        _stat(name=F.lit("kd"), shown=k.cast("string")),
    )
    linked = _obj(**{"$ref": athlete_url(F.col("o_custkey")), "displayName": _none("string")})
    guest = F.concat(F.lit("Guest "), (k + i).cast("string"))
    inline = _obj(**{"$ref": _none("string"), "displayName": guest})
    first = _obj(
        winner=F.when(status == "F", True).when(status == "O", False),
        athlete=linked,
        statistics=stats,
    )
    second = _obj(
        winner=F.when(status == "F", False).when(status == "O", True),
        athlete=inline,
        statistics=F.when(F.lit(False), stats),
    )
    class_url = F.concat(F.lit("http://x/class/"), F.substring("o_orderpriority", 1, 1))
    return _obj(
        id=(k * 10 + i).cast("string"),
        date=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        name=F.concat(F.lit("Bout "), k.cast("string"), F.lit("-"), number.cast("string")),
        matchNumber=F.when(k % 2 == 0, number),
        order=F.when(k % 2 == 1, number.cast("string")),
        type=F.when(i == 0, _obj(text=F.col("o_orderpriority"))),
        weightClass=F.when(i > 0, _obj(**{"$ref": class_url})),
        status=_obj(type=_obj(name=status)),
        venue=_obj(fullName=F.concat(F.lit("Hall "), status)),
        competitors=F.array(first, second),
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, event_id, payload): plain and enveloped events, with gaps at the top level."""
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    hall = _obj(
        fullName=F.concat(F.lit(" Hall "), F.col("o_orderpriority")), address=_obj(country=status)
    )
    event = _obj(
        id=k,
        date=F.when(k % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'Z'")),
        name=F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("Event "), k.cast("string"))),
        shortName=F.when(k % 10 == 3, F.concat(F.lit("E"), k.cast("string"))),
        venue=F.when(k % 3 == 0, hall),
        status=_obj(
            type=F.when(k % 2 == 0, _obj(name=status)),
            name=F.when((k % 2 == 1) & (k % 7 != 0), status),
        ),
        competitions=F.col("bouts"),
    )
    payload = F.when(k % 10 == 3, F.to_json(_obj(header=event))).otherwise(
        F.to_json(event)
    )
    # Bouts 0 to k % 3, each as an expression of its own: a lambda over a sequence is not compiled.
    step = F.when(k < 0, F.lit(-1)).otherwise(F.lit(1))
    bouts = F.slice(F.array(*(_bout(F.lit(i) * step) for i in range(3))), 1, F.abs(k % 3).cast("int") + 1)
    return _dealt(table(spark, sf_dir, "orders"), "o_orderkey").withColumn("bouts", bouts).select(
        F.to_date("o_orderdate").alias("day"), k.alias("event_id"), payload.alias("payload")
    )


def event_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, payload): what the events' pointers lead to."""
    athletes = table(spark, sf_dir, "customer").select(
        athlete_url(F.col("c_custkey")).alias("url"),
        F.to_json(
            _obj(
                displayName=F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")),
                fullName=F.col("c_name"),
            )
        ).alias("payload"),
    )
    classes = table(spark, sf_dir, "orders").select("o_orderpriority").distinct().select(
        F.concat(F.lit("http://x/class/"), F.substring("o_orderpriority", 1, 1)).alias("url"),
        F.to_json(_obj(name=F.col("o_orderpriority"))).alias("payload"),
    )
    return athletes.unionByName(classes)


# The documents' contents as SQL: one row per event, and one row per bout.
EVENTS = """ev AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr,
         o_orderdate AS d, 1 + o_orderkey % 3 AS n FROM orders),
event_rows AS (
  SELECT CAST(k AS VARCHAR) AS event_id,
         CASE WHEN k % 5 <> 0 THEN strftime(d, '%Y-%m-%dT%H:%MZ')
              ELSE strftime(d, '%Y-%m-%dT%H:%M:%SZ') END AS event_date,
         CASE WHEN k % 4 <> 0 THEN 'Event ' || k
              WHEN k % 10 = 3 THEN 'E' || k ELSE 'Bout ' || k || '-1' END AS event_name,
         CASE WHEN k % 3 = 0 THEN ' Hall ' || pr ELSE 'Hall ' || st END AS venue,
         CASE WHEN k % 3 = 0 THEN st END AS country,
         st AS status,
         CAST(n AS INTEGER) AS num_fights
  FROM ev)"""
BOUT_ROWS = """bout_rows AS (
  SELECT CAST(k * 10 + i AS VARCHAR) AS competition_id,
         CAST(k AS VARCHAR) AS event_id,
         CASE WHEN k % 5 <> 0 THEN strftime(d, '%Y-%m-%dT%H:%MZ')
              ELSE strftime(d, '%Y-%m-%dT%H:%M:%SZ') END AS event_date,
         'Bout ' || k || '-' || (i + 1) AS bout_name,
         pr AS weight_class,
         CAST(i + 1 AS INTEGER) AS card_order,
         st AS status,
         'Customer#' || lpad(CAST(c AS VARCHAR), 9, '0') AS fighter_a_name,
         CASE st WHEN 'F' THEN true WHEN 'O' THEN false END AS fighter_a_winner,
         '{"kd":"' || k || '","td":"' || i || '"}' AS fighter_a_stats,
         'Guest ' || (k + i) AS fighter_b_name,
         CASE st WHEN 'F' THEN false WHEN 'O' THEN true END AS fighter_b_winner,
         '{}' AS fighter_b_stats
  FROM (SELECT *, unnest(range(n)) AS i FROM ev))"""


def _born(k: Column) -> Column:
    day = F.date_add(F.lit("1970-01-01").cast("date"), (k % 9000).cast("int"))
    return F.date_format(day, "yyyy-MM-dd")


def profile_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(athlete_id, payload): customers as profiles, each field in several shapes.

    A NULL field is left out of the JSON text, so each row has one shape of every field.
    """
    k, segment = F.col("c_custkey"), F.col("c_mktsegment")
    nation = F.col("c_nationkey").cast("string")
    country = F.concat(F.lit("N"), nation)
    cm, inches = F.lit(150.9) + k % 60, F.lit(60.5) + k % 20
    feet = (F.lit(4) + F.floor(k / 6) % 3).cast("string")
    even = k % 2 == 0
    no_text, no_number = _none("string"), _none("double")

    def mixed(*texts: tuple[Column, Column]) -> Column:
        """JSON values of different types in one field."""
        text = no_text
        for condition, value in texts:
            text = F.when(condition, value).otherwise(text)
        return F.parse_json(text)

    judo = _obj(text=F.lit("Judo"), name=no_text)
    boxing = _obj(text=no_text, name=F.lit("Boxing"))
    karate = _obj(text=F.lit("Karate"), name=no_text)
    link = F.concat(F.lit("http://x/places/"), nation)
    body = _obj(
        error=F.when(k % 50 == 49, F.lit("timed out")),
        fullName=F.when(k % 3 != 0, F.col("c_name")),
        name=F.when(k % 3 == 0, F.col("c_name")),
        displayName=F.upper("c_name"),
        birthDate=F.when(even, F.concat(_born(k), F.lit("T08:00Z"))),
        dateOfBirth=F.when(~even, _born(k)),
        citizenship=F.when(k % 5 == 0, country).when(k % 5 == 1, F.lit("")),
        association=_obj(
            name=F.when(k % 7 != 0, F.concat(F.lit("Team "), nation)),
            location=F.when(k % 5 == 1, _obj(country=country)),
        ),
        birthPlace=F.when(
            k % 5 == 2, _obj(**{"$ref": link, "country": no_text, "name": no_text})
        ).when(k % 5 == 3, _obj(**{"$ref": no_text, "country": F.lit(""), "name": country})),
        citizenshipCountry=F.when(
            k % 5 == 4, _obj(alt=F.when(even, country), name=F.when(~even, country))
        ),
        heightCentimeters=F.when(k % 6 == 0, cm),
        height=mixed(
            (k % 6 == 1, F.to_json(_obj(centimeters=cm))), (k % 6 == 2, inches.cast("string"))
        ),
        displayHeight=F.when(k % 6 == 3, F.concat(F.lit(" "), feet, F.lit("' 7\""))),
        reachCentimeters=F.when(k % 6 == 0, cm),
        reach=mixed((k % 6 == 1, F.to_json(_obj(cm=cm))), (k % 6 == 2, inches.cast("string"))),
        displayReach=F.when(k % 6 == 3, F.concat(inches.cast("string"), F.lit('"'))),
        measurements=F.when(
            k % 6 == 4,
            F.array(
                _obj(type=F.lit("Height"), value=cm, centimeters=no_number),
                _obj(type=F.lit("reach"), value=no_number, centimeters=cm),
            ),
        ),
        stance=mixed(
            (k % 4 == 0, F.to_json(_obj(text=segment))),
            (k % 4 == 1, F.to_json(_obj(name=segment))),
            (k % 4 == 2, F.concat(F.lit('"'), segment, F.lit('"'))),
        ),
        fightingStyle=F.lit("Freestyle"),
        weightClass=_obj(text=F.when(even, segment), shortName=F.when(~even, segment)),
        styles=F.when(k % 3 == 0, F.array(judo, boxing, judo)).when(k % 3 == 1, F.array(karate)),
        headshot=_obj(href=F.concat(F.lit("http://x/img/"), k.cast("string"))),
    )
    return _dealt(table(spark, sf_dir, "customer"), "c_custkey").select(
        k.alias("athlete_id"), F.to_json(body).alias("payload")
    )


def place_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, payload): birth places, some without a country of their own."""
    key = F.col("n_nationkey")
    country = F.when(key % 2 == 0, F.col("n_name")).otherwise(F.lit(""))
    place = _obj(country=country, name=F.concat(F.lit("City of "), F.col("n_name")))
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("http://x/places/"), key.cast("string")).alias("url"),
        F.to_json(place).alias("payload"),
    )


PROFILE_ROWS = """profile_rows AS (
  SELECT CAST(k AS VARCHAR) AS athlete_id, c_name AS full_name, upper(c_name) AS display_name,
         strftime(DATE '1970-01-01' + CAST(k % 9000 AS INTEGER), '%Y-%m-%d') AS birth_date,
         CASE WHEN k % 5 <> 2 THEN 'N' || c_nationkey
              WHEN n_nationkey % 2 = 0 THEN n_name ELSE 'City of ' || n_name END AS country,
         CASE k % 6
           WHEN 2 THEN CAST(floor(inches / 12) AS INTEGER) || ''' '
             || CAST(round_even(inches - floor(inches / 12) * 12, 0) AS INTEGER) || '"'
           WHEN 3 THEN feet || ''' 7"' END AS height,
         CAST(CASE k % 6 WHEN 2 THEN round_even(inches * CAST(2.54 AS DOUBLE), 0)
           WHEN 3 THEN round_even((feet * 12 + 7) * CAST(2.54 AS DOUBLE), 0)
           WHEN 5 THEN NULL ELSE 150 + k % 60 END AS INTEGER) AS height_cm,
         CAST(CASE k % 6 WHEN 2 THEN round_even(inches * CAST(2.54 AS DOUBLE), 0)
           WHEN 3 THEN round_even(inches * CAST(2.54 AS DOUBLE), 0)
           WHEN 5 THEN NULL ELSE 150 + k % 60 END AS INTEGER) AS reach_cm,
         CASE WHEN k % 4 = 3 THEN 'Freestyle' ELSE c_mktsegment END AS stance,
         c_mktsegment AS weight_class,
         CASE WHEN k % 7 <> 0 THEN 'Team ' || c_nationkey END AS team,
         CASE k % 3 WHEN 0 THEN 'Boxing, Judo' WHEN 1 THEN 'Karate' END AS combat_style,
         'http://x/img/' || k AS image_url, k % 50 = 49 AS failed
  FROM (SELECT *, c_custkey AS k, CAST(60.5 AS DOUBLE) + c_custkey % 20 AS inches,
               4 + (c_custkey // 6) % 3 AS feet
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey))"""
