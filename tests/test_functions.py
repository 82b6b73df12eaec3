from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tierfold import functions as fn
from tierfold.plans.gold import HEIGHT_EDGES, REACH_EDGES


def applied(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r[0] for r in df.select("i", expression(F.col("v")).alias("r")).orderBy("i")
            .select("r").collect()]


def test_timestamps_in_every_shape(spark):
    texts = [
        "2025-02-15T21:00Z", "2025-02-15T21:00:05Z", "2025-02-15 21:00", "2025-02-15T21:00:05",
        "2025-02-15T21:00+02:00", "2025-02-15T21:00:05-0530", "2025-02-15T21:00+02",
        "2025-02-15T21:00:05.123Z", "2025-02-15", "junk", "", None,
    ]
    at = lambda h, m=0, s=0: datetime(2025, 2, 15, h, m, s)
    nothing = [None] * 5
    assert applied(spark, texts, "STRING", lambda c: F.date_format(fn.parse_iso_ts(c), "HH:mm:ss")) == [
        f"{t:%H:%M:%S}" for t in (
            at(21), at(21, 0, 5), at(21), at(21, 0, 5), at(19), datetime(2025, 2, 16, 2, 30, 5),
            at(19),
        )
    ] + nothing


def test_dates_are_lenient(spark):
    texts = ["1990-01-02T08:00Z", "1990-01-02", "soon", None]
    found = applied(spark, texts, "STRING", lambda c: fn.try_date(c).cast("string"))
    assert found == ["1990-01-02", "1990-01-02", None, None]


@pytest.mark.parametrize(
    "text, bucket",
    [
        (None, "mma"), ("", "mma"), (" \t", "mma"), ("0", None), (" 0 / boxing", None),
        ("Boxing, Judo", "striker"), ("Brazilian Jiu-Jitsu", "wrestler"),
        ("Gracie Jiu Jitsu", "wrestler"), ("Muay Thai and Sambo", "striker"),
        ("a vs and b", "mma"), ("Street Fighting;x", "street_fighting"), ("Kung-Fu|x", "striker"),
        ("Brawler\\x", "street_fighting"), ("Wrestling vs Boxing", "wrestler"), ("Capoeira", "mma"),
    ],
)
def test_style_buckets(spark, text, bucket):
    assert applied(spark, [text], "STRING", fn.bucket_label) == [bucket]


def test_labels_and_names(spark):
    values = [None, "", "  ", "\t", " South Paw ", "Orthodox\n"]
    assert applied(spark, values, "STRING", fn.normalize_label) == [
        "unknown", "unknown", "unknown", "", "south_paw", "orthodox"
    ]
    assert applied(spark, values, "STRING", fn.normalize_name) == [
        None, None, None, "", "south paw", "orthodox"
    ]


def test_clip_then_bin(spark):
    values = [-40, -25, -5, 0, 4, 5, 24, 25, 40, None]

    def label(c):
        return fn.bin_label(fn.clip(c, -25, 25), HEIGHT_EDGES)

    assert applied(spark, values, "INT", label) == [
        "[-25,-20)", "[-25,-20)", "[-5,0)", "[0,5)", "[0,5)", "[5,10)", "[20,25]", "[20,25]",
        "[20,25]", None,
    ]
    assert applied(spark, [-31, 30, 31], "INT", lambda c: fn.bin_label(c, REACH_EDGES)) == [
        None, "[20,30]", None
    ]
    assert applied(spark, [-25, 24, 25, 26], "INT", lambda c: fn.bin_low(c, HEIGHT_EDGES)) == [
        -25, 20, 20, None
    ]


def test_feet_and_inches(spark):
    texts = ["6' 1\"", "5'", "5' 11", " 5 ' 7\" tall", "abc", "", None]
    assert applied(spark, texts, "STRING", fn.parse_feet_inches) == [
        73, 60, 71, 67, None, None, None
    ]
    assert applied(spark, [71.6, 72.5, 73.5, None], "DOUBLE", fn.format_feet_inches) == [
        "5' 12\"", "6' 0\"", "6' 2\"", None
    ]


def test_numbers(spark):
    assert applied(spark, ["7", "007", "7.0", "-7", "", None], "STRING", fn.digits_to_int) == [
        7, 7, None, None, None, None
    ]
    rows = spark.createDataFrame([(1, 4), (0, 0)], "n INT, d INT")
    assert [r[0] for r in rows.select(fn.safe_ratio(F.col("n"), F.col("d"))).collect()] == [0.25, 0.0]


def test_white_space_of_every_kind_is_stripped(spark):
    values = ["　a b\xa0", " \t\n", "x"]
    assert applied(spark, values, "STRING", fn.strip_text) == [v.strip() for v in values]
