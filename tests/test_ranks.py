"""Selection by rank against sorted lists."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tierfold.operators import ranks, sampling


def ranked(df, value, wanted, dims=()):
    return ranks.at_ranks(ranks.ranged_counts(df, value, dims), value, wanted, dims)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(3000):
        group = rng.choice(["a", "a", "b", None])
        x = 7.5 if i % 3 == 0 else rng.choice([None, rng.gauss(0, 1000)])  # a third of one value
        out.append((group, x, start + timedelta(microseconds=rng.randrange(10**12)), f"n{rng.randrange(2000)}"))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "g STRING, x DOUBLE, ts TIMESTAMP, name STRING").repartition(5)


def test_values_at_ranks_of_groups(rows, frame):
    found = ranked(frame, "x", lambda n: F.array(F.lit(0), F.floor(n / 2), n - 1, n, F.lit(-1)), ["g"])
    groups = {}
    for g, x, *_ in rows:
        if x is not None:
            groups.setdefault(g, []).append(x)
    expected = set()
    for g, xs in groups.items():
        xs.sort()
        expected |= {(g, r, xs[r], len(xs)) for r in (0, len(xs) // 2, len(xs) - 1)}
    assert {tuple(r) for r in found.collect()} == expected


@pytest.mark.parametrize("column, place", [("ts", 2), ("name", 3), ("x", 1)])
def test_every_rank_of_any_type(rows, frame, column, place):
    values = sorted(r[place] for r in rows if r[place] is not None)
    found = ranked(frame, column, lambda n: F.sequence(F.lit(0), n - 1, F.lit(37)))
    assert sorted((r["rank"], r[column]) for r in found.collect()) == [(i, values[i]) for i in range(0, len(values), 37)]


def test_no_window_over_everything(frame, plan):
    text = plan(ranked(frame, "ts", lambda n: F.array(n - 1)))
    assert "Window" in text and "SinglePartition" not in text.split("Window")[1].split("Filter")[0]


def test_percentiles(spark, rows, frame):
    found = ranks.percentiles(ranks.ranged_counts(frame, "x", ["g"]), "x", {"p": 0.9, "low": 0.0}, ["g"])
    for r in found.collect():
        xs = sorted(x for g, x, *_ in rows if g == r.g and x is not None)
        at = (len(xs) - 1) * 0.9
        i, part = int(at), at - int(at)
        assert (r.p, r.low) == (xs[i] + (xs[min(i + 1, len(xs) - 1)] - xs[i]) * part, xs[0])
    none = spark.createDataFrame([("a", None), (None, 3)], "g STRING, v INT")
    by = {r.g: (r.rows, r["mean"], r.p) for r in sampling.percentile_by(none, ["g"], "v", 0.5, "p").collect()}
    assert by == {"a": (1, None, None), None: (1, 3.0, 3.0)}
    whole = sampling.percentile_by(none, [], "v", 0.5, "p").first()
    assert (whole.rows, whole.p) == (2, 3.0)


def test_even_sample_of_an_empty_column(spark):
    assert sampling.even_sample(spark.createDataFrame([], "v STRING"), "v", 4).collect() == []
    few = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "v STRING")
    assert sorted(r.v for r in sampling.even_sample(few, "v", 4).collect()) == ["a", "b"]
