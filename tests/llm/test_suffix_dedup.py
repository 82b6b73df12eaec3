"""Removed bytes against all windows in a dictionary."""

import hashlib
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tierfold.llm import suffix_dedup as sd

SCHEMA = "doc_id LONG, text STRING, spans INT"


def plain(rows):
    """{(doc_id, text): (bytes, removed, spans, digest)} by looking every window up."""
    docs = sorted({(i if i is not None else sd.NULL_ID, t or "") for i, t in rows}, key=lambda d: d[0])
    assert len({i for i, _ in docs}) == len(docs)
    seen, out = set(), {}
    for i, t in docs:
        data = t.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and not before for g, before in zip(gone, b"\0" + bytes(gone), strict=False))
        out[i] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def texts(seed, n):
    rng = random.Random(seed)
    words = ["aé", "bb", "the", "of", "ün", "house", "x", "\n", "日本"]
    sentence = lambda k: " ".join(rng.choices(words, k=k))
    passages = [sentence(k) for k in (15, 30, 40, 80, 200)]
    out = ["", None, "short", "a" * 99, "b" * 100, "c" * 101, "d" * 700, "ab" * 400, "abc" * 300 + "x" + "abc" * 300]
    while len(out) < n:
        parts = [sentence(rng.randrange(0, 90))]
        for _ in range(rng.choice([0, 1, 3])):
            parts += [rng.choice(passages), sentence(rng.randrange(0, 60))]
        text = rng.choice([" ", ""]).join(parts)
        out += [text, text] if rng.random() < 0.1 else [text]
        if rng.random() < 0.2:
            at = rng.randrange(len(text) + 1)
            out.append(text[:at] + "!" + text[at:])
    rng.shuffle(out)
    return out[:n]


@pytest.mark.parametrize("dealt", [False, True])
def test_against_all_windows(spark, monkeypatch, dealt):
    if dealt:  # marks of more than a few rows go to several tasks
        monkeypatch.setattr(sd, "MARK_ROWS", 3)
    monkeypatch.setattr(sd, "SEGMENT", 1000)
    rows = [(None if i == 50 else 3 * i % 1000, t) for i, t in enumerate(texts(4, 260))]
    df = spark.createDataFrame([(*r, 0) for r in rows + rows[:9]], SCHEMA).repartition(4)
    got = sd.suffix_dedup(df).collect()
    expected = plain(rows)
    assert len(got) == 269
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == expected[sd.NULL_ID if r.doc_id is None else r.doc_id]
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert sum(r.n_removed for r in got) > 20_000


def test_a_full_filter_changes_nothing(spark):
    rows = [(i, t) for i, t in enumerate(texts(9, 80))]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = {r.doc_id: tuple(r)[1:5] for r in sd.suffix_dedup(df, with_bytes=False, filter_bits=10).collect()}
    assert got == plain(rows)


def test_deep_shallow_orders_all_strings():
    rng = random.Random(1)
    data = bytes(rng.choices(b"ab", k=300)) + b"a" * 400 + bytes(rng.choices(b"abcd", k=600)) * 2
    starts = np.array(rng.sample(range(len(data) - 100), 900))
    group = np.array(rng.choices([3, 8], k=900))
    order, cls = sd.deep_shallow(data, starts, group)
    strings = [(int(group[i]), data[starts[i] : starts[i] + 100]) for i in range(900)]
    assert [strings[i] for i in order] == sorted(strings)
    assert cls[-1] + 1 == len(set(strings)) and len({(strings[i], c) for i, c in zip(order, cls, strict=True)}) == cls[-1] + 1


def test_equal_windows_have_equal_marks():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 5000).astype(np.uint8)
    copy = np.concatenate([rng.integers(97, 99, 77).astype(np.uint8), data[1000:3000]])
    places = []
    for x in (data, copy):
        h, at, first, last = sd.marks(x, np.arange(len(x) - 99))
        places.append({w: a - w for a, f, t in zip(at, first, last, strict=True) for w in range(f, t + 1)})
        assert len(places[-1]) == len(x) - 99
    assert all(places[0][1000 + k] == places[1][77 + k] for k in range(1900))


def test_runs_of_a_short_period_are_a_span_and_a_few_windows():
    texts_ = [b" " * 300_000, b"-=" * 50_000 + b"end", b"one two three four five. " * 8_000, b"\0" * 99]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(4), pa.int64()), pa.array([5] * 4, pa.int64()), pa.array(texts_, pa.binary())], names=["doc", "k2", "bytes"]
    )
    kept = type("Broadcast", (), {"value": b"\xff" * 16})
    rows = [r for out in sd._candidates(kept, 7)(iter([batch])) for r in out.to_pylist()]
    assert len(rows) < 100
    assert sum(b.num_rows for b in sd._all_marks(iter([batch]))) == sum(r["mark"] != sd.RUN for r in rows)
    for doc, text in enumerate(texts_):
        windows = sorted((r["first"], r["windows"]) for r in rows if r["doc"] == doc)
        assert sum(n for _, n in windows) == max(0, len(text) - 99)


def test_long_runs_against_all_windows(spark, monkeypatch):
    monkeypatch.setattr(sd, "MARK_ROWS", 3)
    monkeypatch.setattr(sd, "SEGMENT", 5000)
    line = "".join(random.Random(5).choices("abcdefgh ", k=230))
    texts_ = [" " * 20_000, "x" + " " * 9000 + "y", "ab " * 4000, line * 60, line * 3 + " " * 300, "ab " * 50 + "abab" * 90]
    rows = list(enumerate(texts_))
    got = sd.suffix_dedup(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in got} == plain(rows)


def test_a_hot_mark_of_one_document_goes_to_several_tasks(spark):
    candidates = spark.range(50_000).selectExpr("7L AS h", "1L AS doc", "2L AS k2", "id * 200 AS first")
    counts = candidates.groupBy("h").count().withColumnRenamed("count", "n")
    tasks = sd._dealt(candidates, counts).groupBy("h", "salt").count().collect()
    assert max(r["count"] for r in tasks) < 2 * sd.MARK_ROWS


def test_marks_that_are_a_small_share_of_all_are_dealt_too(spark):
    n, rows = 3 * sd.MARK_ROWS, 200
    counts = spark.range(rows).selectExpr("id AS h", f"{n}L AS n").union(spark.range(1).selectExpr("-1L", f"{10**12}L"))
    candidates = spark.range(rows * 30).selectExpr(f"id % {rows} AS h", "id AS doc", "2L AS k2", "id * 200 AS first")
    assert {r.salts for r in sd._dealt(candidates, counts).select("salts").distinct().collect()} == {3}


def test_touching_spans_leave_a_task_as_one():
    n = 500
    rows = pd.DataFrame({"h": 1, "doc": 3, "k2": 4, "first": np.arange(n) * 50, "windows": 1, "mark": 0, "bytes": b"z" * 100, "salts": 1, "salt": 0})
    spans = sd._settle(rows)
    assert spans[["doc", "k2", "start", "end"]].to_numpy().tolist() == [[3, 4, 50, 50 * (n - 1) + 100]]


def test_empty_table(spark):
    assert sd.suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
