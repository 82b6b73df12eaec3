"""Held-out accuracy, the parts of the fit against plain numpy, and odd inputs."""

import random
import zlib

import numpy as np
import pytest

from tierfold.llm import quality_classifier as qc

SCHEMA = "doc_id LONG, text STRING, lang STRING, score INT"


def make(n, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        words = [rng.choice(["the", "house", "stands", "near", "water", "and", "people"]) for _ in range(rng.randrange(20, 90))]
        text = " ".join(w if good or rng.random() < 0.6 else w + "###" for w in words) + "."
        docs.append((i, text, "en", 0))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = make(500)
    odd = [(1000, "", None, 0), (1001, None, None, 0), (None, "a text", None, 0), (1002, "x " * 60_000, None, 0)]
    more = [(None, 1, 0), (4, None, 0), (77777, 0, 1)]
    df = spark.createDataFrame(docs + odd + docs[:2], SCHEMA)
    got = qc.quality_scores(df, spark.createDataFrame(labels + more, "doc_id LONG, quality INT, toxic INT")).collect()
    assert len(got) == len(docs) + len(odd) + 2
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    known = dict((i, q) for i, q, _ in labels)
    tested = [(r.score, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    assert np.mean([(s >= 0.5) == q for s, q in tested]) > 0.97


def test_held_out_labels_are_not_used(spark):
    docs, labels = make(200)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, 0) for i, q, _ in labels]
    df = spark.createDataFrame(docs, SCHEMA)
    scores = []
    for known in (labels, turned):
        found = qc.quality_scores(df, spark.createDataFrame(known, "doc_id LONG, quality INT, toxic INT"))
        scores.append({r.doc_id: round(r.score, 9) for r in found.collect()})
    assert scores[0] == scores[1]


def test_normal_equations_are_sums(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 3))
    rows = [(int(i % qc.FOLDS), float(i % 2), *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "fold INT, label DOUBLE, a DOUBLE, b DOUBLE, c DOUBLE").repartition(7)
    kernel = qc.fit_kernel(df, ["a", "b", "c"], features=5)
    sums = qc._normal_equations(df, ["a", "b", "c"], kernel)
    z = kernel.features(x)
    y = np.array([r[1] for r in rows])
    assert np.allclose(sums.sum(axis=0), np.hstack([z.T @ z, (z.T @ y)[:, None]]))


def test_isotonic_rises_and_fits():
    scores = np.arange(6.0)
    fitted = qc.isotonic(scores, np.array([0, 30, 10, 50, 90, 100.0]), np.full(6, 100.0))
    out = fitted(scores)
    assert (np.diff(out) >= 0).all() and out[1] == pytest.approx(out[2], abs=1e-3) == pytest.approx(0.2, abs=0.01)


def test_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    df = spark.createDataFrame(make(5)[0], SCHEMA)
    assert {r.score for r in qc.quality_scores(df, none).collect()} == {0.5}
    assert qc.quality_scores(df.limit(0), none).collect() == []
    one_class = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id LONG, quality INT, toxic INT")
    assert all(r.score >= 0.5 for r in qc.quality_scores(df, one_class).collect())
