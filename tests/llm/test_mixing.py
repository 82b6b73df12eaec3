"""Targets and cuts against plain Python."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from tierfold.llm.mixing import mix, mixed_documents, source_targets

SCHEMA = "doc_id LONG, text STRING, source STRING, size STRING, n_chars LONG"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        weights = sum(weight[f] for f in free)
        share = {s: left * weight[s] / weights for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def make():
    rng = random.Random(6)
    rows = []
    for i in range(400):
        source = rng.choice(["big"] * 14 + ["a", "é", "small", None, "Z", ""])
        text = rng.choice([None, "", " \n"]) if rng.random() < 0.05 else "  ".join(f"w{k}" for k in range(rng.randrange(1, 60)))
        rows.append((i, text, source, "s", 0))
    rows.append((1000, "word\n" * 30_000, "huge", "s", 0))
    return rows + [(2000, None, "none", "s", 0)]


def test_targets_and_cuts(spark):
    rows = make()
    got = mix(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    sizes = defaultdict(int)
    for _, text, source, _, _ in rows:
        sizes[source] += n_words(text)
    targets = plain_targets(sizes)
    assert {r.source: r.source_size for r in got} == dict(sizes)
    for r in got:
        assert r.target == pytest.approx(targets[r.source], rel=1e-12)
        assert r.size == n_words(r.text) and 0 <= r.taken <= 3 * r.size
    for source, target in targets.items():
        docs = sorted((hashlib.md5(str(r.doc_id).encode()).hexdigest(), r) for r in got if r.source == source)
        assert sum(r.taken for _, r in docs) == int(target + 1e-6)
        epochs = int(target + 1e-6) // sizes[source] if sizes[source] else 0
        extra = [r.taken - epochs * r.size for _, r in docs if r.size]
        full = [e == r.size for e, (_, r) in zip(extra, [d for d in docs if d[1].size], strict=True)]
        assert full == sorted(full, reverse=True) and sum(0 < e and not f for e, f in zip(extra, full, strict=True)) <= 1


def test_targets_of_very_many_sources(spark):
    """More than 100,000 of them: no step holds all, and none is refused."""
    n = 120_000
    size = lambda i: i * 7919 % 1000 + (i % 1000 == 0) * 400_000
    sizes = spark.range(n).selectExpr("CASE WHEN id > 0 THEN format_string('s%06d', id) END AS source", "id")
    sizes = sizes.selectExpr("source", "id * 7919 % 1000 + IF(id % 1000 = 0, 400000, 0) AS source_size")
    got = {r.source: r.target for r in source_targets(sizes).collect()}
    of = {(f"s{i:06d}" if i else None): size(i) for i in range(n)}
    targets = plain_targets(of)
    assert got.keys() == targets.keys()
    assert all(abs(got[s] - t) <= 1e-9 * max(1, t) for s, t in targets.items())
    assert 0 < sum(t == 3 * of[s] for s, t in got.items()) < n


def test_reruns_agree(spark):
    df = spark.createDataFrame(make(), SCHEMA)
    runs = [sorted((r.doc_id, r.taken) for r in mix(d).collect()) for d in (df, df.repartition(7).orderBy("text"))]
    assert runs[0] == runs[1]


def test_the_mix_itself(spark):
    rows = make()
    df = spark.createDataFrame(rows, SCHEMA)
    taken = {r.doc_id: (r.taken, r.size) for r in mix(df).collect()}
    copies = defaultdict(list)
    out = mixed_documents(df)
    assert out.columns == df.columns
    texts = {i: t for i, t, *_ in rows}
    for r in out.collect():
        copies[r.doc_id].append(r.text)
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    for i, (n, size) in taken.items():
        assert sorted(map(n_words, copies[i])) == sorted([size] * (n // size) + [n % size] * (n % size > 0) if size else [])


def test_one_source_repeats_and_no_rows(spark):
    rows = [(None, "a b c", None, "s", 0)] * 3 + [(None, "d", None, "s", 0)]
    assert sum(r.taken for r in mix(spark.createDataFrame(rows, SCHEMA)).collect()) == 10
    empty = spark.createDataFrame([], SCHEMA)
    assert mix(empty).collect() == [] and mixed_documents(empty).collect() == []
