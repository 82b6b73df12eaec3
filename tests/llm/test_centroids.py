"""Clusters against plain loops over all centroids."""

import hashlib
import math
import random

import numpy as np

from tierfold.llm.centroids import VantageTree, centroid_clusters

SCHEMA = "vec_id LONG, embedding ARRAY<DOUBLE>, cluster INT, e STRING"


def brute(rows, k=40, rounds=5, components=64):
    fine = lambda e: e is not None and len(e) == components and all(x is not None and math.isfinite(x) and abs(x) < 2**19 for x in e)
    kept = [(v, [math.floor(256 * x) for x in e]) for v, e in rows if fine(e)]
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    order = lambda r: (r[0] is None, digest(f"2:{r[0]}"), r[1])
    centroids = [e for _, e in sorted(kept, key=order)[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(e, c)), i) for i, c in enumerate(centroids)) for _, e in kept]

    for _ in range(rounds):
        groups = {}
        for (_, c), (_, e) in zip(assign(), kept):
            groups.setdefault(c, []).append(e)
        for c, held in groups.items():
            centroids[c] = [sum(x) // len(held) for x in zip(*held)]
    found = assign()
    of = {c: sum(d for d, c2 in found if c2 == c) for _, c in found}
    text = [digest(",".join(map(str, c))) for c in centroids]
    return sorted(
        ((v, c, d, of[c], sum(of.values()), text[c]) for (v, _), (d, c) in zip(kept, found)), key=str
    )


def answered(spark, rows, **settings):
    df = spark.createDataFrame([(v, e, 5, "x") for v, e in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, centroid_clusters(df, **settings).collect()), key=str)


def test_tree_finds_the_nearest():
    rng = np.random.default_rng(3)
    for n, dims, size in ((1, 3, 5), (4, 2, 2), (40, 64, 300), (200, 2, 6), (37, 1, 1 << 27), (90, 5, 3)):
        centroids = rng.integers(-size, size + 1, (n, dims))
        vectors = np.concatenate([rng.integers(-size, size + 1, (800, dims)), centroids])
        exact = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        number, distance = VantageTree.build(centroids).nearest(vectors)
        assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()


def test_tree_leaves_far_nodes_shut():
    centroids = np.arange(0, 4000, 100)[:, None]
    tree, opened = VantageTree.build(centroids), []
    members = tree.members
    tree.members = type("Counted", (), {"__getitem__": lambda _, k: opened.append(k) or members[k], "__len__": lambda _: len(members)})()
    tree.nearest(np.array([[1234]]))
    assert len(opened) < len(members) / 2


def test_equal_to_plain_loops(spark):
    rng = random.Random(7)
    rows = [(v * 3 - 50, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)]) for v in range(300)]
    rows += rows[:20] + [(v, [0.25] * 4) for v in range(1000, 1150)]  # repeated rows, a hot vector, ties
    assert answered(spark, rows, clusters=7, rounds=3, components=4) == brute(rows, 7, 3, 4)
    assert answered(spark, rows, clusters=30, rounds=0, components=4) == brute(rows, 30, 0, 4)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (7, [2.0**19, 0.0])]
    assert answered(spark, rows, components=2) == [] == answered(spark, [], components=2)
    rows += [(8, [-524287.9, 524287.9]), (None, [1.0, 2.0]), (None, [0.0, 2.0]), (2**60 + 1, [1.0, 2.0]), (8, [1.0, -1.0])]
    got = answered(spark, rows, components=2, rounds=2)
    assert got == brute(rows, components=2, rounds=2) and len(got) == 5
    assert answered(spark, rows, components=2, clusters=2, rounds=3) == brute(rows, 2, 3, 2)
