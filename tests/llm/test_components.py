"""Components against a plain search."""

import random

import numpy as np

from tierfold.llm.components import components, spanning_edges


def plain(edges):
    near = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = {}
    for i in sorted(near):
        open_ = [i]
        while open_:
            x = open_.pop()
            if x not in out:
                out[x] = i
                open_ += near[x]
    return out


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 300)]
    star = [(5000, 5000 + i) for i in range(1, 400)]
    some = [(rng.randrange(-60, 60), rng.randrange(-60, 60)) for _ in range(40)]
    edges = chain + star + some + [(None, 1), (1, None), (9999, 9999), *chain[:5]]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()
    assert {r.id: r.component for r in got} == plain(edges) and len(got) == len(plain(edges))
    assert components(spark.createDataFrame([], "a LONG, b LONG")).collect() == []


def test_spanning_edges_connect_the_same():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    x, y = spanning_edges(a, b)
    assert plain(zip(x.tolist(), y.tolist())) == plain(zip(a.tolist(), b.tolist()))
    assert len(x) == len(set(plain(zip(a.tolist(), b.tolist())))) - len(set(plain(zip(a.tolist(), b.tolist())).values()))
