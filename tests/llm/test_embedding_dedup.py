"""Links and groups against all pairs in double precision."""

import numpy as np
import pytest

from tierfold.llm import embedding_dedup as ed
from tierfold.llm.embedding_dedup import embedding_dedup
from tierfold.llm.hnsw import Graph

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, e INT, first STRING"


def plain(rows):
    """{vec_id: (links, component)} over all pairs."""
    usable = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(usable)
    linked = {i: [] for i, _ in rows}
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = usable[i], usable[j]
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.9:
                linked[i].append(j)
                linked[j].append(i)
    component = {}
    for i in sorted(linked):
        open_ = [i]
        while open_:
            x = open_.pop()
            if x not in component:
                component[x] = i
                open_ += linked[x]
    return {i: (len(linked[i]), component[i]) for i in linked}


def make(seed=0, n=400, dim=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(n // 4, dim))
    near = np.concatenate([c + 0.25 * rng.normal(size=(3, dim)) for c in centers])
    dense = rng.normal(size=dim) + 0.05 * rng.normal(size=(120, dim))
    vectors = [*centers, *near, *dense, *centers[:20], *(3 * centers[20:30])]
    rows = [[float(np.float32(x)) for x in v] for v in vectors]
    odd = [None, [], [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [None] * dim, [1.0], [2.0], [-0.0] * dim]
    return [(7 * i % 10_007, v) for i, v in enumerate(rows + odd)]


def test_against_all_pairs(spark):
    rows = make()
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup(df).collect()}
    assert got == plain(rows)


def test_kept_ties_and_null_ids(spark):
    rows = [(None, [1.0, 0.0]), (5, [1.0, 0.01]), (5, [1.0, 0.0]), (None, [0.0, 1.0]), (2, [-1.0, 0.0]), (None, None)]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup(df).collect()))
    assert got == [(0, 0, 0, True), (0, 0, 0, True), (0, 2, 5, False), (2, 0, 2, True), (5, 2, 5, True), (5, 2, 5, True)]


def test_graph_finds_neighbours():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24))
    x[1500:] = x[:1500] + 0.1 * rng.normal(size=(1500, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = Graph.build(x)
    exact = int((x @ x.T >= 0.9).sum())
    assert len(graph.within(x[:3000], 0.9, 48)[0]) > 0.98 * exact


def clustered(hot, pairs, dim=24, seed=3):
    """Unit vectors: one cluster of ``hot`` and ``pairs`` pairs of near ones, in any order."""
    rng = np.random.default_rng(seed)
    one = rng.normal(size=(pairs, dim))
    x = np.concatenate([rng.normal(size=dim) + 0.02 * rng.normal(size=(hot, dim)), one, one + 0.05 * rng.normal(size=one.shape)])
    x = rng.permutation(x / np.linalg.norm(x, axis=1, keepdims=True))
    return x.astype(np.float32)


class Lossy:
    """A graph that finds all links of hot queries, and none but themselves of the others."""

    def __init__(self, vectors):
        self.vectors = vectors

    def within(self, queries, least, width):
        near = queries @ self.vectors.T
        found = near >= least
        return np.nonzero(found & ((found.sum(axis=1) > 100)[:, None] | (near > 0.99999)))


@pytest.mark.parametrize("hot", [0, 2000])
def test_a_hot_cluster_hides_no_loss(hot):
    x = clustered(hot, 1000)
    assert ed._audited_width(Lossy(x), x, 0.9) is None


def test_a_graph_that_misses_nothing_passes():
    x = clustered(300, 1000)
    width = ed._audited_width(Graph.build(x), x, 0.9)
    assert width is not None and width < len(x)


def test_strays_are_compared_with_every_query():
    """Nodes that no search reaches are told by their probes and found all the same."""
    x = clustered(0, 1500)
    graph = Graph.build(x)
    cut = np.arange(0, len(x), 150)
    for layer in graph.layers:
        layer.links[np.isin(layer.links, cut)] = -1
    cut = np.setdiff1d(cut, [graph.entry])
    width, graph.strays = ed._vouched(graph, 0.9)
    assert width < len(x) and set(cut) <= set(graph.strays) and len(graph.strays) <= 0.01 * len(x)
    q, node = graph.within(x, 0.9, width)
    exact = set(zip(*np.nonzero(x @ x.T >= 0.9), strict=True))
    assert len(exact & set(zip(q, node, strict=True))) > 0.999 * len(exact)


def few_links(n=20_000, dim=32):
    """``n`` vectors of which a tenth is in pairs."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, dim))
    x[: n // 20] = x[n // 20 : n // 10] + 0.2 * rng.normal(size=(n // 20, dim))
    return rng.permutation(x)


def test_the_graph_answers_where_links_are_rare(spark):
    """In every shard the audits let the graph answer; the operator finds the links of all pairs."""
    x = few_links()
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    single = units.astype(np.float32)
    for shard in np.array_split(single, ed.MIN_SHARDS):
        graph = Graph.build(shard)
        width, graph.strays = ed._vouched(graph, 0.9)
        assert (ed._audited_width(graph, single[: ed.BLOCK_ROWS], 0.9, width) or len(shard)) < len(shard) / 4
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id LONG, embedding ARRAY<DOUBLE>")
    got = {r.vec_id: r.n_links for r in embedding_dedup(df).collect()}
    exact = np.concatenate([(units[at : at + 1000] @ units.T >= 0.9).sum(axis=1) - 1 for at in range(0, len(x), 1000)])
    assert exact.sum() > 1500 and all(got[i] <= n for i, n in enumerate(exact))
    assert sum(got.values()) >= 0.999 * exact.sum()


def test_empty_table(spark):
    assert embedding_dedup(spark.createDataFrame([], SCHEMA)).collect() == []
