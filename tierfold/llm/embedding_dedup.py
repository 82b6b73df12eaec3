"""Near-duplicate embeddings: one small-world graph per shard, every vector asked of every shard.

Equal vectors are one node with a number of copies. Nodes are dealt over shards by hash, and blocks
of nodes are searched for in the graph of each shard. Recall is audited twice. Once per shard, every
node is searched for from a probe, a vector turned away from it as far as a link may be: the beam is
widened while more than a few nodes are not found, and those few are compared with every query. So a
shard is vouched for however rare links are. Then, in every search of a block, vectors drawn from it
are also compared with the whole shard, and the beam is widened while any of them misses a link.
Links are verified in double precision. A task counts the links of each vector and reduces them to a
spanning forest, so pairs within a group never leave it.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, written
from tierfold.llm.components import components, spanning_edges
from tierfold.llm.hnsw import Graph, Layer

LEAST = 0.9
#: At least so many shards; nodes of a shard and of a block of queries; queries searched at once.
MIN_SHARDS, SHARD_ROWS, BLOCK_ROWS, AT_ONCE = 4, 32_768, 16_384, 256
#: First beam; vectors drawn from a block for its audit; share of a shard's nodes that may be strays.
WIDTH, AUDITED, STRAYS = 48, 1024, 0.01
#: Single precision may be off by so much; what it finds is verified.
SLACK = 1e-5


def _units(vectors: pd.Series) -> np.ndarray:
    rows = np.stack(vectors.to_numpy()) if len(vectors) else np.empty((0, 1))
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)  # squares stay finite
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _packed(ids: np.ndarray, copies: np.ndarray, units: np.ndarray, graph: Graph, width: int) -> bytes:
    out = io.BytesIO()
    layers = {f"links{k}": layer.links[layer.nodes] for k, layer in enumerate(graph.layers)}
    nodes = {f"nodes{k}": layer.nodes.astype(np.int32) for k, layer in enumerate(graph.layers)}
    np.savez(out, ids=ids, copies=copies, units=units, entry=graph.entry, width=width, strays=graph.strays, **layers, **nodes)
    return out.getvalue()


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, Graph, int]:
    held = np.load(io.BytesIO(raw))
    units, layers = held["units"], []
    while f"nodes{len(layers)}" in held:
        nodes, links = held[f"nodes{len(layers)}"], held[f"links{len(layers)}"]
        full = np.full((len(units), links.shape[1]), -1, np.int32)
        full[nodes] = links
        layers.append(Layer(full, nodes.astype(np.int64)))
    graph = Graph(units.astype(np.float32), layers, int(held["entry"]), held["strays"])
    return held["ids"], held["copies"], units, graph, int(held["width"])


def _probes(units: np.ndarray, least: float) -> np.ndarray:
    """For each unit vector one in a random direction from it, as far away as a link may be."""
    turn = np.random.default_rng(7).normal(size=units.shape)
    turn -= (turn * units).sum(axis=1, keepdims=True) * units
    turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
    least = min(least + 10 * SLACK, 1.0)
    return (least * units + np.sqrt(1 - least**2) * turn).astype(np.float32)


def _vouched(graph: Graph, least: float) -> tuple[int, np.ndarray]:
    """The beam that finds the nodes of a shard from their probes, and the nodes it does not find."""
    probes, lost, width = _probes(graph.vectors, least), np.arange(len(graph.vectors)), WIDTH
    while True:
        left = []
        for at in range(0, len(lost), AT_ONCE):
            part = lost[at : at + AT_ONCE]
            q, node = graph.within(probes[part], least - SLACK, width)
            left.append(np.delete(part, q[node == part[q]]))
        lost = np.concatenate(left)
        if len(lost) <= STRAYS * len(graph.vectors) or width >= len(graph.vectors):
            return width, lost
        width *= 2


def _build(least: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        units = _units(rows["e"])
        graph = Graph.build(units.astype(np.float32))
        width, graph.strays = _vouched(graph, least - SLACK)
        raw = _packed(rows["id"].to_numpy(), rows["copies"].to_numpy(), units, graph, width)
        return pd.DataFrame({"dim": [key[0]], "shard": [key[1]], "graph": [raw]})

    return run


def _audited_width(graph: Graph, queries: np.ndarray, least: float, width: int = WIDTH) -> int | None:
    """The beam, ``width`` or a wider one, whose search misses no link of any audited query; None:
    no beam does short of the whole shard, so compare with all."""
    n = len(queries)
    order = np.random.default_rng((n, len(graph.vectors))).permutation(n)[:AUDITED]
    for at in range(0, len(order), AT_ONCE):
        drawn = order[at : at + AT_ONCE]
        exact = queries[drawn] @ graph.vectors.T >= least + SLACK / 2  # rounding may part the two below that
        while width < len(graph.vectors):
            missed = exact.copy()
            missed[graph.within(queries[drawn], least, width)] = False
            if not missed.any():
                break
            width *= 2
    return width if width < len(graph.vectors) else None


def _search(least: float):
    def run(key: tuple, graphs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "links", "a", "b"]
        if not len(graphs) or not len(rows):
            return pd.DataFrame(columns=columns, dtype="Int64")
        ids, copies, units, graph, width = _unpacked(graphs["graph"].iloc[0])
        own, queries = rows["id"].to_numpy(), _units(rows["e"])
        single = queries.astype(np.float32)
        width = _audited_width(graph, single, least - SLACK, width)
        links = np.zeros(len(own), np.int64)
        a, b = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(own), AT_ONCE):
            part = single[at : at + AT_ONCE]
            if width is None:
                q, node = np.nonzero(part @ graph.vectors.T >= least - SLACK)
            else:
                q, node = graph.within(part, least - SLACK, width)
            q = q + at
            linked = (own[q] != ids[node]) & (np.einsum("pd,pd->p", queries[q], units[node]) >= least)
            q, node = q[linked], node[linked]
            links += np.bincount(q, copies[node], minlength=len(own)).astype(np.int64)
            a, b = spanning_edges(np.concatenate([a, own[q]]), np.concatenate([b, ids[node]]))
        some = links > 0
        counted = pd.DataFrame({"id": own[some], "links": links[some]}, dtype="Int64")
        edges = pd.DataFrame({"a": a, "b": b}, dtype="Int64")
        return pd.concat([counted.reindex(columns=columns), edges.reindex(columns=columns)]).astype("Int64")

    return run


def embedding_dedup(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding).

    Vectors link if their cosine is ``least`` or more. A vector that is null, empty, zero or holds
    nulls or numbers that are not finite links with nothing, nor do vectors of different length.
    n_links counts the other rows that a row is linked with, copies included; the component is the
    smallest vec_id that links reach, null ids passed over; the row that has it is kept. Repeated
    rows are copies of each other. An empty table gives an empty result.
    """
    e = name_of("embedding").cast("array<double>")
    rows = vectors.select(name_of("vec_id").cast("long").alias("vec_id"), e.alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("e", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("e", F.when(usable, F.col("e")))
    nodes = rows.where("e IS NOT NULL").groupBy("e").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = nodes.select(F.monotonically_increasing_id().alias("id"), "e", F.size("e").alias("dim"), "first", "copies")
    nodes = written(nodes, "vectors")
    n = nodes.count()
    shards, blocks = max(MIN_SHARDS, -(-n // SHARD_ROWS)), max(1, -(-n // BLOCK_ROWS))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard")
    built = nodes.select("dim", shard, "id", "e", "copies").groupBy("dim", "shard")
    graphs = written(built.applyInPandas(_build(least), "dim INT, shard LONG, graph BINARY"), "graphs")
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    asked = graphs.select("dim", "shard", every(blocks).alias("block"), "graph")
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks)).alias("block")
    queries = nodes.select("dim", block, "id", "e", every(shards).alias("shard"))
    by = ["dim", "shard", "block"]
    found = asked.groupBy(*by).cogroup(queries.groupBy(*by)).applyInPandas(_search(least), "id LONG, links LONG, a LONG, b LONG")
    found = written(found, "links")
    links = found.where("id IS NOT NULL").groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.where("a IS NOT NULL").select("a", "b"))
    of = nodes.join(links, "id", "left").join(groups, "id", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    of = written(of.select("e", "first", n_links.alias("n_links"), F.coalesce("component", "id").alias("component")), "vector-groups")
    least_id = written(of.groupBy("component").agg(F.min("first").alias("component_id")), "vector-group-ids")
    of = of.join(least_id, "component").select("e", "n_links", "component_id", F.lit(True).alias("usable"))
    joined = rows.join(of, "e", "left")
    component = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    out = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
