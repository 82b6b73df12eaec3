"""Hierarchical navigable small-world graphs over unit vectors, built and searched in blocks.

A node lives on the layers up to a random level, so that each layer holds about one in DEGREE of the
nodes below it. Nodes are inserted in blocks that at most double a layer; a block is searched for at
once, and its neighbours are chosen by the usual rule that a neighbour must be closer to the node
than to any neighbour chosen before, and filled up with the nearest of the others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE, BUILD_BEAM, BLOCK, STEP = 12, 40, 512, 6


@dataclass
class Layer:
    """links: the neighbours of each node of the shard, -1 where there is none."""

    links: np.ndarray
    nodes: np.ndarray


def _chosen(near: np.ndarray, ids: np.ndarray, vectors: np.ndarray, degree: int) -> np.ndarray:
    """Of candidates in descending similarity ``near``, -1 where there is none, up to ``degree``."""
    points = vectors[np.maximum(ids, 0)]
    between = np.matmul(points, points.transpose(0, 2, 1))
    taken = np.zeros(ids.shape, bool)
    for k in range(ids.shape[1]):
        far = ~((between[:, k, :] > near[:, k, None]) & taken).any(axis=1)
        taken[:, k] = far & (ids[:, k] >= 0) & (taken.sum(axis=1) < degree)
    rest = (ids >= 0) & ~taken
    rank = np.argsort(np.where(taken, 0, np.where(rest, 1, 2)), axis=1, kind="stable")[:, :degree]
    return np.take_along_axis(np.where(ids >= 0, ids, -1), rank, axis=1)


def _ordered(near: np.ndarray, ids: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest of each row without repeats, in descending similarity."""
    by = np.argsort(ids, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, by, 1), np.take_along_axis(near, by, 1)
    near = np.where((ids < 0) | (np.diff(ids, axis=1, prepend=-2) == 0), -np.inf, near)
    by = np.argsort(-near, axis=1, kind="stable")[:, :width]
    ids, near = np.take_along_axis(ids, by, 1), np.take_along_axis(near, by, 1)
    return near, np.where(near == -np.inf, -1, ids)


class Graph:
    """The graph of one shard. ``strays``: nodes that searches do not reach, so that :meth:`within`
    compares them with every query."""

    def __init__(self, vectors: np.ndarray, layers: list[Layer], entry: int, strays: np.ndarray | None = None):
        self.vectors, self.layers, self.entry = vectors, layers, entry
        self.strays = np.empty(0, np.int64) if strays is None else strays

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1) -> Graph:
        """``vectors``: unit vectors as float32."""
        n = len(vectors)
        levels = (-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int)
        order = np.argsort(-levels, kind="stable") if n else np.empty(0, int)
        entry = int(order[0]) if n else -1
        layers = [
            Layer(np.full((n, 2 * DEGREE if k == 0 else DEGREE), -1, np.int32), np.empty(0, np.int64))
            for k in range(int(levels.max(initial=0)) + 1)
        ]
        graph = cls(vectors, layers, entry)
        at = 0
        while at < n:
            block = order[at : at + min(BLOCK, max(32, at))]
            graph._insert(block, levels[block])
            at += len(block)
        return graph

    def _insert(self, block: np.ndarray, levels: np.ndarray) -> None:
        queries = self.vectors[block]
        ids = np.full((len(block), 1), self.entry)
        for k in range(len(self.layers) - 1, -1, -1):
            layer, member = self.layers[k], levels >= k
            if len(layer.nodes):
                near, ids = self.beam(queries, ids, k, BUILD_BEAM)
            else:
                ids = np.full((len(block), 1), -1)
                near = np.full(ids.shape, -np.inf, np.float32)
            new = block[member]
            if not len(new):
                continue
            among = queries[member] @ self.vectors[new].T
            np.fill_diagonal(among, -np.inf)
            own = np.where(np.eye(len(new), dtype=bool), -1, new[None, :])
            near_, ids_ = np.hstack([near[member], among]), np.hstack([ids[member], own])
            near_, ids_ = _ordered(near_, ids_, BUILD_BEAM)
            picked = _chosen(near_, ids_, self.vectors, DEGREE)
            layer.links[new, : picked.shape[1]] = picked
            layer.nodes = np.concatenate([layer.nodes, new])
            self._link_back(layer, new, picked)
            if ids.shape[1] == 1 and (ids < 0).all():
                ids = np.full((len(block), 1), self.entry)

    def _link_back(self, layer: Layer, new: np.ndarray, picked: np.ndarray) -> None:
        """Links from the chosen neighbours to the new nodes; the nearest DEGREE of them for each."""
        i, j = np.nonzero(picked >= 0)
        target, source = picked[i, j], new[i]
        near = np.einsum("pd,pd->p", self.vectors[target], self.vectors[source])
        order = np.lexsort((-near, target))
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        row = np.repeat(np.arange(len(nodes)), count)
        column = np.arange(len(row)) - first[row]
        held = column < DEGREE
        extra = np.full((len(nodes), DEGREE), -1)
        extra[row[held], column[held]] = source[held]
        width = layer.links.shape[1]
        degree = (layer.links[nodes] >= 0).sum(axis=1)
        fits = degree + (extra >= 0).sum(axis=1) <= width
        r, c = np.nonzero((extra >= 0) & fits[:, None])
        layer.links[nodes[r], degree[r] + c] = extra[r, c]
        over = np.flatnonzero(~fits)
        for at in range(0, len(over), BLOCK):
            part = nodes[over[at : at + BLOCK]]
            ids = np.hstack([layer.links[part], extra[over[at : at + BLOCK]]])
            near = np.einsum("bkd,bd->bk", self.vectors[np.maximum(ids, 0)], self.vectors[part])
            near, ids = _ordered(near, ids, ids.shape[1])
            kept = _chosen(near, ids, self.vectors, width)
            layer.links[part] = -1
            layer.links[part, : kept.shape[1]] = kept

    def beam(self, queries: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, node) of a beam search on one layer from the nodes ``start`` (-1: none)."""
        links, n = self.layers[layer].links, len(self.vectors)
        near = np.einsum("bkd,bd->bk", self.vectors[np.maximum(start, 0)], queries)
        near, ids = _ordered(near, start, width)
        lacking = ((0, 0), (0, width - near.shape[1]))
        near = np.pad(near, lacking, constant_values=-np.inf)
        ids = np.pad(ids, lacking, constant_values=-1)
        seen = np.zeros(len(queries) * n, bool)
        i, j = np.nonzero(ids >= 0)
        seen[i * n + ids[i, j]] = True
        open_ = ids >= 0
        active = np.arange(len(queries))
        while len(active):
            o = open_[active]
            i, j = np.nonzero(o & (np.cumsum(o, axis=1) <= STEP))  # beams are in descending order
            open_[active[i], j] = False
            found = links[ids[active[i], j]]
            i = np.repeat(i, links.shape[1])[found.ravel() >= 0]
            pair = active[i] * n + found.ravel()[found.ravel() >= 0]
            fresh = ~seen[pair]
            pair, at = np.unique(pair[fresh], return_index=True)
            i, node = i[fresh][at], pair % n
            seen[pair] = True
            value = np.einsum("pd,pd->p", self.vectors[node], queries[active[i]])
            # pairs are in the order of i: their places in its row
            count = np.bincount(i, minlength=len(active))
            place = np.arange(len(i)) - (np.cumsum(count) - count)[i]
            new_near = np.full((len(active), int(count.max(initial=0))), -np.inf, np.float32)
            new_ids = np.full(new_near.shape, -1)
            new_near[i, place], new_ids[i, place] = value, node
            all_near, all_ids = np.hstack([near[active], new_near]), np.hstack([ids[active], new_ids])
            all_open = np.hstack([open_[active], new_ids >= 0])
            top = np.argsort(-all_near, axis=1)[:, :width]
            near[active] = np.take_along_axis(all_near, top, 1)
            ids[active] = np.take_along_axis(all_ids, top, 1)
            open_[active] = np.take_along_axis(all_open, top, 1)
            active = active[open_[active].any(axis=1)]
        return near, ids

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(similarity, node) of the ``width`` nearest nodes found for each query."""
        if not len(self.vectors):
            return np.empty((len(queries), 0), np.float32), np.empty((len(queries), 0), int)
        ids = np.full((len(queries), 1), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            near, ids = self.beam(queries, ids, k, 4)
        return self.beam(queries, ids, 0, width)

    def within(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of all pairs found with a similarity of ``least`` or more.

        Where a whole beam is that similar, the beams of these queries become one pool that widens
        over links until no node that is similar to one of them is left beside it.
        """
        near, ids = self.search(queries, width)
        if not near.size:
            return np.empty(0, int), np.empty(0, int)
        full = near[:, -1] >= least
        q, k = np.nonzero((near >= least) & ~full[:, None])
        out_q, out_n = [q], [ids[q, k]]
        wide = np.flatnonzero(full)
        pool = np.unique(ids[wide]) if len(wide) else np.empty(0, int)
        inside = np.zeros(len(self.vectors), bool)
        while len(pool):
            inside[pool] = True
            near_pool = queries[wide] @ self.vectors[pool].T
            i, j = np.nonzero(near_pool >= least)
            out_q.append(wide[i])
            out_n.append(pool[j])
            links = self.layers[0].links[pool[np.unique(j)]].ravel()
            links = np.unique(links[links >= 0])
            pool = links[~inside[links]]
        if len(self.strays):
            i, j = np.nonzero(queries @ self.vectors[self.strays].T >= least)
            out_q.append(i)
            out_n.append(self.strays[j])
        pairs = np.unique(np.concatenate(out_q) * len(self.vectors) + np.concatenate(out_n))
        return pairs // len(self.vectors), pairs % len(self.vectors)
