"""Clusters of vectors around centroids of whole numbers, found through a vantage-point tree.

Each round builds a vantage-point tree over the centroids on the driver and broadcasts it; both have
the size of the centroids. Tasks search it for all vectors of an Arrow batch side by side: every
vector opens the nodes in the order of its own lower bounds and stops when none is within its radius,
the distance of the best centroid so far. Distances at the nodes and leaves are exact, and nodes at
the radius itself are opened, as they may hold an equally near centroid of smaller number. A task
returns the sums of its vectors per centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierfold.llm.common import name_of, written

CLUSTERS, ROUNDS, COMPONENTS, SEED = 40, 5, 64, "2:"
#: Centroids that a leaf holds at most; vectors that are searched for side by side.
LEAF, AT_ONCE = 4, 4096
#: Lower bounds are differences of roots in double precision; they are taken to be off by so much
#: of the distances they come from.
ROUNDING = 1e-12


@dataclass
class VantageTree:
    """Nodes in the order they were made. A node holds centroids by number: its vantage point alone,
    or those of a leaf. ``children`` are (node, least, largest distance of its centroids from the
    vantage point)."""

    centroids: np.ndarray
    members: list[np.ndarray] = field(default_factory=list)
    children: list[list[tuple[int, float, float]]] = field(default_factory=list)

    @classmethod
    def build(cls, centroids: np.ndarray) -> VantageTree:
        tree = cls(centroids)
        tree._add(np.arange(len(centroids)))
        return tree

    def _add(self, numbers: np.ndarray) -> int:
        node = len(self.members)
        leaf = len(numbers) <= LEAF
        self.members.append(numbers if leaf else numbers[:1])
        self.children.append([])
        if not leaf:
            rest = numbers[1:]
            away = np.sqrt(squared(self.centroids[rest], self.centroids[numbers[0]]).astype(np.float64))
            order = np.argsort(away, kind="stable")
            for half in np.array_split(order, 2):  # the nearer and the farther half
                child = self._add(np.sort(rest[half]))
                self.children[node].append((child, float(away[half].min()), float(away[half].max())))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of and exact squared distance to each vector's nearest centroid, of equally near
        ones the smallest number."""
        n = len(vectors)
        best, at = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.centroids))
        bounds = np.full((n, len(self.members)), np.inf)
        bounds[:, 0] = 0
        searching = np.arange(n)
        while len(searching):
            node = bounds[searching].argmin(axis=1)
            least = bounds[searching, node]
            open_ = least <= np.sqrt(best[searching].astype(np.float64)) * (1 + ROUNDING)  # inclusive
            searching, node = searching[open_], node[open_]
            for k in np.unique(node):
                rows = searching[node == k]
                parent = bounds[rows, k]
                bounds[rows, k] = np.inf
                own = vectors[rows]
                for number in self.members[k]:
                    distance = squared(own, self.centroids[number])
                    better = (distance < best[rows]) | (distance == best[rows]) & (number < at[rows])
                    best[rows[better]], at[rows[better]] = distance[better], number
                away = np.sqrt(distance.astype(np.float64)) if self.children[k] else None
                for child, low, high in self.children[k]:
                    bound = np.maximum(away - high, low - away) - ROUNDING * (away + high)
                    bounds[rows, child] = np.maximum(parent, bound)
        return at, best


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def _batches(batches: Iterator[pa.RecordBatch], components: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(start, AT_ONCE)
            values = part.column("e").flatten().to_numpy(zero_copy_only=False)
            yield part, values.reshape(part.num_rows, components)


def _sums(tree, k: int, components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, components), np.int64), np.zeros(k, np.int64)
        for _, vectors in _batches(batches, components):
            cluster, _ = tree.value.nearest(vectors)
            counts += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(vectors[order], starts)
        held = np.flatnonzero(counts)
        if len(held):
            yield pa.RecordBatch.from_pydict(
                {"cluster": pa.array(held, pa.int32()), "n": counts[held], "sums": pa.array(sums[held].tolist(), pa.list_(pa.int64()))}
            )

    return run


def _assigned(tree, components: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, vectors in _batches(batches, components):
            cluster, distance = tree.value.nearest(vectors)
            yield pa.RecordBatch.from_pydict(
                {"vec_id": part.column("vec_id"), "cluster": pa.array(cluster, pa.int32()), "distance": distance}
            )

    return run


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floored means of their vectors. What comes to the driver
    is a sum per centroid and component."""
    k, components = centroids.shape
    tree = vectors.sparkSession.sparkContext.broadcast(VantageTree.build(centroids))
    sums = vectors.mapInArrow(_sums(tree, k, components), "cluster INT, n LONG, sums ARRAY<LONG>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    each = sums.select("cluster", "n", F.posexplode("sums").alias("component", "x"))
    means = centroids.copy()
    for cluster, component, x, n in each.groupBy("cluster", "component").agg(exact("x"), exact("n")).collect():
        means[cluster, component] = int(x) // int(n)
    tree.destroy()
    return means


def centroid_clusters(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, seed: str = SEED
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each kept row of
    ``vectors`` (vec_id, embedding).

    Kept are vectors of ``components`` components, none of them null, not finite or 2^19 and more in
    size, of which distances might not fit a long. A component x counts as floor(256 x). The first
    centroids are the vectors with the smallest SHA-256 of seed and vec_id, null ids last, those of
    equal ids in order of their components; there are as many as vectors if these are fewer. Each of
    ``rounds`` rounds assigns all vectors to the nearest centroid, of equally near ones the smallest
    number, and moves the centroids to the floored means; those without vectors stay. ``distance`` is
    squared, the inertias are its sums over a cluster and over all, null where a long cannot hold
    them. Repeated rows are vectors of their own; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    e = name_of("embedding").cast("array<double>")
    usable = (F.size(e) == components) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**19))
    scaled = F.transform(e, lambda x: F.floor(F.lit(256.0) * x))
    rows = vectors.select(name_of("vec_id").cast("long").alias("vec_id"), F.when(usable, scaled).alias("e"))
    rows = written(rows.where("e IS NOT NULL"), "cluster-vectors")
    drawn = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    start = rows.orderBy(drawn.asc_nulls_last(), "vec_id", "e").limit(clusters).select("e").collect()
    centroids = np.array([r.e for r in start], np.int64).reshape(len(start), components)
    for _ in range(rounds if len(start) else 0):
        centroids = _moved(rows, centroids)
    tree = spark.sparkContext.broadcast(VantageTree.build(centroids))
    found = written(rows.mapInArrow(_assigned(tree, components), "vec_id LONG, cluster INT, distance LONG"), "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()  # a row per cluster
    fits = lambda x: int(x) if x < 1 << 63 else None
    total = fits(sum(x for _, x in sums))
    digest = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    each = [(c, fits(x), total, digest(c)) for c, x in sums]
    schema = "cluster INT, cluster_inertia LONG, inertia LONG, centroid_sha256 STRING"
    return found.join(F.broadcast(spark.createDataFrame(each, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def clusters_sql(clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS, seed: str = SEED) -> str:
    """The same in SQL: every round compares all components of all vectors and centroids."""
    near = """a{k} AS MATERIALIZED (
  SELECT r, c AS cluster, distance FROM (
    SELECT r, c, sum((v.x - m.x) * (v.x - m.x)) AS distance FROM v JOIN c{k} m USING (i) GROUP BY r, c)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, c) = 1
)"""
    moved = """c{next} AS MATERIALIZED (
  SELECT c, i, COALESCE((s - ((s % n) + n) % n) // n, m.x) AS x
  FROM c{k} m LEFT JOIN (
    SELECT cluster AS c, i, sum(x) AS s, CAST(count(*) AS HUGEINT) AS n FROM a{k} JOIN v USING (r) GROUP BY ALL
  ) USING (c, i)
)"""
    steps = [near.format(k=0)]
    for k in range(rounds):
        steps += [moved.format(k=k, next=k + 1), near.format(k=k + 1)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = {components} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), v AS MATERIALIZED (
  SELECT r, unnest(e)::HUGEINT AS x, generate_subscripts(e, 1) AS i FROM kept
), c0 AS MATERIALIZED (
  SELECT c - 1 AS c, unnest(e)::HUGEINT AS x, generate_subscripts(e, 1) AS i FROM (
    SELECT e, row_number() OVER (ORDER BY sha256('{seed}' || vec_id) NULLS LAST, vec_id NULLS FIRST, e) AS c FROM kept
  ) WHERE c <= {clusters}
), {", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
  ON c = cluster
"""


CLUSTERS_SQL = clusters_sql()
