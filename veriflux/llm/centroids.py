"""Clustering of integer vectors around centroids, each vector assigned through a vantage-point tree.

A round builds a tree over the k centroids and broadcasts it: k vectors, whatever the number of rows. Each vector searches
it best-first: of its open nodes it visits the one with the least lower bound, and stops when that bound exceeds
its best distance. All vectors of a batch search at the same time, each with its own bounds, one node a step.

Distances to centroids are exact integers. Bounds come from roots in floating point and are lowered by more than
their rounding error; a node whose bound equals the best distance is visited, so that of equally near centroids the smaller number wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 4  # centroids in a leaf
CELLS = 1 << 22  # bounds and differences that one step holds
SLACK = 1e-9  # of the distances that a bound is made of; their rounding error is below 1e-14 of them


class VantageTree:
    """Inner nodes hold a vantage point and the nearer and the farther half of the others, leaves a few points.
    Of each half it keeps the range of its distances from the vantage point."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.points: list[list[int]] = []
        self.halves: list[tuple[int, int]] = []
        self.ranges: list[tuple[tuple[float, float], tuple[float, float]]] = []
        if len(centroids):
            self._add(np.arange(len(centroids)))
        self.leaf = np.array([h[0] < 0 for h in self.halves], bool)
        self.held = np.array([p + p[:1] * (LEAF - len(p)) for p in self.points], np.int64).reshape(-1, LEAF)
        self.child = np.array(self.halves, np.int64).reshape(-1, 2)
        self.range = np.array(self.ranges, np.float64).reshape(-1, 2, 2)

    def _add(self, numbers: np.ndarray) -> int:
        at = len(self.points)
        self.points.append(numbers[:LEAF].tolist())
        self.halves.append((-1, -1))
        self.ranges.append(((0.0, 0.0), (0.0, 0.0)))
        if len(numbers) <= LEAF:
            return at
        rows = self.centroids[numbers]
        middle = rows.astype(np.float64).mean(0)
        pivot = int(((rows - middle) ** 2).sum(1).argmax())  # a point at the edge splits the rest more sharply
        apart = np.sqrt(((rows - rows[pivot]) ** 2).sum(1).astype(np.float64))
        order = np.argsort(apart, kind="stable")
        order = order[order != pivot]
        half = len(order) // 2
        parts = order[:half], order[half:]
        self.points[at] = [int(numbers[pivot])]
        self.ranges[at] = tuple((float(apart[p].min()), float(apart[p].max())) for p in parts)
        self.halves[at] = tuple(self._add(np.sort(numbers[p])) for p in parts)
        return at

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each row, ties to the smaller number."""
        step = max(1, CELLS // max(len(self.points), LEAF * rows.shape[1], 1))
        parts = [self._search(rows[k : k + step]) for k in range(0, len(rows), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    def _search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(rows)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.centroids))
        bounds = np.full((n, len(self.points)), np.inf)
        bounds[:, 0] = 0.0
        active = np.arange(n)
        while True:
            node = bounds[active].argmin(1)
            least = bounds[active, node]
            live = np.isfinite(least) & (least <= np.sqrt(best[active].astype(np.float64)) * (1 + SLACK))
            active, node = active[live], node[live]
            if not len(active):
                return number, best
            bounds[active, node] = np.inf
            leaf = self.leaf[node]
            if leaf.any():
                self._take(rows, active[leaf], self.held[node[leaf]], best, number)
            if not leaf.all():
                at, inner = active[~leaf], node[~leaf]
                away = np.sqrt(self._take(rows, at, self.held[inner, :1], best, number).astype(np.float64))
                for side in (0, 1):
                    low, high = self.range[inner, side, 0], self.range[inner, side, 1]
                    bound = np.maximum(low - away, away - high) - SLACK * (away + high)
                    bounds[at, self.child[inner, side]] = np.maximum(bound, 0.0)

    def _take(self, rows: np.ndarray, at: np.ndarray, points: np.ndarray, best: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Compares rows with centroids; the squared distances to the last of them."""
        apart = np.zeros(0, np.int64)
        for k in range(points.shape[1]):
            which = points[:, k]
            apart = rows[at] - self.centroids[which]
            apart = np.einsum("ij,ij->i", apart, apart)
            nearer = (apart < best[at]) | ((apart == best[at]) & (which < number[at]))
            best[at[nearer]], number[at[nearer]] = apart[nearer], which[nearer]
        return apart


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    if len(flat) and size * (2.0 * float(np.abs(flat.astype(np.float64)).max())) ** 2 >= 2.0**63:
        raise ValueError("components too large: a squared distance has to fit into 64 bits")
    return flat


def _sums(batches: Iterator[pa.RecordBatch], tree: VantageTree) -> Iterator[pa.RecordBatch]:
    """Count (part -1) and sum of each component for each cluster, of all rows of a task."""
    k, size = tree.centroids.shape
    sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)

    def rows() -> pa.RecordBatch:
        cluster, part = np.nonzero(np.hstack([counts[:, None] > 0, np.repeat(counts[:, None] > 0, size, 1)]))
        columns = [pa.array(cluster, pa.int32()), pa.array(part - 1, pa.int32()), pa.array(np.hstack([counts[:, None], sums])[cluster, part], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["cluster", "part", "total"])

    for batch in batches:
        vectors = _matrix(batch.column(1), size)
        cluster, _ = tree.nearest(vectors)
        more = np.zeros((k, size), np.int64)
        np.add.at(more, cluster, vectors)
        if (np.abs(sums.astype(np.float64)) + np.abs(more) >= 2.0**62).any():  # rows of this task so far
            yield rows()
            sums[:], counts[:] = 0, 0
        sums += more
        counts += np.bincount(cluster, minlength=k)
    yield rows()


def _assign(batches: Iterator[pa.RecordBatch], tree: VantageTree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cluster, apart = tree.nearest(_matrix(batch.column(1), tree.centroids.shape[1]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(apart, pa.int64())], ["vec_id", "cluster", "distance"])


def whole_vectors(vectors: DataFrame, size: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and vector, with floor(scale * x) of each component; rows whose vector has exactly `size` components,
    none of them null or not finite. Other columns are left out."""
    given = vectors[vector_col]
    finite = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    rows = vectors.filter((F.size(given) == size) & F.coalesce(finite, F.lit(False)))
    return rows.select(rows[id_col].cast("long").alias("vec_id"), F.transform(rows[vector_col], lambda x: F.floor(x.cast("double") * scale)).alias("vector"))


def first_centroids(vectors: DataFrame, k: int, order: Column) -> np.ndarray:
    """The k vectors that come first in `order`; nulls come last, ties go to the smaller vector."""
    rows = vectors.orderBy(order.asc_nulls_last(), F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(k).collect()
    return np.array([r.vector for r in rows], np.int64)


def cluster(vectors: DataFrame, k: int, rounds: int, size: int, order: Column) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia and inertia (its sums over the cluster and over all), centroid.

    `vectors` has vec_id and vector (as from `whole_vectors`). Centroids 0, 1, ... start as the first k vectors in
    `order`, fewer if there are fewer. A round assigns all vectors to their nearest centroid, ties to the smaller number, and moves
    each centroid to the floor of the mean of its vectors; one without vectors stays. Then vectors are assigned once more.

    Every row counts, so a repeated row has as much weight as its copies; a null id stays null; an empty table
    gives no rows. A squared distance or inertia beyond 64 bits is an error. The driver holds k centroids and k sums. The vectors are read
    rounds + 3 times and never shuffled; a task sends k sums, so a cluster with most rows is no hot key."""
    spark = vectors.sparkSession
    centres = first_centroids(vectors, k, order).reshape(-1, size)
    for _ in range(rounds if len(centres) else 0):
        tree = spark.sparkContext.broadcast(VantageTree(centres))
        partial = vectors.select("vec_id", "vector").mapInArrow(lambda b, t=tree: _sums(b, t.value), "cluster int, part int, total bigint")
        totals = partial.groupBy("cluster", "part").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        counts = {r.cluster: int(r.total) for r in totals if r.part < 0}
        centres = centres.copy()
        for r in totals:
            if r.part >= 0:
                centres[r.cluster, r.part] = int(r.total) // counts[r.cluster]
        tree.unpersist()
    tree = spark.sparkContext.broadcast(VantageTree(centres))
    assigned = vectors.select("vec_id", "vector").mapInArrow(lambda b: _assign(b, tree.value), "vec_id bigint, cluster int, distance bigint")
    inertias = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r.s) for r in inertias)
    found = [(r.cluster, int(r.s), total, centres[r.cluster].tolist()) for r in inertias]
    table = spark.createDataFrame(found, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
