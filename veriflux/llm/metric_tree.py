"""Exact top-k by inner product with metric trees.

Integer vectors get one more coordinate, so that all have the same length; then the larger inner product is the
smaller Euclidean distance. Each group of vectors is loaded into an M-tree: pages of objects around a pivot with a
covering radius, every object with its stored distance to the pivot. Pages are opened in the order of the least
distance that they can hold, for a block of queries at a time. The triangle inequality with stored parent distances spares the distance to most pivots
and objects; what remains is scored exactly in integers.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE, FANOUT = 64, 16
TREE_ROWS, TASK_QUERIES = 1 << 14, 1 << 16
QUERY_BLOCK = 256  # queries that search a tree together
NONE, LEAST = np.iinfo(np.int64).max, -(np.int64(1) << 62)
FOUND = "query_id bigint, query_no bigint, vec_id bigint, score bigint"


class Node:
    """A page. Its children are nodes, or rows of the table if it is a leaf; apart: their distances to its pivot."""

    __slots__ = ("pivot", "radius", "nodes", "rows", "apart", "pivots", "radii")


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors = ids, vectors
        norms = (vectors**2).sum(1)
        self.most = norms.max() if len(norms) else 0.0
        self.points = np.hstack((vectors, np.sqrt(self.most - norms)[:, None]))
        self.root = self._load(np.arange(len(ids)), 0)

    def _distances(self, rows: np.ndarray, pivot: int) -> np.ndarray:
        return np.sqrt(((self.points[rows] - self.points[pivot]) ** 2).sum(1))

    def _load(self, rows: np.ndarray, pivot_at: int) -> Node:
        """Bulk loading: rows go to the nearest of some pivots that lie far apart, until they fit a page."""
        node = Node()
        node.pivot = rows[pivot_at] if len(rows) else -1
        node.nodes = None
        if len(rows) <= PAGE:
            node.rows = rows
            node.apart = self._distances(rows, node.pivot) if len(rows) else np.zeros(0)
        else:
            node.rows = rows[:0]
            nearest, owner, chosen = np.full(len(rows), np.inf), np.zeros(len(rows), np.int64), []
            at = 0
            for k in range(FANOUT):
                chosen.append(at)
                d = self._distances(rows, rows[at])
                closer = d < nearest
                nearest[closer], owner[closer] = d[closer], k
                at = int(nearest.argmax())
                if nearest[at] == 0:
                    break
            if len(chosen) == 1:  # all rows are equal
                owner = np.arange(len(rows)) * FANOUT // len(rows)
                chosen = [int(np.flatnonzero(owner == k)[0]) for k in range(FANOUT)]
            groups = [np.flatnonzero(owner == k) for k in range(len(chosen))]
            node.nodes = [self._load(rows[g], int(np.searchsorted(g, c)) if c in g else 0) for g, c in zip(groups, chosen, strict=True) if len(g)]
            node.pivots = np.array([n.pivot for n in node.nodes])
            node.radii = np.array([n.radius for n in node.nodes])
            node.apart = self._distances(node.pivots, node.pivot)
        node.radius = self._distances(rows, node.pivot).max() if len(rows) else 0.0
        return node

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows of each query, by score, ties by id; NONE where there are fewer. The rows of a
        query's own id are left out.

        The queries of a block share their pages: a page is opened at the least distance that it can have from any of them, for
        those whose limit it can meet, and what remains of it is scored for them as one matrix product."""
        n = len(queries)
        found = Best(n, k)
        if not len(self.ids) or not n:
            return found.ids, found.scores
        norms = (queries**2).sum(1)
        base = norms + self.most
        slack = 1e-6 * (1.0 + np.sqrt(base + self.most))
        exact = _exact(queries, self.vectors)
        limit = np.full(n, np.inf)

        def away(which: np.ndarray, pivots: np.ndarray) -> np.ndarray:
            return np.sqrt(np.maximum(base[which, None] - 2.0 * (queries[which] @ self.vectors[pivots].T), 0.0))

        everyone = np.arange(n)
        d = away(everyone, np.array([self.root.pivot]))[:, 0]
        queue = [(float(np.maximum(d - self.root.radius, 0.0).min()), 0, self.root, everyone, d)]
        count = 1
        while queue:
            _, _, node, which, d = heapq.heappop(queue)
            live = d - node.radius <= limit[which]
            which, d = which[live], d[live]
            if not len(which):
                continue
            if node.nodes is None:
                near = np.abs(d[:, None] - node.apart) <= limit[which, None]
                rows, asked = near.any(0), near.any(1)
                if rows.any():
                    which, rows = which[asked], node.rows[rows]
                    scores = exact(which, rows)
                    found.add(which, scores, np.where(self.ids[rows] == own[which, None], NONE, self.ids[rows]))
                    worst = found.scores[which, -1].astype(np.float64)
                    full = found.ids[which, -1] != NONE
                    limit[which[full]] = np.sqrt(np.maximum(base[which[full]] - 2.0 * worst[full], 0.0)) + slack[which[full]]
                continue
            near = np.abs(d[:, None] - node.apart) - node.radii <= limit[which, None]
            children = np.flatnonzero(near.any(0))
            if not len(children):
                continue
            apart = away(which, node.pivots[children])
            for at, child in enumerate(children.tolist()):
                some = near[:, child] & (apart[:, at] - node.radii[child] <= limit[which])
                if some.any():
                    reach = apart[some, at]
                    heapq.heappush(queue, (float(np.maximum(reach - node.radii[child], 0.0).min()), count, node.nodes[child], which[some], reach))
                    count += 1
        return found.ids, found.scores


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores, self.ids = np.full((n, k), LEAST), np.full((n, k), NONE)

    def add(self, which: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.where(ids == NONE, LEAST, scores)
        better = (scores >= self.scores[which, -1:]).any(1)
        which, scores, ids = which[better], np.hstack([self.scores[which[better]], scores[better]]), np.hstack([self.ids[which[better]], ids[better]])
        order = np.lexsort((ids, ids == NONE, -scores), axis=-1)[:, : self.k]
        self.scores[which], self.ids[which] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _exact(queries: np.ndarray, vectors: np.ndarray):
    """Inner products of queries and rows by their numbers, as integers. Doubles are exact below 2**53."""
    most = np.sqrt((queries**2).sum(1).max()) * np.sqrt((vectors**2).sum(1).max())
    if most < 2.0**52:
        return lambda q, v: (queries[q] @ vectors[v].T).astype(np.int64)
    if most >= 2.0**62 or max(np.abs(queries).max(), np.abs(vectors).max()) >= 2.0**53:
        raise ValueError("components too large: an inner product has to fit into 64 bits")
    whole, rows = queries.astype(np.int64), vectors.astype(np.int64)
    return lambda q, v: whole[q] @ rows[v].T


def _groups(column: pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors by their length: row numbers and matrix."""
    column = column.combine_chunks()
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return {
        int(size): (at := np.flatnonzero(lengths == size), column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), int(size)))
        for size in np.unique(lengths)
    }


def _search(vectors: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """Only vectors of the same length are compared."""
    got = []
    if vectors.num_rows and queries.num_rows:
        stored, ids = _groups(vectors.column("vector")), vectors.column("vec_id").to_numpy()
        asked, own, numbers = _groups(queries.column("vector")), queries.column("vec_id").to_numpy(), queries.column("query_no").to_numpy()
        for size, (which, points) in asked.items():
            if size in stored:
                at, rows = stored[size]
                tree = MTree(ids[at], rows)
                for lo in range(0, len(which), QUERY_BLOCK):
                    block = which[lo : lo + QUERY_BLOCK]
                    found, scores = tree.search(points[lo : lo + QUERY_BLOCK], own[block], k)
                    row, place = np.nonzero(found != NONE)
                    got.append((own[block][row], numbers[block][row], found[row, place], scores[row, place]))
    columns = [np.concatenate(c) for c in zip(*got, strict=True)] if got else [np.zeros(0, np.int64)] * 4
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_no", "vec_id", "score"])


def top_inner_products(
    vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector", tree_rows: int = TREE_ROWS, task_queries: int = TASK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query with all other rows.

    `vectors` holds integers in doubles (products beyond 64 bits are an error); `queries` says which rows are queries too. Ties
    go to the smaller id. Rows with a null id or vector, or with null or non-finite components, take no part. Vectors of
    different lengths are not compared. All rows that share the query's id count as its own. Repeated rows are
    candidates each by itself; equal query rows are searched once. Fewer candidates than k give fewer rows, an empty
    table none. Rows are dealt out to trees of about `tree_rows`, queries to parts of about `task_queries`, both by a hash; a task
    gets one tree and one part, so its memory does not grow with the input.
    """
    vector = vectors[vector_col]
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vector.alias("vector"), queries.alias("is_query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    counted = vectors.select(F.count(F.lit(1)).alias("rows"), F.count_if(queries).alias("queries")).first()
    trees, parts = max(1, -(-counted["rows"] // tree_rows)), max(1, -(-counted["queries"] // task_queries))
    dealt = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(trees)).cast("int").alias("tree"), "vec_id", "vector")
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = rows.filter("is_query").select("vec_id", "vector").withColumn("query_no", F.xxhash64("vec_id", "vector"))
    asked = asked.dropDuplicates(["vec_id", "query_no"]).withColumn("part", F.pmod("query_no", F.lit(parts)).cast("int"))
    asked = asked.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    found = dealt.groupBy("tree", "part").cogroup(asked.groupBy("tree", "part")).applyInArrow(lambda v, q: _search(v, q, k), FOUND)
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
