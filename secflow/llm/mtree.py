"""Exact top-k by inner product with an M-tree per shard, searched best first.

Nodes are pages of at most ``PAGE`` entries.  A routing entry stores its centre, its covering
radius and its distance to the parent's centre; a leaf entry stores its vector and that distance.
For a query q and anything x under an entry with centre c and radius r,

    q.x = q.c + q.(x - c) <= q.c + |q| r,

so pages are visited by falling upper bound and the search stops when the bound falls below the
k-th score.  The queries of a block walk the tree together, each with its own bound and k-th score.
Before q.c is computed the triangle inequality bounds it through the parent p:
q.c <= q.p + |q| d(c, p), with d(c, p) stored; entries that fail this test cost no product.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part,
neither as queries nor as candidates; a query is compared with every other row of its own
dimension (a second row with the same id is another row); ties go to the smaller vec_id; fewer
than k candidates give fewer rows; a row with a null id is a candidate, sorts first in ties and is
never a query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.llm import vectors
from secflow.llm.common import arrow_map, table

PAGE = 64
QUERY_BLOCK = 256                                # queries that walk a tree together
# Every query meets every shard, so shards are as large as an executor's task holds well: 65,536 vectors of 64
# doubles are 34 MB, twice that with their pages.
SHARD_ROWS, LEAST_ROWS = 65_536, 4_096
OUT = "query_row long, query_id long, row long, vec_id long, score long"
OUT_SCHEMA = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])


class MTree:
    """Bulk-loaded M-tree over the rows of ``x`` (float64 holding integers; exact below 2**53)."""

    def __init__(self, x: np.ndarray, page: int = PAGE):
        self.x, self.page = x, page
        self.products = 0                         # inner products of queries so far
        self.centre: list[np.ndarray] = []
        self.children: list[np.ndarray] = []      # node ids, or row numbers in a leaf
        self.leaf: list[bool] = []
        self.radius: list[np.ndarray] = []        # covering radius of each child (0 in a leaf)
        self.to_parent: list[np.ndarray] = []     # distance of each child's centre to this centre
        self.points: list[np.ndarray] = []        # the children's centres or vectors, one page
        self.root, self.root_radius = self._build(np.arange(len(x)))

    def _page(self, centre, children, leaf, radius, points) -> tuple[int, float]:
        d = np.sqrt(((points - centre) ** 2).sum(1))
        self.centre.append(centre)
        self.children.append(np.asarray(children))
        self.leaf.append(leaf)
        self.radius.append(np.asarray(radius, dtype=np.float64))
        self.to_parent.append(d)
        self.points.append(points)
        return len(self.centre) - 1, float((d + self.radius[-1]).max())

    def _build(self, rows: np.ndarray) -> tuple[int, float]:
        x = self.x[rows]
        centre = x.mean(0)
        if len(rows) <= self.page:
            return self._page(centre, rows, True, np.zeros(len(rows)), x)
        parts = [p for p in self._split(x, rows) if len(p)]
        kids = [self._build(p) for p in parts]
        ids = [k for k, _ in kids]
        return self._page(centre, ids, False, [r for _, r in kids],
                          np.stack([self.centre[k] for k in ids]))

    def _split(self, x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        """Group rows round far-apart pivots, at most one page of groups."""
        groups = min(self.page, -(-len(rows) // self.page))
        far, square = np.full(len(rows), np.inf), (x * x).sum(1)
        pivots, at = [], 0
        for _ in range(groups):
            pivots.append(x[at])
            far = np.minimum(far, square - 2 * (x @ x[at]) + square[at])    # whole numbers: exact
            at = int(far.argmax())
            if far[at] == 0:
                break
        if len(pivots) == 1:                       # equal rows: pages by position
            return np.array_split(rows, groups)
        p = np.stack(pivots)
        near = ((p ** 2).sum(1) - 2 * x @ p.T).argmin(1)
        parts = [rows[near == g] for g in range(len(p))]
        if max(map(len, parts)) > 0.9 * len(rows):  # no progress: halve along the widest axis
            order = rows[np.argsort(x[:, x.var(0).argmax()], kind="stable")]
            return np.array_split(order, min(groups, 8))
        return parts

    def search_block(self, qs: np.ndarray, k: int, self_rows: np.ndarray,
                     ids: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each row of ``qs`` the k best (score, -id, row number), its ``self_rows`` entry (or -1) left out.

        The queries of a block share one queue: a page is visited once, for those queries whose bound can still
        reach their own k-th score, and costs one matrix product.
        """
        norm, slack = np.sqrt((qs * qs).sum(1)), 1e-6
        best: list[list[tuple[int, int, int]]] = [[] for _ in qs]    # min-heaps: the worst kept first
        least = np.full(len(qs), -np.inf)                           # each query's k-th score so far
        root_dot = qs @ self.centre[self.root]
        bound = root_dot + norm * self.root_radius
        queue = [(-float(bound.max()), self.root, np.arange(len(qs)), bound, root_dot)]
        while queue:
            top, node, who, bound, centre_dot = heapq.heappop(queue)
            if -top + slack < least.min():
                break
            alive = bound + slack >= least[who]
            who, centre_dot = who[alive], centre_dot[alive]
            if not len(who):
                continue
            # q.c <= q.p + |q| d(c, p): entries that no query can reach by their stored distances cost no product.
            far = self.to_parent[node] + self.radius[node]
            reach = centre_dot[:, None] + norm[who, None] * far + slack >= least[who, None]
            open_ = np.flatnonzero(reach.any(0))
            if not len(open_):
                continue
            self.products += len(who) * len(open_)
            dots = qs[who] @ self.points[node][open_].T
            if self.leaf[node]:
                self._keep(best, least, k, who, dots, self.children[node][open_], self_rows, ids)
                continue
            ups = dots + norm[who, None] * self.radius[node][open_]
            hopeful = ups + slack >= least[who, None]
            for j in np.flatnonzero(hopeful.any(0)).tolist():
                m = hopeful[:, j]
                heapq.heappush(queue, (-float(ups[m, j].max()), int(self.children[node][open_[j]]),
                                       who[m], ups[m, j], dots[m, j]))
        return [sorted(b, reverse=True) for b in best]

    @staticmethod
    def _keep(best, least, k, who, dots, rows, self_rows, ids) -> None:
        """Offer a leaf's rows to the queries ``who``; rows below the leaf's own (k + 1)-th score cannot be among
        the k best (one of the k + 1 may be the query's own row)."""
        floor = least[who]
        if dots.shape[1] > k + 1:
            floor = np.maximum(floor, np.partition(dots, -k - 1, axis=1)[:, -k - 1])
        for i, j in zip(*(a.tolist() for a in np.nonzero(dots >= floor[:, None])), strict=True):
            q, row = int(who[i]), int(rows[j])
            if row == self_rows[q]:
                continue
            item, heap = (int(round(float(dots[i, j]))), -int(ids[row]), row), best[q]
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
            if len(heap) == k:
                least[q] = heap[0][0]

    def search(self, q: np.ndarray, k: int, self_row: int, ids: np.ndarray) -> list[tuple[int, int, int]]:
        return self.search_block(q[None, :], k, np.array([self_row]), ids)[0]


def _hits(queries: pa.Table, dim: int, k: int, tree: MTree, ids, names, rows, at) -> pa.RecordBatch:
    qrows, qids = queries.column("row").to_pylist(), queries.column("vec_id").to_pylist()
    own = np.array([at.get(r, -1) for r in qrows])
    found = tree.search_block(vectors.matrix(queries.column("vec").chunk(0), dim), k, own, ids)
    out = [(r, q, int(rows[hit]), names[hit], score)
           for r, q, best in zip(qrows, qids, found, strict=True) for score, _, hit in best]
    return pa.RecordBatch.from_pydict(
        {n: [o[i] for o in out] for i, n in enumerate(OUT_SCHEMA.names)}, schema=OUT_SCHEMA)


def _searcher(k: int, page: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, trees = None, [], {}
        for s, kind, b in vectors.runs(batches):
            if s != shard:
                shard, parts, trees = s, [], {}
            if kind == 0:
                parts.append(b)
                continue
            if parts:
                data, parts = pa.Table.from_batches(parts), []
                dims = data.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    own = data.filter(pa.array(dims == dim)).combine_chunks()
                    ids = own.column("vec_id").to_numpy(zero_copy_only=False)
                    ids = np.where(np.isnan(ids), -2.0 ** 62, ids) if ids.dtype.kind == "f" else ids
                    x = vectors.matrix(own.column("vec").chunk(0), dim)
                    rows = own.column("row").to_numpy()
                    trees[dim] = (MTree(x, page), ids.astype(np.int64),
                                  own.column("vec_id").to_pylist(), rows,
                                  dict(zip(rows.tolist(), range(len(rows)), strict=True)))
            dims = b.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                if dim in trees:
                    own = pa.Table.from_batches([b]).filter(pa.array(dims == dim)).combine_chunks()
                    for lo in range(0, own.num_rows, QUERY_BLOCK):
                        yield _hits(own.slice(lo, QUERY_BLOCK).combine_chunks(), dim, k, *trees[dim])
    return run


def top_k(df: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0, shard_rows: int = SHARD_ROWS, page: int = PAGE) -> DataFrame:
    """(query_id, rank, vec_id, score) over all rows; components become floor(scale * x).

    ``is_query`` is a column over ``vec_id``.  Scores are exact integers: every product and sum
    stays an integer below 2**53 for the magnitudes that floor(scale * x) of embeddings has.
    """
    rows = vectors.vector_rows(df, id_col, vec_col).withColumn(
        "vec", F.transform("vec", lambda x: F.floor(F.lit(scale) * x).cast("double")))
    data, n = vectors.sharded(rows, shard_rows, "mtree-rows", min(LEAST_ROWS, shard_rows))
    queries = data.filter(F.coalesce(is_query, F.lit(False))).drop("shard")
    hits = arrow_map(vectors.with_queries(data, queries, n), _searcher(k, page), OUT)
    return vectors.merge(hits, k, [F.col("score").desc()])


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)
