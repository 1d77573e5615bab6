"""Approximate nearest neighbours: one HNSW graph per shard, stored flat, shard results merged.

Equal vectors are one node: a graph of copies at distance 0 cannot be walked, and no query needs
more than the k + 1 copies with the smallest ids (one may be the query's own row).  Spark finds them
by a ranked window, first per salt of the row, so a vector that many rows share fills no task.

``build_index`` returns one row per shard and dimension: vectors, the copies of each, and, for each
level, a flat int32 neighbour array (fixed width, -1 for none).  ``search`` sends every query to
every shard, walks the stored graph, rescores the nodes exactly on the original vectors in double
precision, expands the nearest k + 1 to their copies and merges the shards' lists.  Shards hold about
``SHARD_ROWS`` nodes, so building grows linearly with the input and no task holds more than a shard.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part; a query's own row is left out (another row with the same id is a candidate); ties go to the
smaller vec_id; fewer than k candidates give fewer rows; vectors meet only their own dimension; a
row with a null id is a candidate that sorts first in ties, never a query.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from secflow.llm import vectors
from secflow.llm.common import arrow_map, pinned, table

M, EF_BUILD, EF_SEARCH, SHARD_ROWS = 16, 80, 160, 4096
INDEX = ("shard int, dim int, entry int, top int, copies binary, rows binary, ids binary, null_id binary, "
         "vectors binary, neighbours array<binary>")
INDEX_SCHEMA = pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("entry", pa.int32()),
                          ("top", pa.int32()), ("copies", pa.binary()), ("rows", pa.binary()),
                          ("ids", pa.binary()), ("null_id", pa.binary()), ("vectors", pa.binary()),
                          ("neighbours", pa.list_(pa.binary()))])
OUT = "query_row long, query_id long, row long, vec_id long, score double"
OUT_SCHEMA = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()),
                        ("vec_id", pa.int64()), ("score", pa.float64())])


def _walk(x, graph, q, start: list[tuple[float, int]], ef: int, seen: np.ndarray, mark: int):
    """Best-first walk of one level; returns the ef nearest as (distance, node), nearest first."""
    todo, best = list(start), [(-d, v) for d, v in start]
    heapq.heapify(todo)
    heapq.heapify(best)
    for _, v in start:
        seen[v] = mark
    while todo:
        d, v = heapq.heappop(todo)
        if len(best) >= ef and d > -best[0][0]:
            break
        near = graph[v]
        near = near[near >= 0]
        near = near[seen[near] != mark]
        if not len(near):
            continue
        seen[near] = mark
        diff = x[near] - q
        for dist, u in zip(np.einsum("ij,ij->i", diff, diff).tolist(), near.tolist(), strict=True):
            if len(best) < ef:
                heapq.heappush(best, (-dist, u))
                heapq.heappush(todo, (dist, u))
            elif dist < -best[0][0]:
                heapq.heapreplace(best, (-dist, u))
                heapq.heappush(todo, (dist, u))
    return sorted((-d, v) for d, v in best)


def _diverse(x, found: list[tuple[float, int]], width: int) -> list[int]:
    """Neighbours nearer to the node than to any neighbour already chosen; the rest fill up."""
    nodes = np.array([v for _, v in found])
    if len(nodes) <= width:
        return nodes.tolist()
    y = x[nodes]
    sq = (y * y).sum(1)
    between = sq[:, None] + sq[None, :] - 2 * y @ y.T
    dist = np.array([d for d, _ in found])
    chosen, cover = [], np.full(len(nodes), np.inf)
    for i in range(len(nodes)):
        if dist[i] <= cover[i]:
            chosen.append(i)
            np.minimum(cover, between[i], out=cover)
            if len(chosen) == width:
                break
    rest = (i for i in range(len(nodes)) if i not in set(chosen))
    while len(chosen) < width:
        chosen.append(next(rest))
    return nodes[chosen].tolist()


def build_graph(x: np.ndarray, m: int = M, ef: int = EF_BUILD, seed: int = 7):
    """Insert the rows of ``x`` one by one; returns (neighbour arrays by level, entry node)."""
    n = len(x)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(rng.random(n)) / np.log(m)).astype(np.int64), 8)
    top = int(level.max())
    width = [2 * m, *[m] * top]
    graphs = [np.full((n, w), -1, dtype=np.int32) for w in width]
    degree = [np.zeros(n, dtype=np.int32) for _ in width]
    seen, mark, entry, high = np.zeros(n, dtype=np.int64), 0, 0, int(level[0])
    for v in range(1, n):
        q, own = x[v], int(level[v])
        at = [(float(((x[entry] - q) ** 2).sum()), entry)]
        for lv in range(high, own, -1):
            mark += 1
            at = _walk(x, graphs[lv], q, at, 1, seen, mark)
        for lv in range(min(own, high), -1, -1):
            mark += 1
            at = _walk(x, graphs[lv], q, at, ef, seen, mark)
            near, g, deg = _diverse(x, at, m), graphs[lv], degree[lv]
            g[v, :len(near)], deg[v] = near, len(near)
            for u in near:
                if deg[u] < width[lv]:
                    g[u, deg[u]] = v
                    deg[u] += 1
                else:
                    own_near = np.append(g[u], v)
                    diff = x[own_near] - x[u]
                    d = np.einsum("ij,ij->i", diff, diff)
                    order = np.argsort(d, kind="stable")
                    g[u] = _diverse(x, list(zip(d[order].tolist(), own_near[order].tolist(), strict=True)),
                                    width[lv])
        if own > high:
            entry, high = v, own
    return graphs, entry


def search_graph(x, graphs, entry: int, q, ef: int, seen, mark: int) -> list[tuple[float, int]]:
    at = [(float(((x[entry] - q) ** 2).sum()), entry)]
    for lv in range(len(graphs) - 1, 0, -1):
        at = _walk(x, graphs[lv], q, at, 1, seen, mark)[:1]
        mark += 1
    return _walk(x, graphs[0], q, at, ef, seen, mark)


def _builder(m: int, ef: int):
    def one(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = pa.Table.from_batches(parts)
        dims = data.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = data.filter(pa.array(dims == dim)).combine_chunks()
            x = vectors.matrix(own.column("vec").chunk(0), dim)
            graphs, entry = build_graph(x, m, ef)
            members = own.column("members").chunk(0)
            copies, rows, ids = members.value_lengths(), *members.flatten().flatten()
            yield pa.RecordBatch.from_pydict({
                "shard": [int(own.column("shard")[0].as_py())], "dim": [dim], "entry": [entry],
                "top": [len(graphs)], "copies": [copies.to_numpy().astype(np.int64).tobytes()],
                "rows": [rows.to_numpy().tobytes()],
                "ids": [ids.fill_null(0).to_numpy().tobytes()],
                "null_id": [ids.is_null().to_numpy(zero_copy_only=False).tobytes()],
                "vectors": [x.tobytes()], "neighbours": [[g.tobytes() for g in graphs]]}, schema=INDEX_SCHEMA)

    def run(batches):
        shard, parts = None, []
        for b in batches:
            s = b.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi == lo:
                    continue
                if parts and s[lo] != shard:
                    yield from one(parts)
                    parts = []
                shard = s[lo]
                parts.append(b.slice(lo, hi - lo))
        if parts:
            yield from one(parts)
    return run


def build_index(data: DataFrame, n_shards: int, m: int = M, ef: int = EF_BUILD) -> DataFrame:
    """One flat HNSW graph per shard (and dimension) over ``data`` (shard, row, vec, dim, members)."""
    parts = (data.select("shard", "row", "vec", "dim", "members").repartition(n_shards, "shard")
             .sortWithinPartitions("shard", "row"))
    return arrow_map(parts, _builder(m, ef), INDEX)


def _searcher(k: int, ef: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, graphs = None, {}
        for s, kind, b in vectors.runs(batches):
            if s != shard:
                shard, graphs = s, {}
            if kind == 0:
                for r in b.to_pylist():
                    copies = np.frombuffer(r["copies"], dtype=np.int64)
                    x = np.frombuffer(r["vectors"]).reshape(len(copies), r["dim"])
                    g = [np.frombuffer(a, dtype=np.int32).reshape(len(copies), -1) for a in r["neighbours"]]
                    graphs[r["dim"]] = (x, g, r["entry"], np.concatenate([[0], np.cumsum(copies)]),
                                        np.frombuffer(r["rows"], dtype=np.int64),
                                        np.frombuffer(r["ids"], dtype=np.int64),
                                        np.frombuffer(r["null_id"], dtype=bool),
                                        np.zeros(len(copies), dtype=np.int64))
                continue
            out, mark = {n: [] for n in OUT_SCHEMA.names}, 1
            for dim, row, qid, vec in zip(*(b.column(c).to_pylist() for c in ("dim", "row", "vec_id", "vec")),
                                          strict=True):
                if dim not in graphs:
                    continue
                x, g, entry, first, rows, ids, null_id, seen = graphs[dim]
                q = np.array(vec)
                mark += len(g) + 1
                nodes = np.array([v for _, v in search_graph(x, g, entry, q, max(ef, k + 1), seen, mark)])
                score = np.sqrt(((x[nodes] - q) ** 2).sum(1))
                least = first[nodes]                          # a node's copy with the smallest id
                order = np.lexsort((ids[least], ~null_id[least], score))[:k + 1]
                nodes, score = nodes[order], score[order]
                hits = np.concatenate([np.arange(first[v], first[v + 1]) for v in nodes])
                score = np.repeat(score, first[nodes + 1] - first[nodes])
                hits, score = hits[rows[hits] != row], score[rows[hits] != row]
                order = np.lexsort((rows[hits], ids[hits], ~null_id[hits], score))[:k]
                for h, sc in zip(hits[order].tolist(), score[order].tolist(), strict=True):
                    for n, v in zip(OUT_SCHEMA.names, (row, qid, int(rows[h]), None if null_id[h] else
                                                       int(ids[h]), sc), strict=True):
                        out[n].append(v)
            for d in graphs.values():
                d[-1][:] = 0
            yield pa.RecordBatch.from_pydict(out, schema=OUT_SCHEMA)
    return run


def search(index: DataFrame, queries: DataFrame, n_shards: int, k: int, ef: int = EF_SEARCH) -> DataFrame:
    q = queries.select("row", "vec_id", "vec", F.col("dim"))
    cols = index.dtypes
    data = index.select("*", *[F.lit(None).cast(t).alias(c) for c, t in
                               (("row", "long"), ("vec_id", "long"), ("vec", "array<double>"))])
    assert len(cols) == 10
    hits = arrow_map(vectors.with_queries(data, q, n_shards), _searcher(k, ef), OUT)
    return vectors.merge(hits, k, [F.col("score").asc()])


def distinct(rows: DataFrame, most: int, salt_rows: int) -> DataFrame:
    """(vec, dim, members): each different vector with its ``most`` first rows by (vec_id, row)."""
    salts = max(1, math.ceil(rows.count() / salt_rows))
    for keys in (["vec", "salt"], ["vec"]):
        w = Window.partitionBy(*keys).orderBy(F.col("vec_id").asc_nulls_first(), "row")
        rows = (rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
                .withColumn("place", F.row_number().over(w)).filter(F.col("place") <= most))
    members = F.transform(F.array_sort(F.collect_list(F.struct("place", "row", "vec_id"))),
                          lambda m: F.struct(m["row"].alias("row"), m["vec_id"].alias("vec_id")))
    return rows.groupBy("vec").agg(members.alias("members")).withColumn("dim", F.size("vec"))


def nearest(df: DataFrame, is_query, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
            shard_rows: int = SHARD_ROWS, ef_search: int = EF_SEARCH) -> DataFrame:
    """(query_id, rank, vec_id, score): k nearest other rows by Euclidean distance."""
    rows = vectors.vector_rows(df, id_col, vec_col).filter(F.exists("vec", lambda x: x != 0))
    # Adding 0.0 makes -0.0 equal to 0.0 for the grouping.
    rows = pinned(rows.withColumn("vec", F.transform("vec", lambda x: x + F.lit(0.0)))
                  .withColumn("row", F.monotonically_increasing_id()), "hnsw-rows")
    data, n = vectors.sharded(distinct(rows, k + 1, shard_rows), shard_rows, "hnsw-nodes")
    index = pinned(build_index(data, n), "hnsw-index")
    queries = rows.filter(F.coalesce(is_query, F.lit(False)))
    return search(index, queries, n, k, ef_search)


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)
