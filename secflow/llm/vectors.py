"""Sharded vector search: rows and queries meet shard by shard, partial top-k lists are merged.

Rows get a shard of about ``shard_rows`` rows whatever their id (a repeated id cannot overload a
shard).  Each query row is sent to every shard, in rows, so a task holds one shard and a batch of
queries.  Only a query's k best per shard reach the merge.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.llm.common import pinned, usable_vector


def vector_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double>, dim) of the usable vectors."""
    vec = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("vec"))
            .filter(usable_vector(F.col("vec"))).withColumn("dim", F.size("vec")))


def sharded(rows: DataFrame, shard_rows: int, name: str, least_rows: int | None = None) -> tuple[DataFrame, int]:
    """Pinned rows with a row number ``row`` and a shard; returns (table, number of shards).

    A shard holds about ``shard_rows`` rows; with ``least_rows`` a small table is cut further, down to that many, while
    there are cores for its shards.
    """
    rows = pinned(rows.withColumn("row", F.monotonically_increasing_id()), name)
    total = rows.count()
    n = max(1, math.ceil(total / shard_rows))
    if least_rows:
        n = max(n, min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(total / least_rows)))
    return rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")), n


def with_queries(data: DataFrame, queries: DataFrame, n_shards: int) -> DataFrame:
    """One partition stream per shard: its data rows (kind 0), then every query row (kind 1)."""
    q = (queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
         .withColumn("kind", F.lit(1)))
    both = data.withColumn("kind", F.lit(0)).unionByName(q.select(*[
        F.col(c) if c in q.columns else F.lit(None).cast(t).alias(c)
        for c, t in [*data.dtypes, ("kind", "int")]]))
    return both.repartition(n_shards, "shard").sortWithinPartitions("shard", "kind")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Cut a stream sorted by (shard, kind) into pieces of one (shard, kind) each."""
    for b in batches:
        key = (b.column("shard").to_numpy(zero_copy_only=False).astype(np.int64) * 2
               + b.column("kind").to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if hi > lo:
                yield int(key[lo] // 2), int(key[lo] % 2), b.slice(lo, hi - lo)


def matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def merge(partial: DataFrame, k: int, best_first: list) -> DataFrame:
    """The k best of each query over all shards; ranks from 1, ties to the smaller vec_id."""
    w = Window.partitionBy("query_row").orderBy(*best_first, F.col("vec_id").asc(), F.col("row").asc())
    return (partial.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


Scorer = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
