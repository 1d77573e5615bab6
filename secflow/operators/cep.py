"""Burst pattern: several suspicious events for one asset within a time window.

Batch form, exact for any key size.  Every event gets two probes in the same
total order (key, time, kind, id): a lower probe at ``t - w`` sorted before
events of equal time and an upper probe at ``t`` sorted after them.  The
number of events in ``[t - w, t]`` of the event's key is the difference of
the events counted before the two probes; rows of other keys cancel.  Those
counts come from ``global_prefix_count`` (range partitions, bounded blocks),
so a hot asset is spread over many tasks instead of one window partition, and
the two probes meet again in a partially aggregated group-by on the event id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from secflow.operators.anomaly import global_prefix_count

DEFAULT_WINDOW_MS = 86_400_000
DEFAULT_MIN_EVENTS = 3


def burst(events: DataFrame, keys: list[str], ts: str, id_col: str,
          window_ms: int = DEFAULT_WINDOW_MS, min_events: int = DEFAULT_MIN_EVENTS,
          num_partitions: int | None = None, block_rows: int = 8192) -> DataFrame:
    """Events that complete a burst: >= ``min_events`` events of the same key within
    ``window_ms`` ending at the event (inclusive; events at equal times all count).
    ``id_col`` must identify an event within its key."""
    spark = events.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    w_us = window_ms * 1000
    base = events.select(*keys, id_col, F.col(ts).alias("_ts"),
                         F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"))
    kinds = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_kind")
    merged = base.select("*", kinds).withColumn(
        "_t", F.when(F.col("_kind") == -1, F.col("_t") - F.lit(w_us)).otherwise(F.col("_t")))
    order = [F.col(k) for k in keys] + [F.col("_t"), F.col("_kind"), F.col(id_col)]
    counted = global_prefix_count(merged, order, F.col("_kind") == 0, num_partitions, block_rows)
    probes = counted.filter(F.col("_kind") != 0)
    per_event = probes.groupBy(*keys, id_col).agg(
        F.sum(F.when(F.col("_kind") == 1, F.col("_before")).otherwise(-F.col("_before"))).alias("events_in_window"),
        F.max("_ts").alias(ts))
    return per_event.filter(F.col("events_in_window") >= min_events) \
                    .select(*keys, id_col, ts, "events_in_window")


def followed_by(first: DataFrame, then: DataFrame, keys: list[str], ts: str, id_col: str, then_ts: str, then_id: str,
                within_ms: int, carry: list[str] | None = None, num_partitions: int | None = None,
                block_rows: int = 8192) -> DataFrame:
    """Ordered pattern: rows of ``first`` that a row of ``then`` of the same key follows within ``within_ms``.

    One row per row of ``first`` with a follower in (t, t + within]: the keys, ``id_col``, ``ts``, the columns ``carry``, how
    many rows follow (``followers``) and the earliest of them (``then_id``, ``then_ts``; ties to the smaller id).
    Rows with a NULL key or time take no part.  (key, time, id) must identify a row of ``first``.

    Both tables are put into one total order (key, time, kind, id).  A row of ``first`` is two probes, at ``t`` and at
    ``t + within``, each behind the rows of ``then`` with that time; the followers are the difference of the rows of
    ``then`` before the two (``global_prefix_count``: range partitions cut into bounded blocks, so a hot key is
    spread over many tasks and nothing pairs its rows).  The rows of ``then`` before the first probe are also
    the rank of the next one, so the earliest follower comes by an equi-join on ranks.
    """
    if num_partitions is None:
        num_partitions = int(first.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def timed(df: DataFrame, col: str) -> DataFrame:
        usable = F.col(col).isNotNull()
        for k in keys:
            usable = usable & F.col(k).isNotNull()
        return df.filter(usable).withColumn("_t", F.unix_micros(F.col(col).cast("timestamp")))

    row = F.struct(F.col(id_col).alias("id"), F.col(ts).alias("ts"), *[F.col(c).alias(c) for c in carry or []])
    next_row = F.struct(F.col(then_id).alias("id"), F.col(then_ts).alias("ts"))
    start, end, come = timed(first, ts), F.col("_t") + F.lit(within_ms * 1000), timed(then, then_ts)
    probes = start.select(*keys, row.alias("_first"), F.explode(F.array(
        F.struct(F.col("_t").alias("at"), F.lit(1).alias("kind")), F.struct(end.alias("at"), F.lit(2).alias("kind"))))
        .alias("_p")).select(*keys, F.col("_p.at").alias("_t"), F.col("_p.kind").alias("_kind"), "_first")
    both = come.select(*keys, "_t", F.lit(0).alias("_kind"), next_row.alias("_then")).unionByName(
        probes, allowMissingColumns=True)
    order = [F.col(k) for k in keys] + [F.col("_t"), F.col("_kind"), F.col("_then"), F.col("_first")]
    counted = global_prefix_count(both, order, F.col("_kind") == 0, num_partitions, block_rows)
    upper = F.col("_kind") == 2
    found = counted.filter(F.col("_kind") != 0).groupBy(*keys, "_first").agg(
        F.sum(F.when(upper, F.col("_before")).otherwise(-F.col("_before"))).alias("followers"),
        F.max(F.when(~upper, F.col("_before"))).alias("_rank")).filter(F.col("followers") > 0)
    ranked = counted.filter(F.col("_kind") == 0).select(F.col("_before").alias("_rank"), "_then")
    return found.join(ranked, "_rank").select(
        *keys, F.col("_first.id").alias(id_col), F.col("_first.ts").alias(ts),
        *[F.col("_first." + c).alias(c) for c in carry or []], "followers",
        F.col("_then.id").alias(then_id), F.col("_then.ts").alias(then_ts))
