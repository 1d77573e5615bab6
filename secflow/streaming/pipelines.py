"""Structured Streaming forms of the pipeline.

Sources are change streams in envelope form.  On a cluster they come from the
message bus (``kafka_changes``); tests and offline replays use a file source
with the same schema (``file_changes``).  Both start from the earliest data.
Checkpoints go under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from secflow import schemas as S
from secflow.operators import enrich, findings, rollups
from secflow.operators.anomaly import AnomalyParams
from secflow.session import scratch_path, ship_package
from secflow.streaming.scorer import score_points


# --- sources ----------------------------------------------------------------------------

def file_changes(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def kafka_records(spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None) -> DataFrame:
    """Raw records of a bus topic from the earliest offset (key, value, topic, partition, offset,
    timestamp); framed protobuf findings go on to ``decode.decode_findings``."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load()


def kafka_changes(spark: SparkSession, servers: str, topic: str, value_schema: T.StructType,
                  max_offsets: int | None = None) -> DataFrame:
    """Change topic from the message bus, from the earliest offset; JSON values decoded with
    ``from_json`` (NULL for undecodable records, which the view then drops)."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", "earliest"))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    raw = reader.load()
    return raw.select(F.from_json(F.col("value").cast("string"), value_schema).alias("v")).select("v.*")


def checkpoint(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"streams/{name}")


# --- stateless / aggregate streams --------------------------------------------------------

def enrichment_stream(assets: DataFrame, interfaces: DataFrame, cves: DataFrame,
                      time_col: str | None = None, watermark: str | None = None,
                      bound: str | None = None) -> DataFrame:
    """Stream-stream inner joins of the three entity views (append mode).

    Default: unbounded, like the modelled views: every row version joins (no
    retraction) and join state is kept forever.  With ``time_col`` (each view's
    change time), ``watermark`` and ``bound`` the interface and CVE versions must
    lie within ``bound`` of the asset version; Spark can then evict join state
    older than watermark minus bound, so state stays proportional to the
    change rate instead of the history.
    """
    if time_col is None:
        return enrich.join_active(assets, interfaces, cves)
    keys = ["tenant_id", "asset_id"]
    a = assets.withWatermark(time_col, watermark).select(
        *keys, "device_type", F.col(time_col).alias("_ta"))
    n = interfaces.filter(F.col("is_active") == F.lit(True)).withWatermark(time_col, watermark).select(
        F.col("tenant_id").alias("_nt"), F.col("asset_id").alias("_na"), "interface_id", "ip_address",
        F.col(time_col).alias("_tn"))
    c = cves.withWatermark(time_col, watermark).select(
        F.col("tenant_id").alias("_ct"), F.col("asset_id").alias("_ca"), "cve_record_id", "cve_id", "cvss_score",
        "severity", "discovered_at", F.col(time_col).alias("_tc"))
    span = F.expr(f"INTERVAL {bound}")
    an = a.join(n, (a.tenant_id == n._nt) & (a.asset_id == n._na)
                & n._tn.between(a._ta - span, a._ta + span))
    anc = an.join(c, (an.tenant_id == c._ct) & (an.asset_id == c._ca)
                  & c._tc.between(an._ta - span, an._ta + span))
    return anc.select(*keys, "device_type", "interface_id", "ip_address", "cve_record_id", "cve_id",
                      "cvss_score", "severity", "discovered_at")


def tenant_aggs_stream(cves: DataFrame) -> DataFrame:
    """Continuously updated per-tenant CVE aggregates (``update``/``complete`` output)."""
    return cves.groupBy("tenant_id").agg(
        F.count(F.lit(1)).alias("cve_count"),
        F.count(F.when(F.col("severity") == "CRITICAL", 1)).alias("critical_cves"),
        rollups.avg_cvss().alias("avg_cvss"))


def bi_rollup_stream(findings_stream: DataFrame, width: str = S.BI_WINDOW) -> DataFrame:
    """The BI rollup as a streaming aggregation; run in ``complete`` mode on a processing-time
    trigger and written with a full rebuild per refresh."""
    return rollups.bi_rollup(findings_stream, width)


def latest_state_stream(changes: DataFrame) -> DataFrame:
    """Latest version per key as a streaming aggregation (``update`` mode)."""
    key_fields = [f.name for f in changes.schema["key"].dataType.fields]
    packed = F.struct("ts_ms", "seq", "op", "after")
    return changes.groupBy(*[F.col("key." + k).alias(k) for k in key_fields]).agg(F.max(packed).alias("_v")) \
                  .select(*key_fields, F.col("_v.op").alias("op"), F.col("_v.ts_ms").alias("ts_ms"),
                          F.col("_v.seq").alias("seq"), F.col("_v.after").alias("after"))


# --- online anomaly scoring (stateful, per tenant) ------------------------------------------

ANOMALY_OUT = T.StructType([
    T.StructField("tenant_id", T.StringType()),
    T.StructField("cve_record_id", T.IntegerType()),
    T.StructField("interface_id", T.StringType()),
    T.StructField("discovered_at", T.TimestampType()),
    T.StructField("cvss_score", T.DoubleType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("forecast", T.DoubleType()),
    T.StructField("is_anomaly", T.BooleanType()),
])
ANOMALY_STATE = T.StructType([T.StructField("history", T.StringType()),
                              T.StructField("pending", T.StringType())])
_PENDING_COLS = ["tenant_id", "cve_record_id", "interface_id", "discovered_at", "cvss_score"]


def anomaly_stream(joined: DataFrame, params: AnomalyParams = AnomalyParams(),
                   watermark: str | None = None, idle_ms: int | None = None) -> DataFrame:
    """Online scoring of the joined series with per-tenant state.

    State per tenant: the last ``max_training_size + 1`` series values, plus the
    rows still waiting for the watermark.  Without ``watermark`` every
    micro-batch is scored at once after the tenant's history (input must then
    arrive in time order).  With ``watermark`` (e.g. ``"10 minutes"``) rows wait
    until the event-time watermark passes them and are then scored in series
    order, so arrival order within the allowed lateness does not matter; an
    event-time timeout scores waiting rows when no new data arrives.  A tenant without rows for ``idle_ms`` of event
    time after its last one is forgotten (with ``watermark``).  Values are not rounded.
    """
    use_wm = watermark is not None

    def order(pdf):
        pdf = pdf.copy()
        pdf["_null"] = pdf["cvss_score"].isna()
        pdf["_ms"] = pd.to_datetime(pdf["discovered_at"]).dt.floor("ms")
        return pdf.sort_values(["_null", "_ms", "cve_record_id", "interface_id"], kind="mergesort")

    def fn(key, pdfs, state):
        if state.hasTimedOut and not state.get[1]:
            state.remove()
            return
        if state.exists:
            hist = json.loads(state.get[0])
            pending = pd.DataFrame(json.loads(state.get[1]), columns=_PENDING_COLS) if state.get[1] else None
        else:
            hist, pending = [], None
        frames = [p for p in pdfs if len(p)]
        if pending is not None and len(pending):
            pending["discovered_at"] = pd.to_datetime(pending["discovered_at"], unit="us")
            frames.insert(0, pending)
        pdf = pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=_PENDING_COLS)
        pdf = pdf[_PENDING_COLS]
        if use_wm:
            wm = state.getCurrentWatermarkMs()
            ts_ms = pd.to_datetime(pdf["discovered_at"]).astype("int64") // 1_000_000
            ready, wait = pdf[ts_ms <= wm], pdf[ts_ms > wm]
        else:
            ready, wait = pdf, pdf.iloc[0:0]
        ready = order(ready)
        ys = [None if pd.isna(v) else float(v) for v in ready["cvss_score"]]
        scored, hist = score_points(hist, ys, params)
        if len(wait):
            w = wait.copy()
            w["discovered_at"] = pd.to_datetime(w["discovered_at"]).astype("int64") // 1000
            # Python's JSON keeps every bit of a double; pandas' own form would round it.
            rows = [[None if pd.isna(v) else v for v in r] for r in w.astype(object).itertuples(index=False, name=None)]
            state.update((json.dumps(hist), json.dumps(rows)))
            state.setTimeoutTimestamp(int(w["discovered_at"].min() // 1000) + 1)
        else:
            state.update((json.dumps(hist), ""))
            if use_wm and idle_ms is not None:
                newest = int(pd.to_datetime(ready["discovered_at"]).astype("int64").max() // 1_000_000) if len(ready) else 0
                state.setTimeoutTimestamp(max(newest + idle_ms, wm + 1))
        yield pd.DataFrame({
            "tenant_id": ready["tenant_id"].values, "cve_record_id": ready["cve_record_id"].values,
            "interface_id": ready["interface_id"].values, "discovered_at": ready["discovered_at"].values,
            "cvss_score": ready["cvss_score"].values,
            "n": pd.array([s[0] for s in scored], dtype="Int32"),
            "forecast": [s[1] for s in scored],
            "is_anomaly": pd.array([s[2] for s in scored], dtype="boolean"),
        })

    ship_package(joined.sparkSession)
    src = joined.select("tenant_id", "cve_record_id", "interface_id",
                        F.col("discovered_at").cast("timestamp").alias("discovered_at"), "cvss_score")
    timeout = GroupStateTimeout.NoTimeout
    if use_wm:
        src = src.withWatermark("discovered_at", watermark)
        timeout = GroupStateTimeout.EventTimeTimeout
    return src.groupBy("tenant_id").applyInPandasWithState(fn, ANOMALY_OUT, ANOMALY_STATE, "append", timeout)


class AnomalyBatchScorer:
    """``foreachBatch`` form of the online model that keeps every task bounded.

    Each micro-batch is scored with the distributed batch operator on
    (tail of earlier points) + (new rows).  The tail is a small table with the
    last ``max_training_size + 1`` series points per tenant, written per batch
    id under ``state_path``; it is chosen with global positions and a per-tenant
    max (partial aggregation), not with a per-tenant window.  Scored rows are
    written per batch id under ``out_path``.  Batch ``b`` reads the tail of
    ``b - 1`` and overwrites its own outputs, so a replayed batch gives the same
    result.  Rows must arrive in series order across batches (as for the
    unbuffered state form).
    """

    COLS = ["tenant_id", "cve_record_id", "interface_id", "discovered_at", "cvss_score"]

    def __init__(self, state_path: str, out_path: str, params: AnomalyParams = AnomalyParams()):
        self.state_path, self.out_path, self.params = state_path, out_path, params

    def _tail_dir(self, batch_id: int) -> str:
        return os.path.join(self.state_path, f"tail_batch={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from secflow.operators.anomaly import detect, global_positions
        from secflow.session import materialized_count, release_materialized
        spark, mark = batch.sparkSession, materialized_count()
        new = batch.select(*[F.col(c).cast("timestamp").alias(c) if c == "discovered_at" else F.col(c)
                             for c in self.COLS]).withColumn("_hist", F.lit(False))
        prev = self._previous_tail(spark, batch_id)
        if prev is None:
            combined = new
        else:
            hist = spark.read.parquet(prev).select(*self.COLS).withColumn("_hist", F.lit(True))
            combined = hist.unionByName(new)
        order = findings.series_order()
        scored = detect(combined, "cvss_score", "tenant_id", order, self.params)
        scored.filter(~F.col("_hist")).drop("_hist").write.mode("overwrite").parquet(
            os.path.join(self.out_path, f"batch_id={batch_id}"))
        series = combined.filter(F.col("cvss_score").isNotNull())
        pos = global_positions(series, [F.col("tenant_id")] + order, int(spark.conf.get("spark.sql.shuffle.partitions")))
        last = pos.groupBy("tenant_id").agg(F.max("_g").alias("_last"))
        keep = self.params.max_training_size + 1
        tail = pos.join(last, "tenant_id").filter(F.col("_g") > F.col("_last") - keep).select(*self.COLS)
        tail.write.mode("overwrite").parquet(self._tail_dir(batch_id))
        # A running stream keeps only the tails that a replay of this batch or the next one reads.
        release_materialized(spark, since=mark)
        self._drop_tails(spark, before=batch_id - 1)

    def _drop_tails(self, spark: SparkSession, before: int) -> None:
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.state_path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("tail_batch=") and int(name.split("=", 1)[1]) < before:
                fs.delete(st.getPath(), True)

    def _previous_tail(self, spark: SparkSession, batch_id: int) -> str | None:
        """Newest complete tail written by an earlier batch (listing via the Hadoop FileSystem API)."""
        jvm = spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.state_path)
        fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        best = None
        if fs.exists(root):
            for st in fs.listStatus(root):
                name = st.getPath().getName()
                if name.startswith("tail_batch=") and \
                        fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                    b = int(name.split("=", 1)[1])
                    if b < batch_id and (best is None or b > best[0]):
                        best = (b, st.getPath().toString())
        return best[1] if best else None

    def results(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.out_path)


# --- burst pattern (stateful, per asset) ---------------------------------------------------

BURST_OUT = T.StructType([
    T.StructField("tenant_id", T.StringType()),
    T.StructField("asset_id", T.StringType()),
    T.StructField("activity_id", T.LongType()),
    T.StructField("activity_time", T.TimestampType()),
    T.StructField("events_in_window", T.LongType()),
])
BURST_STATE = T.StructType([T.StructField("recent_us", T.StringType())])


def burst_stream(events: DataFrame, window_ms: int, min_events: int, watermark: str | None = None) -> DataFrame:
    """Streaming burst alerts: state per asset = event times inside the last window.

    With ``watermark`` an asset's state goes when event time has passed its window; without it, state stays.
    """
    w_us = window_ms * 1000

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            state.remove()
            return
        recent = json.loads(state.get[0]) if state.exists else []
        pdf = pd.concat(list(pdfs), ignore_index=True)
        pdf["_t"] = pd.to_datetime(pdf["activity_time"]).astype("int64") // 1000
        pdf = pdf.sort_values(["_t", "activity_id"], kind="mergesort")
        times = np.array(sorted(recent + pdf["_t"].tolist()), dtype=np.int64)
        lo = np.searchsorted(times, pdf["_t"].values - w_us, side="left")
        hi = np.searchsorted(times, pdf["_t"].values, side="right")
        pdf["events_in_window"] = hi - lo
        newest = int(times[-1]) if len(times) else 0
        state.update((json.dumps([int(t) for t in times if t >= newest - w_us]),))
        if watermark is not None:
            state.setTimeoutTimestamp(max((newest + w_us) // 1000, state.getCurrentWatermarkMs()) + 1)
        hit = pdf[pdf["events_in_window"] >= min_events]
        yield hit[["tenant_id", "asset_id", "activity_id", "activity_time", "events_in_window"]]

    ship_package(events.sparkSession)
    src = events.select("tenant_id", "asset_id", "activity_id", F.col("activity_time").cast("timestamp"))
    timeout = GroupStateTimeout.NoTimeout
    if watermark is not None:
        src, timeout = src.withWatermark("activity_time", watermark), GroupStateTimeout.EventTimeTimeout
    return src.groupBy("tenant_id", "asset_id").applyInPandasWithState(fn, BURST_OUT, BURST_STATE, "append", timeout)


# --- runners -------------------------------------------------------------------------------

def run_available(df: DataFrame, name: str, mode: str = "append", sink=None, query_name: str | None = None):
    """Process everything available now, then stop (batch-like replay of a stream)."""
    spark = df.sparkSession
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint(spark, name))
    if sink is not None:
        w = w.foreachBatch(sink)
    else:
        w = w.format("memory").queryName(query_name or name)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def bi_refresh_sink(path: str):
    """``foreachBatch`` target for the periodic BI refresh: each complete-mode result is written
    as a new version directory (batch id), readers take the newest complete version."""
    from secflow.sinks.writers import write_full_rebuild

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_full_rebuild(rollups.bi_documents(batch), path, batch_id)
    return sink


def start_bi_refresh(findings_stream: DataFrame, path: str, every: str = "30 seconds", name: str = "bi_refresh"):
    """Continuous BI refresh: complete-mode rollup on a processing-time trigger."""
    spark = findings_stream.sparkSession
    return (bi_rollup_stream(findings_stream).writeStream.outputMode("complete")
            .option("checkpointLocation", checkpoint(spark, name))
            .foreachBatch(bi_refresh_sink(path)).trigger(processingTime=every).start())


def findings_upsert_stream(scored: DataFrame, log) -> None:
    """Score projection of streamed rows written through the idempotent upsert log."""
    run_available(findings.score(scored), "findings_upsert", "append", sink=log.write_batch)

