"""Stream operators on typed state with timers: any order of arrival gives the batch operators' rows."""

import os
import random
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from secflow.operators import cep, findings
from secflow.operators.anomaly import AnomalyParams, detect
from secflow.streaming import pipelines as P
from secflow.streaming import stateful

T0 = datetime(2026, 1, 1)
SERIES = "tenant_id string, cve_record_id int, interface_id string, discovered_at timestamp, cvss_score double"
EVENTS = "tenant_id string, asset_id string, activity_id long, activity_time timestamp"


def run(spark, tmp_path, batches, schema, build):
    """Feed one file per micro-batch; returns the rows and the query."""
    src = tmp_path / uuid.uuid4().hex
    known = set()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        for p in set(src.glob("*.parquet")) - known:
            os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))       # files are taken in the order of their times
            known.add(p)
    stream = build(P.file_changes(spark, str(src), spark.read.parquet(str(src)).schema, 1))
    name = "t" + uuid.uuid4().hex
    q = (stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name))
         .outputMode("append").trigger(availableNow=True).start())
    assert q.awaitTermination(240)
    return spark.table(name).collect(), q, spark.read.parquet(str(src))


def shuffled(rows, time_at, parts, spread, rnd):
    """Rows in micro-batches by time, each moved by less than ``spread``: late by arrival, not by the watermark."""
    moved = sorted(rows, key=lambda r: r[time_at] + spread * rnd.random())
    size = -(-len(moved) // parts)
    return [moved[i:i + size] for i in range(0, len(moved), size)]


def state_rows(q):
    """Keys with state after the last micro-batch, over the operator's state stores."""
    return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators][-1]


def test_anomaly_state_equals_batch_in_any_order(spark, tmp_path):
    rnd = random.Random(4)
    value = lambda: None if rnd.random() < 0.05 else rnd.randrange(3000, 9999) / 1000
    rows = [("hot", i, rnd.choice("ab"), T0 + timedelta(minutes=i // 2), value()) for i in range(200)]
    rows += [("old", i, "i", T0 + timedelta(minutes=i), value()) for i in range(30)]
    flush = [("end", 0, "i", T0 + timedelta(days=2), 5.0)]
    batches = shuffled(rows, 3, 3, timedelta(minutes=20), rnd) + [flush]
    assert sum(batches, []) != sorted(rows, key=lambda r: r[3]) + flush
    params = AnomalyParams(min_training_size=5, max_training_size=20, scale=1000, block_rows=64)
    got, q, seen = run(spark, tmp_path, batches, SERIES, lambda s: stateful.anomaly_state_stream(
        s, "25 minutes", params, idle_ms=6 * 3_600_000))
    batch = detect(seen, "cvss_score", "tenant_id", findings.series_order(), params)
    want = {(r.tenant_id, r.cve_record_id): (r.discovered_at, r.anomaly.n, r.anomaly.forecast, r.anomaly.is_anomaly)
            for r in batch.collect() if r.tenant_id != "end"}
    have = {(r.tenant_id, r.cve_record_id): (r.discovered_at, r.n, r.forecast, r.is_anomaly) for r in got}
    assert len(got) == len(want) == 230 and have == want
    assert sum(1 for v in want.values() if v[3]) > 0
    # Tenants of two days ago are forgotten: what is left is the last tenant's waiting row.
    assert state_rows(q) < 20


def test_burst_state_equals_batch_in_any_order(spark, tmp_path):
    rnd = random.Random(7)
    rows = [("t", rnd.choice(["a", "a", "b", "c"]), i, T0 + timedelta(minutes=rnd.randrange(300))) for i in range(120)]
    batches = shuffled(rows, 3, 3, timedelta(minutes=15), rnd) + [[("t", "end", 999, T0 + timedelta(days=1))]]
    got, q, seen = run(spark, tmp_path, batches, EVENTS, lambda s: stateful.burst_state_stream(
        s, 20 * 60_000, 4, "16 minutes"))
    want = cep.burst(seen, ["tenant_id", "asset_id"], "activity_time", "activity_id", 20 * 60_000, 4).collect()
    key = lambda r: (r.asset_id, r.activity_id, r.activity_time, r.events_in_window)
    assert want and sorted(map(key, got)) == sorted(map(key, want))
    assert state_rows(q) < 10


def test_rows_without_time_are_left_out(spark, tmp_path):
    rows = [("t", "a", i, T0) for i in range(3)] + [("t", "a", 9, None)]
    got, _, _ = run(spark, tmp_path, [rows, [("t", "z", 5, T0 + timedelta(days=1))]], EVENTS,
                    lambda s: stateful.burst_state_stream(s, 60_000, 3, "1 minute"))
    assert sorted((r.activity_id, r.events_in_window) for r in got) == [(0, 3), (1, 3), (2, 3)]
