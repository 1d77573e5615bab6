"""Streaming forms replayed with availableNow on file sources, compared with the batch operators."""

import os
import random
import tempfile
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from secflow.operators import cdc, findings, rollups
from secflow.operators.anomaly import detect
from secflow.sinks.writers import UpsertLog
from secflow.sources import fixtures as fx
from secflow.streaming import pipelines as P

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _slices(df, order_col, n, spark):
    """Write df as n parquet files in time order; return (dir, schema)."""
    d = tempfile.mkdtemp(prefix="secflow-stream-")
    pdf = df.toPandas().sort_values(order_col, kind="mergesort").reset_index(drop=True)
    size = (len(pdf) + n - 1) // n
    for i in range(n):
        part = pdf.iloc[i * size:(i + 1) * size]
        pq.write_table(pa.Table.from_pandas(part, preserve_index=False), os.path.join(d, f"part-{i:03d}.parquet"),
                       coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(os.path.join(d, f"part-{i:03d}.parquet"), (1_000_000 + i, 1_000_000 + i))
    return d, spark.read.parquet(d).schema


def _uniq(name):
    return f"{name}-{uuid.uuid4().hex}"


def _memory(spark, name):
    return spark.sql(f"SELECT * FROM {name}")


def test_anomaly_stream_equals_batch(spark):
    joined = findings.join_active(*[f(spark, SF) for f in (fx.assets, fx.network_interfaces, fx.asset_cves)]) \
        .withColumn("discovered_at", F.col("discovered_at").cast("timestamp"))
    d, schema = _slices(joined, ["discovered_at", "cve_record_id", "interface_id"], 3, spark)
    stream = P.file_changes(spark, d, schema, max_files=1)
    P.run_available(P.anomaly_stream(stream), _uniq("anomaly_test"), query_name="anomaly_out")
    got = {(r.cve_record_id, r.interface_id): r.is_anomaly for r in _memory(spark, "anomaly_out").collect()}
    batch = detect(spark.read.parquet(d), "cvss_score", "tenant_id", findings.series_order())
    want = {(r.cve_record_id, r.interface_id): r.anomaly.is_anomaly for r in batch.collect()}
    assert len(got) == len(want) and got == want
    assert sum(1 for v in want.values() if v) > 0


def test_burst_stream_equals_batch(spark):
    from secflow.operators import cep
    act = fx.asset_activity(spark, SF).filter("is_suspicious") \
        .withColumn("activity_time", F.col("activity_time").cast("timestamp"))
    d, schema = _slices(act, ["activity_time", "activity_id"], 4, spark)
    P.run_available(P.burst_stream(P.file_changes(spark, d, schema, 1), 86_400_000, 2), _uniq("burst_test"),
                    query_name="burst_out")
    got = {r.activity_id: r.events_in_window for r in _memory(spark, "burst_out").collect()}
    batch = cep.burst(spark.read.parquet(d), ["tenant_id", "asset_id"], "activity_time", "activity_id",
                      86_400_000, 2)
    want = {r.activity_id: r.events_in_window for r in batch.collect()}
    assert got == want and len(want) > 0


def test_stream_of_finer_values_equals_batch_and_forgets_idle_tenants(spark):
    from datetime import datetime, timedelta
    from secflow.operators.anomaly import AnomalyParams
    t0 = datetime(2026, 1, 1)
    rnd = random.Random(3)
    rows = [("t", i, "i", t0 + timedelta(minutes=i), rnd.randrange(3000, 9999) / 1000) for i in range(400)]
    rows += [("gone", i, "i", t0 + timedelta(minutes=i), rnd.randrange(3000, 9999) / 1000) for i in range(40)]
    df = spark.createDataFrame(rows, "tenant_id string, cve_record_id int, interface_id string, "
                                     "discovered_at timestamp, cvss_score double")
    d, schema = _slices(df, ["discovered_at", "cve_record_id"], 4, spark)
    name, params = "finer_" + uuid.uuid4().hex, AnomalyParams(scale=1000)
    stream = P.anomaly_stream(P.file_changes(spark, d, schema, 1), params, watermark="1 minute", idle_ms=3_600_000)
    P.run_available(stream, _uniq("finer"), query_name=name)
    batch = detect(spark.read.parquet(d), "cvss_score", "tenant_id", findings.series_order(), params)
    want = {(r.tenant_id, r.cve_record_id): (r.anomaly.n, r.anomaly.forecast, r.anomaly.is_anomaly)
            for r in batch.collect()}
    got = {(r.tenant_id, r.cve_record_id): (r.n, r.forecast, r.is_anomaly) for r in _memory(spark, name).collect()}
    assert len(got) > 300 and sum(1 for t, _ in got if t == "gone") == 40
    assert {k: (want[k], v) for k, v in got.items() if want[k] != v} == {}
    assert any(f is not None and round(f, 1) != f for _, f, _ in got.values())


def test_latest_state_stream_through_upsert_log(spark):
    ch = fx.assets_cdc(spark, SF)
    d, schema = _slices(ch, "seq", 3, spark)
    log = UpsertLog(tempfile.mkdtemp(prefix="secflow-log-"), ["tenant_id", "asset_id"], ["ts_ms", "seq"])
    P.run_available(P.latest_state_stream(P.file_changes(spark, d, schema, 1)), _uniq("latest_test"), "update",
                    sink=log.write_batch)
    cur = log.current(spark).filter(F.col("op").isin("c", "r", "u") & F.col("after").isNotNull())
    got = sorted((r.tenant_id, r.asset_id, r.seq) for r in cur.collect())
    want = sorted((r.tenant_id, r.asset_id, r.seq) for r in cdc.latest_state(ch).collect())
    assert got == want and len(want) > 0
    # replaying a batch id is idempotent
    before = log.current(spark).count()
    log.write_batch(spark.read.parquet(os.path.join(log.path, "batch_id=0")), 0)
    assert log.current(spark).count() == before
    compacted = log.compact(spark, 99, tempfile.mkdtemp(prefix="secflow-log2-"))
    assert sorted(map(tuple, compacted.current(spark).collect())) == sorted(map(tuple, log.current(spark).collect()))


def test_bi_and_tenant_streams_equal_batch(spark):
    f = findings.ml_scoring(*[g(spark, SF) for g in (fx.assets, fx.network_interfaces, fx.asset_cves)])
    f = f.withColumn("key", F.decode("key", "UTF-8"))
    d, schema = _slices(f, "event_time", 2, spark)
    P.run_available(P.bi_rollup_stream(P.file_changes(spark, d, schema, 1)), _uniq("bi_test"), "complete",
                    query_name="bi_out")
    got = sorted(tuple(r) for r in _memory(spark, "bi_out").collect())
    want = sorted(tuple(r) for r in rollups.bi_rollup(spark.read.parquet(d)).collect())
    assert got == want
    c = fx.asset_cves(spark, SF)
    d2, schema2 = _slices(c, "discovered_at", 2, spark)
    P.run_available(P.tenant_aggs_stream(P.file_changes(spark, d2, schema2, 1)), _uniq("tenant_test"), "complete",
                    query_name="tenant_out")
    got = {r.tenant_id: (r.cve_count, r.critical_cves) for r in _memory(spark, "tenant_out").collect()}
    crit = {r.tenant_id: r.critical_cves for r in rollups.critical_cves(c).collect()}
    tot = {r.tenant_id: r.cve_count for r in rollups.cves_per_tenant(c).collect()}
    assert got == {t: (tot[t], crit.get(t, 0)) for t in tot}


def test_stream_stream_join(spark):
    ents = [fx.assets(spark, SF), fx.network_interfaces(spark, SF), fx.asset_cves(spark, SF)]
    dirs = [_slices(e, e.columns[1], 2, spark) for e in ents]
    streams = [P.file_changes(spark, d, s, 1) for d, s in dirs]
    P.run_available(P.enrichment_stream(*streams), _uniq("join_test"), query_name="join_out")
    assert _memory(spark, "join_out").count() == findings.join_active(*ents).count()


def test_bi_refresh_versions(spark):
    from secflow.sinks.writers import read_latest_version
    f = findings.ml_scoring(*[g(spark, SF) for g in (fx.assets, fx.network_interfaces, fx.asset_cves)])
    f = f.withColumn("key", F.decode("key", "UTF-8"))
    d, schema = _slices(f, ["event_time", "key", "ip_address"], 2, spark)
    out = tempfile.mkdtemp(prefix="secflow-bi-")
    P.run_available(P.bi_rollup_stream(P.file_changes(spark, d, schema, 1)), _uniq("bi_refresh"), "complete",
                    sink=P.bi_refresh_sink(out))
    latest = read_latest_version(spark, out)
    want = rollups.bi_documents(rollups.bi_rollup(spark.read.parquet(d)))
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, want.collect()))
    assert len(os.listdir(out)) == 2


def test_anomaly_stream_with_watermark_reorders_late_rows(spark):
    joined = findings.join_active(*[f(spark, SF) for f in (fx.assets, fx.network_interfaces, fx.asset_cves)]) \
        .withColumn("discovered_at", F.col("discovered_at").cast("timestamp"))
    d, schema = _slices(joined, ["discovered_at", "cve_record_id", "interface_id"], 4, spark)
    # swap the first two files' arrival order: the second slice arrives before the first
    names = sorted(os.listdir(d))
    os.utime(os.path.join(d, names[0]), (1_000_001, 1_000_001))
    os.utime(os.path.join(d, names[1]), (1_000_000, 1_000_000))
    name = "anomaly_wm_out_" + uuid.uuid4().hex
    P.run_available(P.anomaly_stream(P.file_changes(spark, d, schema, 1), watermark="16 days"),
                    _uniq("anomaly_wm"), query_name=name)
    got = {(r.cve_record_id, r.interface_id): r.is_anomaly for r in _memory(spark, name).collect()}
    batch = detect(spark.read.parquet(d), "cvss_score", "tenant_id", findings.series_order())
    want = {(r.cve_record_id, r.interface_id): r.anomaly.is_anomaly for r in batch.collect()}
    assert len(got) > 1000 and sum(1 for v in got.values() if v) > 0
    assert all(want[k] == v for k, v in got.items())


def test_time_bounded_stream_join(spark):
    from datetime import datetime, timedelta
    t0 = datetime(2026, 1, 1)
    a_rows = [("t", "a1", "server", t0), ("t", "a2", "router", t0 + timedelta(days=10))]
    n_rows = [("t", "i1", "a1", "10.0.0.1", True, t0 + timedelta(hours=2)),
              ("t", "i2", "a2", "10.0.0.2", True, t0)]                 # 10 days before its asset: out of bound
    c_rows = [("t", 1, "a1", "CVE-1", 9.8, "CRITICAL", t0, t0 + timedelta(hours=1)),
              ("t", 2, "a2", "CVE-2", 5.0, "MEDIUM", t0, t0 + timedelta(days=10))]
    dirs = []
    for rows, schema in ((a_rows, "tenant_id string, asset_id string, device_type string, change_time timestamp"),
                         (n_rows, "tenant_id string, interface_id string, asset_id string, ip_address string, "
                                  "is_active boolean, change_time timestamp"),
                         (c_rows, "tenant_id string, cve_record_id int, asset_id string, cve_id string, "
                                  "cvss_score double, severity string, discovered_at timestamp, "
                                  "change_time timestamp")):
        d = tempfile.mkdtemp(prefix="secflow-join-")
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(d)
        dirs.append((d, spark.read.parquet(d).schema))
    streams = [P.file_changes(spark, d, s) for d, s in dirs]
    name = "bounded_join_" + uuid.uuid4().hex
    P.run_available(P.enrichment_stream(*streams, time_col="change_time", watermark="1 hour", bound="1 day"),
                    _uniq("bounded_join"), query_name=name)
    got = [(r.asset_id, r.interface_id, r.cve_id) for r in _memory(spark, name).collect()]
    assert got == [("a1", "i1", "CVE-1")]


def test_bi_bulk_upsert_and_update_mode_aggregates(spark):
    from secflow.sinks.writers import count_written
    f = findings.ml_scoring(*[g(spark, SF) for g in (fx.assets, fx.network_interfaces, fx.asset_cves)])
    f = f.withColumn("key", F.decode("key", "UTF-8"))
    d, schema = _slices(f, ["event_time", "key", "ip_address"], 3, spark)
    # B4: every refresh upserts BI documents by _id; replays converge to the batch documents
    log = UpsertLog(tempfile.mkdtemp(prefix="secflow-bi-log-"), ["_id"], ["findings"])
    P.run_available(P.bi_rollup_stream(P.file_changes(spark, d, schema, 1)), _uniq("bi_bulk"), "complete",
                    sink=lambda b, i: log.write_batch(rollups.bi_documents(b), i))
    want = rollups.bi_documents(rollups.bi_rollup(spark.read.parquet(d)))
    assert sorted(map(tuple, log.current(spark).select(*want.columns).collect())) == \
        sorted(map(tuple, want.collect()))
    assert count_written(log.current(spark)).first().indexed_documents == want.count()
    # E9 in update mode: only changed tenants are emitted per batch; the upserted table is the final state
    c = fx.asset_cves(spark, SF)
    d2, schema2 = _slices(c, ["discovered_at", "cve_record_id"], 3, spark)
    tlog = UpsertLog(tempfile.mkdtemp(prefix="secflow-tenant-log-"), ["tenant_id"], ["cve_count"])
    P.run_available(P.tenant_aggs_stream(P.file_changes(spark, d2, schema2, 1)), _uniq("tenant_upd"), "update",
                    sink=tlog.write_batch)
    got = {r.tenant_id: r.cve_count for r in tlog.current(spark).collect()}
    assert got == {r.tenant_id: r.cve_count for r in rollups.cves_per_tenant(c).collect()}


def test_anomaly_foreach_batch_scorer_equals_batch(spark):
    joined = findings.join_active(*[f(spark, SF) for f in (fx.assets, fx.network_interfaces, fx.asset_cves)]) \
        .withColumn("discovered_at", F.col("discovered_at").cast("timestamp"))
    d, schema = _slices(joined, ["discovered_at", "cve_record_id", "interface_id"], 3, spark)
    scorer = P.AnomalyBatchScorer(tempfile.mkdtemp(prefix="secflow-tail-"), tempfile.mkdtemp(prefix="secflow-out-"))
    P.run_available(P.file_changes(spark, d, schema, 1), _uniq("anomaly_fb"), sink=scorer)
    got = {(r.cve_record_id, r.interface_id): r.anomaly.is_anomaly for r in scorer.results(spark).collect()}
    batch = detect(spark.read.parquet(d), "cvss_score", "tenant_id", findings.series_order())
    want = {(r.cve_record_id, r.interface_id): r.anomaly.is_anomaly for r in batch.collect()}
    assert len(got) == len(want) and got == want


def test_bus_sources_fail_clearly_without_connector(spark):
    from pyspark.errors import AnalysisException
    for make in (lambda: P.kafka_records(spark, "localhost:9", "security_findings"),
                 lambda: P.kafka_changes(spark, "localhost:9", "assets", fx_schema())):
        with pytest.raises(AnalysisException) as err:
            make()
        assert "kafka" in str(err.value).lower()


def fx_schema():
    from secflow import schemas as S
    return S.envelope(S.ASSETS, ["tenant_id", "asset_id"])
