"""Values and rows that earlier forms altered or accepted silently."""

import math
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from secflow.functions import keys as K
from secflow.functions.exact import exact_avg
from secflow.operators import contracts, findings, governance
from secflow.operators.anomaly import AnomalyParams, detect, exact_scale, running_stats, scale_metrics
from secflow.operators.enrich import join_entities
from secflow.sinks.writers import UpsertLog, merge_sql


def test_averages_keep_all_decimals(spark):
    df = spark.createDataFrame([(0.123,), (0.126,), (0.947,), (None,), (float("nan"),)], "v double")
    got = df.agg(exact_avg(F.col("v")).alias("a")).first().a
    assert got == pytest.approx((0.123 + 0.126 + 0.947) / 3, abs=1e-15)
    assert df.filter("v is null").agg(exact_avg(F.col("v")).alias("a")).first().a is None
    many = spark.range(20000).select((F.rand(3) * 10).alias("v"))
    r = many.agg(exact_avg(F.col("v")).alias("a"), F.avg("v").alias("b")).first()
    assert r.a == pytest.approx(r.b, rel=1e-12)


@pytest.mark.parametrize("values", [
    [1e14, 1e14], [1e14, 1.0], [math.inf, math.inf, 1.0], [-math.inf, 2.0], [1e-17, 1e-17], [1e-17, 5.0], [1e300, 1e300],
    [0.1] * 10, [7.3, 9.9, 3.0, -4.7], [4095.9, 4096.1], [-0.1, -2.5], [0.0, -0.0], [2.0 ** -60, 3.0], [5e-324, 5e-324]])
def test_averages_of_any_size_are_right(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    got = df.agg(exact_avg(F.col("v")).alias("a")).first().a
    want = sum(values) / len(values)
    assert got == want if math.isinf(want) else got == pytest.approx(math.fsum(values) / len(values), rel=1e-15, abs=0)


def test_infinities_of_both_signs_have_no_average(spark):
    df = spark.createDataFrame([(math.inf,), (-math.inf,)], "v double")
    assert math.isnan(df.agg(exact_avg(F.col("v")).alias("a")).first().a)


def test_average_does_not_depend_on_the_order(spark):
    rows = spark.range(30000).select((F.floor(F.rand(5) * 1000) / 100).alias("v"), F.rand(6).alias("o"))
    got = {rows.orderBy(o).coalesce(n).agg(exact_avg(F.col("v")).alias("a")).first().a
           for o, n in (("o", 1), ("v", 3), (F.col("v").desc(), 8))}
    assert len(got) == 1


@pytest.mark.parametrize("text", [
    "2026-01-02 03:04:05.678", "2026-13-02 03:04:05.678", "2026-1-002 03:04:05.678", " 2026-01-02 03:04:05.67",
    "2026-01-02T03:04:05.678", "2026-01-02 03:04:05.67+", "20260102T030405", "20260102", "2026-01-02",
    "20260102 030405+02:00", "2026", "03:04:05", "", "abc", "2026-01-02 03:04:05.678+05:30", "2026-01-02 3:04:05.6789"])
def test_event_times_of_the_common_form_equal_those_of_the_rare_one(spark, text):
    parsed, padded = (spark.createDataFrame([(t,)], "t string").select(K.parse_event_time(F.col("t")).alias("x")).first().x
                      for t in (text, text + " "))          # the blank behind keeps a text from the common form
    assert parsed == padded
    assert parsed == spark.sql(f"SELECT {K.parse_event_time_sql('t')} AS x FROM VALUES ('{text}') AS v(t)").first().x
    assert (parsed is None) == (text in ("2026-13-02 03:04:05.678", "2026-1-002 03:04:05.678", "2026-01-02 03:04:05.67+",
                                         "2026", "03:04:05", "", "abc"))


def _brute(values, span=100, least=10):
    out = []
    for i, y in enumerate(values):
        pairs = [(values[j - 1], values[j]) for j in range(max(1, i - span), i)]
        n = len(pairs)
        mx, my = (sum(p[k] for p in pairs) / n if n else 0 for k in (0, 1))
        sxx = sum((x - mx) ** 2 for x, _ in pairs)
        if n < least or sxx < 1e-12:
            out.append(None)
            continue
        slope = sum((x - mx) * (v - my) for x, v in pairs) / sxx
        out.append(my - slope * mx + slope * values[i - 1])
    return out


@pytest.mark.parametrize("step,digits", [(0.01, 2), (0.00317, 7)])
def test_anomaly_series_is_not_rounded(spark, step, digits):
    values = [round(5 + step * ((i * 37) % 11) + math.sin(i) * step, digits) for i in range(300)]
    rows = [("t", i, v) for i, v in enumerate(values)] + [("t", 1000, float("nan")), ("t", 1001, None)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    assert (exact_scale(df.agg(*scale_metrics(F.when(~F.isnan("v"), F.col("v")))).first().asDict(), 10) is None) == (digits > 4)
    got = {r.i: r.anomaly.forecast for r in detect(df, "v", "k", [F.col("i")], AnomalyParams(block_rows=128)).collect()}
    for i, want in enumerate(_brute(values)):
        if want is None:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(want, rel=1e-6)
    assert got[1000] is None and got[1001] is None


def test_running_stats_on_fine_values(spark):
    rows = [("a", i, 0.001 * i + 0.0004) for i in range(50)] + [("a", 60, float("nan"))]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    got = {r.i: r for r in running_stats(df, "v", "k", "i", [], block_rows=7).collect()}
    assert got[49].running_avg == pytest.approx(sum(r[2] for r in rows[:50]) / 50, rel=1e-12)
    assert got[49].running_max == rows[49][2] and got[60].running_count == 50


def test_hot_asset_is_split(spark):
    keys = ["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in zip(keys, ["64k", "2", "64k", "-1"], strict=True):
        spark.conf.set(k, v)
    try:
        a = spark.range(200).select(F.lit("t").alias("tenant_id"), F.col("id").cast("string").alias("asset_id"), F.lit("x").alias("d"))
        n = a.select("tenant_id", "asset_id", F.lit("ip").alias("ip"))
        c = spark.range(60000).select(F.lit("t").alias("tenant_id"), F.when(F.col("id") < 57000, "7").otherwise(
            (F.col("id") % 200).cast("string")).alias("asset_id"), F.sha2(F.col("id").cast("string"), 256).alias("cve"))
        j = join_entities(a, n, c, ["d"], ["ip"], ["cve"])
        assert j.count() == 60000
        j.collect()
        assert "skew=true" in j._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lone = spark.createDataFrame([(None, "1", "x")], "tenant_id string, asset_id string, d string")
    assert join_entities(lone, lone.withColumnRenamed("d", "ip"), lone.withColumnRenamed("d", "cve"), ["d"], ["ip"],
                         ["cve"]).count() == 0


@pytest.mark.parametrize("ip,ok", [("::1", True), ("::ffff:1.2.3.4", True), ("fe80::", True), ("1:2:3:4:5:6:7:8", True),
                                   ("::", True), ("1::8", True), ("1:2:3:4:5:6:1.2.3.4", True), ("1:2:3:4:5:6:7::", True),
                                   (":", False), (":1", False), ("1::2:", False), ("1:2:3:4:5:6:7::1:2:3:4", False),
                                   ("1:2:3:4:5:6:7", False), ("1::2::3", False), ("::1.2.3.256", False), ("", False),
                                   ("10.0.0.1", True), ("010.0.0.1", False), ("1:2:3:4:5:6:7:8:9", False)])
def test_ip(spark, ip, ok):
    assert spark.createDataFrame([(ip,)], "ip string").select(contracts.ip_valid("ip").alias("ok")).first().ok == ok


def test_event_time_needs_a_full_date(spark):
    rows = [("12:30:00", False), ("T10:00", False), ("2024", False), ("20240101T101010", True), ("", False), ("junk", False),
            ("2024-01-01 10:11:12.5", True), ("2024-01-01", True), ("2024-01-01T23:30:00-05:00", True), ("2024-13-01", False)]
    got = spark.createDataFrame([r[:1] for r in rows], "t string").select(
        "t", K.normalize_event_time(F.col("t")).alias("n")).collect()
    assert {r.t: r.n is not None for r in got} == dict(rows)
    by = {r.t: r.n for r in got}
    assert by["20240101T101010"] == "2024-01-01T10:10:10.000000Z"
    assert by["2024-01-01T23:30:00-05:00"] == "2024-01-02T04:30:00.000000Z"


def _finding(key, time, ip):
    return (key.encode() if key else None, "t", "a", "d", ip, "c", 5.0, "LOW", 0.5, "f", "LOW", "m", time)


FINDING = ("key binary, tenant_id string, asset_id string, device_type string, ip_address string, cve_id string, cvss_score "
           "double, severity string, anomaly_score double, finding_type string, predicted_risk string, model_version "
           "string, event_time string")


def test_versions_are_ordered_by_instant_in_batch_and_log(spark):
    rows = [_finding("k", "2024-01-01T23:30:00-05:00", "newest"), _finding("k", "2024-01-02T00:00:00.000Z", "old"),
            _finding("k", "2024-01-01 05:00:00", "older"), _finding(None, "2024-01-05", "no key")]
    df = spark.createDataFrame(rows, FINDING)
    want = [r.ip_address for r in findings.upsert_latest(df).collect()]
    assert want == ["newest"]
    log = UpsertLog(tempfile.mkdtemp(prefix="secflow-log-"), ["key"], findings.UPSERT_ORDER)
    with pytest.raises(FileNotFoundError):
        log.current(spark)
    for b, r in enumerate(rows):                       # the newest event arrives first
        log.write_batch(spark.createDataFrame([r], FINDING), b)
    log.write_batch(spark.createDataFrame([rows[1]], FINDING), 0)      # a replayed batch id changes nothing
    cur = log.current(spark).collect()
    assert [r.ip_address for r in cur] == want
    import os
    os.makedirs(os.path.join(log.path, "batch_id=9"))                  # a half-written batch is not read
    assert [r.ip_address for r in log.current(spark).collect()] == want
    assert "WHEN NOT MATCHED" in merge_sql("f", "s", ["key"], df.columns)


def test_retention_in_hours(spark):
    meta = spark.createDataFrame([("a", ("48-hours",)), ("a", ("48-hours",)), ("b", ("36-hours",))],
                                 "topic string, labels struct<retention:string>")
    ts = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 2, 13),), (datetime(2024, 1, 3),)],
                               "ts timestamp_ntz")
    got = {r.topic: (r.rows, r.expired_rows) for r in governance.retention_expired(
        meta, {"a": ts, "b": ts}, "2024-01-04 00:00:00").collect()}
    assert got == {"a": (3, 1), "b": (3, 1)}


def test_no_private_folder_on_a_cluster(spark, monkeypatch):
    import secflow.session as session

    class Context:
        master, applicationId = "spark://host:7077", "x"

        @staticmethod
        def getConf():
            return {}

    class Session:
        class conf:
            get = staticmethod(lambda k, d=None: d)

    monkeypatch.setattr(session, "_context", lambda s: Context)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session)


def test_scorer_leaves_a_constant_number_of_folders(spark):
    import os

    from secflow.session import materialized_count
    from secflow.streaming.pipelines import AnomalyBatchScorer
    state, out = (tempfile.mkdtemp(prefix="secflow-scorer-") for _ in range(2))
    scorer, before = AnomalyBatchScorer(state, out), materialized_count()
    for b in range(5):
        rows = [("t", b * 20 + i, str(i), datetime(2024, 1, 1 + b, i), 0.1 * ((i * 7) % 50)) for i in range(20)]
        scorer(spark.createDataFrame(rows, "tenant_id string, cve_record_id long, interface_id string, "
                                           "discovered_at timestamp, cvss_score double"), b)
        assert materialized_count() == before
        assert len([d for d in os.listdir(state) if d.startswith("tail_batch=")]) <= 2
    assert scorer.results(spark).count() == 100


def test_findings_upsert_stream_equals_batch(spark, tmp_path):
    from secflow.streaming.pipelines import file_changes, findings_upsert_stream
    rows = [("t", str(i % 4), "d", f"10.0.0.{i}", f"CVE-{i % 3}", float(i % 10), "LOW",
             datetime(2024, 1, 1 + (i * 5) % 28), (i % 2 == 0,)) for i in range(40)]
    schema = ("tenant_id string, asset_id string, device_type string, ip_address string, cve_id string, cvss_score double, "
              "severity string, discovered_at timestamp, anomaly struct<is_anomaly:boolean>")
    src = str(tmp_path / "src")
    df = spark.createDataFrame(rows, schema)
    for k in range(4):                                  # several micro-batches, newest events not last
        df.filter(F.dayofmonth("discovered_at") % 4 == k).coalesce(1).write.mode("append").parquet(src)
    log = UpsertLog(str(tmp_path / "log"), ["key"], findings.UPSERT_ORDER)
    findings_upsert_stream(file_changes(spark, src, df.schema, max_files=1), log)
    want = sorted(tuple(r) for r in findings.upsert_latest(findings.score(df)).collect())
    assert sorted(tuple(r) for r in log.current(spark).collect()) == want
