"""Change envelopes, finding documents and sink semantics on edge rows."""

from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.functions import keys as K
from secflow.operators import cdc, findings, rollups

ENV = ("key struct<tenant_id:string,asset_id:string>, "
       "after struct<tenant_id:string,asset_id:string,risk_level:string>, op string, ts_ms long, seq long")


def _changes(spark, rows):
    out = []
    for t, a, op, ts, seq, risk, has_after in rows:
        out.append(((t, a), (t, a, risk) if has_after else None, op, ts, seq))
    return spark.createDataFrame(out, ENV)


def test_view_filters_deletes_and_unknown_ops(spark):
    ch = _changes(spark, [("t", "1", "d", 1, 1, None, False), ("t", "2", "u", 2, 2, None, False),
                          ("t", "3", "t", 3, 3, "LOW", True), ("t", "4", "c", 4, 4, "LOW", True)])
    assert [r.asset_id for r in cdc.current_rows(ch).collect()] == ["4"]


def test_versions_and_latest_state(spark):
    ch = _changes(spark, [("t", "1", "c", 1, 1, "LOW", True), ("t", "1", "u", 2, 2, "MEDIUM", True),
                          ("t", "1", "u", 2, 3, "HIGH", True),
                          ("t", "2", "c", 1, 4, "LOW", True), ("t", "2", "d", 5, 5, None, False)])
    assert cdc.current_rows(ch).filter("asset_id = '1'").count() == 3
    latest = {r.asset_id: r for r in cdc.latest_state(ch).collect()}
    assert set(latest) == {"1"} and latest["1"].risk_level == "HIGH" and latest["1"].seq == 3
    assert [r.asset_id for r in cdc.deleted_keys(ch).collect()] == ["2"]


def test_event_time_normalization(spark):
    df = spark.createDataFrame([("2026-08-27 10:30:00",), ("2026-08-27T10:30:00Z",),
                                ("2026-08-27T10:30:00+02:00",), ("",), ("junk",), (None,)], "event_time string")
    got = [r.normalized for r in findings.normalize_times(df).collect()]
    assert got == ["2026-08-27T10:30:00.000000Z", "2026-08-27T10:30:00.000000Z", "2026-08-27T08:30:00.000000Z",
                   None, None, None]


def _finding(key_parts=("t", "a", "CVE-1"), severity="HIGH", event_time="2026-08-27 10:30:00.000",
             risk="HIGH", ip="10.0.0.1"):
    t, a, c = key_parts
    return (f"{t}|{a}|{c}".encode(), t, a, "server", ip, c, 7.5, severity, 0.75,
            S.FINDING_TYPE_ML, risk, S.MODEL_VERSION_ML, event_time)


def test_documents_dedupe_and_skip(spark):
    rows = [_finding(), _finding(), _finding(event_time=""), _finding(event_time="junk"),
            _finding(risk="CRITICAL")]
    docs = findings.documents(spark.createDataFrame(rows, S.FINDING))
    assert docs.count() == 2
    ids = {r._id for r in docs.collect()}
    assert len(ids) == 2
    import hashlib
    want = hashlib.sha256("t|a|CVE-1|2026-08-27T10:30:00.000000Z|HIGH".encode()).hexdigest()
    assert want in ids


def test_exists_filter_keeps_empty_severity(spark):
    rows = [_finding(severity=""), _finding(("t", "b", "CVE-2"), severity=None)]
    docs = findings.documents(spark.createDataFrame(rows, S.FINDING))
    kept = findings.purge_missing_severity(docs).collect()
    assert len(kept) == 1 and kept[0].severity == ""
    topn = rollups.bi_rollup_topn(docs).collect()
    assert len(topn) == 1 and topn[0].severity == ""


def test_window_boundaries(spark):
    rows = [_finding(event_time="2026-08-27 10:09:59.999"), _finding(("t", "b", "C"), event_time="2026-08-27 10:10:00.000")]
    bi = rollups.bi_documents(rollups.bi_rollup(spark.createDataFrame(rows, S.FINDING))).collect()
    assert sorted(r.window_start for r in bi) == ["2026-08-27T10:00:00Z", "2026-08-27T10:10:00Z"]
    assert {r.window_end for r in bi} == {"2026-08-27T10:10:00Z", "2026-08-27T10:20:00Z"}


def test_bi_doc_id_none_text(spark):
    import hashlib
    df = spark.createDataFrame([("2026-08-27T10:00:00Z", "t", None, "LOW")],
                               "w string, t string, s string, r string")
    got = df.select(K.bi_doc_id(F.col("w"), F.col("t"), F.col("s"), F.col("r")).alias("id")).first().id
    assert got == hashlib.sha256(b"2026-08-27T10:00:00Z|t|None|LOW").hexdigest()


def test_retention_and_last_hours(spark):
    rows = [_finding(event_time="2026-08-20 10:00:00.000"), _finding(("t", "b", "C"), event_time="2026-08-27 09:00:00.000")]
    f = spark.createDataFrame(rows, S.FINDING)
    assert findings.retention(f, "2026-08-27 10:30:00").count() == 1
    assert findings.last_hours(findings.documents(f), "2026-08-27 10:30:00", 24).count() == 1


def test_upsert_is_idempotent(spark):
    rows = [_finding(), _finding(event_time="2026-08-27 11:00:00.000", risk="CRITICAL")]
    f = spark.createDataFrame(rows, S.FINDING)
    once = findings.upsert_latest(f)
    twice = findings.upsert_latest(once.unionByName(f))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.first().predicted_risk == "CRITICAL"


def test_top_n_ties_by_key(spark):
    rows = [(s,) for s in ["A", "B", "C", "D", "E", "F", "G"] for _ in range(3)]
    df = spark.createDataFrame(rows, "severity string")
    assert [r.severity for r in rollups.top_n(df, "severity", 5).collect()] == ["A", "B", "C", "D", "E"]


def test_apply_changes_to_snapshot(spark):
    snap = spark.createDataFrame([("t", "1", "server", "LOW"), ("t", "2", "router", "LOW"),
                                  ("t", "3", "switch", "MEDIUM")],
                                 "tenant_id string, asset_id string, device_type string, risk_level string")
    ch = _changes(spark, [("t", "1", "u", 5, 1, "HIGH", True), ("t", "1", "u", 3, 2, "MEDIUM", True),
                          ("t", "2", "d", 4, 3, None, False)])
    cur = {r.asset_id: (r.device_type, r.risk_level)
           for r in cdc.apply_changes(snap, ch, ["tenant_id", "asset_id"]).collect()}
    assert cur == {"1": ("server", "HIGH"), "3": ("switch", "MEDIUM")}


def test_nested_topn_tenant_cut_with_salts(spark):
    rows = []
    counts = {"t1": 5, "t2": 3, "t3": 3, "t4": 1, "t5": 4}
    for t, k in counts.items():
        for i in range(k):
            rows.append(_finding((t, f"a{i}", f"CVE-{i}"), event_time="2026-08-27 10:01:00.000"))
    docs = findings.documents(spark.createDataFrame(rows, S.FINDING))
    kept = rollups.bi_rollup_topn(docs, tenants=2, salts=4).collect()
    assert sorted({r.tenant_id for r in kept}) == ["t1", "t5"]
    kept3 = rollups.bi_rollup_topn(docs, tenants=3, salts=4).collect()
    assert sorted({r.tenant_id for r in kept3}) == ["t1", "t2", "t5"]   # t2 before t3 on the key tie-break


def test_nested_topn_counts_docs_lacking_deeper_keys(spark):
    rows = [_finding(("A", f"a{i}", f"C{i}"), risk=None, event_time="2026-08-27 10:01:00.000") for i in range(2)]
    rows += [_finding(("A", "a9", "C9"), event_time="2026-08-27 10:01:00.000")]
    rows += [_finding(("B", f"b{i}", f"D{i}"), event_time="2026-08-27 10:01:00.000") for i in range(2)]
    docs = findings.documents(spark.createDataFrame(rows, S.FINDING))
    kept = rollups.bi_rollup_topn(docs, tenants=1).collect()
    # A has 3 documents (2 without a risk) and outranks B (2); only A's one risk bucket is emitted
    assert [(r.tenant_id, r.findings) for r in kept] == [("A", 1)]


def test_rollup_drops_unparsable_event_time(spark):
    rows = [_finding(event_time="junk"), _finding(("t", "b", "C"), event_time=""),
            _finding(("t", "c", "D"), event_time="2026-08-27 10:05:00.000")]
    bi = rollups.bi_rollup(spark.createDataFrame(rows, S.FINDING)).collect()
    assert len(bi) == 1 and bi[0].findings == 1
