"""Three-way join rules on hand-written edge rows."""

from pyspark.sql import functions as F

from secflow.operators import enrich, findings
from tests.helpers import assets_df, cves_df, interfaces_df

AS_OF = "2026-08-27 10:30:00"


def _one(spark, risk="HIGH", active=True, cvss=9.8, severity="CRITICAL", quarantined=False):
    a = assets_df(spark, [("t1", "a1", "server", risk, quarantined)])
    n = interfaces_df(spark, [("t1", "i1", "a1", "10.0.0.1", active)])
    c = cves_df(spark, [("t1", 1, "a1", "CVE-2026-10001", cvss, severity, "2026-08-27 10:00:00")])
    return a, n, c


def test_alert_scenario(spark):
    rows = enrich.detection_rule(*_one(spark), as_of=AS_OF).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.anomaly_score == 0.94 and r.anomaly_score > 0.90
    assert (r.finding_type, r.predicted_risk, r.model_version) == ("VULNERABLE_ACTIVE_DEVICE", "CRITICAL",
                                                                    "demo-ml-v1")
    assert r.event_time == "2026-08-27 10:30:00.000"


def test_cvss_boundary(spark):
    assert enrich.detection_rule(*_one(spark, cvss=9.0), as_of=AS_OF).count() == 1
    assert enrich.detection_rule(*_one(spark, cvss=8.9), as_of=AS_OF).count() == 0


def test_null_cvss(spark):
    a, n, c = _one(spark, cvss=None, severity="LOW")
    assert enrich.enrichment(a, n, c, AS_OF).first().anomaly_score == 0.31
    assert enrich.risk_features(a, n, c).first().predicted_risk == "LOW"
    f = findings.ml_scoring(a, n, c).first()
    assert f.anomaly_score is None and f.predicted_risk == "LOW"
    a, n, c = _one(spark, cvss=None, severity="MEDIUM")
    assert enrich.risk_features(a, n, c).first().predicted_risk == "MEDIUM"


def test_feature_risk_three_valued(spark):
    assert enrich.risk_features(*_one(spark, cvss=9.5, quarantined=None)).first().predicted_risk == "HIGH"
    assert enrich.risk_features(*_one(spark, cvss=9.5, quarantined=True)).first().predicted_risk == "HIGH"
    assert enrich.risk_features(*_one(spark, cvss=9.5, quarantined=False)).first().predicted_risk == "CRITICAL"
    assert enrich.risk_features(*_one(spark, cvss=3.5, severity="CRITICAL")).first().predicted_risk == "LOW"
    assert enrich.risk_features(*_one(spark, cvss=3.5, severity="high")).first().predicted_risk == "HIGH"


def test_inactive_or_null_interface_dropped(spark):
    assert enrich.risk_features(*_one(spark, active=None)).count() == 0
    assert enrich.join_active(*_one(spark, active=False)).count() == 0
    assert enrich.detection_rule(*_one(spark, active=None), as_of=AS_OF).count() == 0


def test_two_interfaces_upsert_to_one(spark):
    a = assets_df(spark, [("t1", "a1", "server", "HIGH", False)])
    n = interfaces_df(spark, [("t1", "i1", "a1", "10.0.0.1", True), ("t1", "i2", "a1", "10.0.0.9", True)])
    c = cves_df(spark, [("t1", 1, "a1", "CVE-2026-10001", 9.8, "CRITICAL", "2026-08-27 10:00:00")])
    ml = findings.ml_scoring(a, n, c)
    assert ml.count() == 2
    latest = findings.upsert_latest(ml).collect()
    assert len(latest) == 1
    assert latest[0].ip_address == "10.0.0.9"          # tie on event time -> greatest address
    assert bytes(latest[0].key) == b"t1|a1|CVE-2026-10001"


def test_incident_and_threat_intel(spark):
    a, n, c = _one(spark)
    rule = enrich.detection_rule(a, n, c, as_of=AS_OF)
    act = spark.createDataFrame([("t1", "a1", 1, "error", None, True), ("t1", "a2", 2, "error", None, True)],
                                "tenant_id string, asset_id string, activity_id long, activity_type string, "
                                "activity_time timestamp, is_suspicious boolean")
    assert enrich.incident(rule, act).count() == 1
    assert enrich.incident(rule, act.filter(F.col("asset_id") == "a2")).count() == 0
    feed = spark.createDataFrame([("CVE-2026-10001", "actor-b", False), ("CVE-2026-10001", "actor-a", True)],
                                 "cve_id string, threat_actor string, known_exploited boolean")
    r = enrich.threat_intel(rule, feed).collect()
    assert len(r) == 1 and r[0].threat_actor == "actor-a" and r[0].known_exploited and r[0].feed_entries == 2


def test_cve_series_scores_each_record_once(spark):
    a = assets_df(spark, [("t1", "a1", "server", "HIGH", False)])
    n = interfaces_df(spark, [("t1", "i1", "a1", "10.0.0.1", True), ("t1", "i2", "a1", "10.0.0.2", True)])
    vals = [5.0, 5.1, 5.2, 5.1, 5.0, 5.2, 5.1, 5.0, 5.2, 5.1, 5.0, 5.1, 9.9]
    c = cves_df(spark, [("t1", i, "a1", f"CVE-2026-{10000 + i}", v, "MEDIUM", f"2026-08-27 10:{i:02d}:00")
                        for i, v in enumerate(vals)])
    per_cve = findings.ml_scoring(a, n, c, series="cve")
    assert per_cve.count() == 2 * len(vals)
    spike = per_cve.filter("cve_id = 'CVE-2026-10012'").collect()
    assert len(spike) == 2 and all(r.anomaly_score == 0.99 and r.predicted_risk == "CRITICAL" for r in spike)
    # literal series: each CVE appears twice, so the spike rows train on 23 and 24 pairs instead of 11
    lit = findings.scored_series(a, n, c).filter("cve_id = 'CVE-2026-10012'").collect()
    assert sorted(r.anomaly.n for r in lit) == [23, 24]
    assert [r.anomaly.n for r in findings.score_cves(c).filter("cve_record_id = 12").collect()] == [11]
