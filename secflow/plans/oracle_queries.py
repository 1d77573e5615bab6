"""DuckDB SQL per registered query key (see ``secflow.plans.catalog``)."""

from __future__ import annotations

from secflow.plans.oracle import avg_sql, with_ctes

ENT = ["assets", "network_interfaces", "asset_cves"]
TS = "TRY_CAST(event_time AS TIMESTAMP)"
AVG_CVSS = avg_sql("cvss_score")
AVG_SCORE = avg_sql("anomaly_score")
JOIN3 = """FROM assets a
JOIN network_interfaces n ON a.tenant_id = n.tenant_id AND a.asset_id = n.asset_id
JOIN asset_cves c ON a.tenant_id = c.tenant_id AND a.asset_id = c.asset_id"""
MS_TEXT = "'%Y-%m-%d %H:%M:%S.%g'"
DOC_COLS = ("_id, tenant_id, asset_id, device_type, ip_address, cve_id, cvss_score, severity, anomaly_score, "
            "finding_type, predicted_risk, model_version, event_time")


def _top(src: str, key: str, n: int, value: str = "COUNT(*)", where: str = "") -> str:
    return (f"SELECT {key}, {value} AS findings FROM {src} {where} GROUP BY {key} "
            f"ORDER BY findings DESC, {key} ASC NULLS LAST LIMIT {n}")


def order_sql() -> str:
    """The autoregressive model with orders p 1 to 2 and d 0 to 1 over the CVE records: sums over moving frames, then
    the equations of each order solved in the open (p = 2 by one elimination)."""
    z = {0: ["y", "y1", "y2"], 1: ["(y - y1)", "(y1 - y2)", "(y2 - y3)"]}
    sums, fits = ["SUM(CASE WHEN whole THEN 1 ELSE 0 END) OVER w AS n"], []
    for d, lag in z.items():
        for a in range(3):
            sums.append(f"SUM(CASE WHEN whole THEN {lag[a]} ELSE 0 END) OVER w AS s{d}{a}")
            sums += [f"SUM(CASE WHEN whole THEN {lag[a]} * {lag[b]} ELSE 0 END) OVER w AS s{d}{a}{b}"
                     for b in range(a, 3)]
    moments = [f"CAST(n * s{d}{a}{b} - s{d}{a} * s{d}{b} AS DOUBLE) AS m{d}{a}{b}"
               for d in z for a in range(3) for b in range(a, 3)]
    steps = []
    for d in z:
        steps += [f"m{d}22 - m{d}12 / NULLIF(m{d}11, 0) * m{d}12 AS v{d}",
                  f"(m{d}02 - m{d}12 / NULLIF(m{d}11, 0) * m{d}01) / NULLIF(m{d}22 - m{d}12 / NULLIF(m{d}11, 0) * m{d}12, 0) AS g{d}",
                  f"m{d}01 / NULLIF(m{d}11, 0) AS b{d}"]
    for d, lag in z.items():
        ahead = {0: "", 1: " - CAST(0 - y1 AS DOUBLE)"}[d]
        h = f"((m{d}01 - m{d}12 * g{d}) / NULLIF(m{d}11, 0))"
        one = (f"(CAST(s{d}0 AS DOUBLE) - b{d} * CAST(s{d}1 AS DOUBLE)) / CAST(n AS DOUBLE) + b{d} * CAST({lag[1]} AS DOUBLE)",
               f"m{d}00 - b{d} * m{d}01", f"m{d}11 > 0")
        two = (f"(CAST(s{d}0 AS DOUBLE) - {h} * CAST(s{d}1 AS DOUBLE) - g{d} * CAST(s{d}2 AS DOUBLE)) / CAST(n AS DOUBLE)"
               f" + {h} * CAST({lag[1]} AS DOUBLE) + g{d} * CAST({lag[2]} AS DOUBLE)",
               f"m{d}00 - {h} * m{d}01 - g{d} * m{d}02", f"m{d}11 > 0 AND m{d}22 > 0 AND v{d} > 1e-9 * m{d}22")
        for p, (fc, rss, full) in ((1, one), (2, two)):
            fits.append(f"""
SELECT tenant_id, cve_record_id, {p} AS p, {d} AS d, ({fc}){ahead} AS fc, GREATEST({rss}, 0.0) AS rss,
       GREATEST({rss}, 0.0) * exp({2.0 * (p + 1)} / CAST(n AS DOUBLE)) AS aic
FROM solved WHERE whole AND n >= 10 AND {full}""")
    nl = ",\n       "
    return f""", lagged AS (SELECT c.*, CAST(ROUND(cvss_score * 10) AS BIGINT) AS y,
                    LAG(CAST(ROUND(cvss_score * 10) AS BIGINT), 1) OVER s AS y1,
                    LAG(CAST(ROUND(cvss_score * 10) AS BIGINT), 2) OVER s AS y2,
                    LAG(CAST(ROUND(cvss_score * 10) AS BIGINT), 3) OVER s AS y3
             FROM asset_cves c
             WINDOW s AS (PARTITION BY tenant_id ORDER BY (cvss_score IS NULL), discovered_at, cve_record_id)),
marked AS (SELECT *, (y IS NOT NULL AND y1 IS NOT NULL AND y2 IS NOT NULL AND y3 IS NOT NULL) AS whole FROM lagged),
summed AS (SELECT *, {nl.join(sums)}
           FROM marked WINDOW w AS (PARTITION BY tenant_id ORDER BY (cvss_score IS NULL), discovered_at, cve_record_id
                                    ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING)),
moments AS (SELECT *, {nl.join(moments)} FROM summed),
solved AS (SELECT *, {nl.join(steps)} FROM moments),
fits AS ({" UNION ALL ".join(fits)}),
chosen AS (SELECT * FROM fits QUALIFY ROW_NUMBER() OVER (PARTITION BY tenant_id, cve_record_id ORDER BY aic, p, d) = 1)
SELECT s.tenant_id, s.cve_record_id, s.cvss_score, CASE WHEN s.y IS NOT NULL THEN CAST(COALESCE(s.n, 0) AS INT) END AS n,
       f.p, f.d, f.fc / 10.0 AS forecast, sqrt(f.rss) / CAST(s.n AS DOUBLE) / 10.0 AS rmse,
       abs(CAST(s.y AS DOUBLE) - f.fc) / 10.0 > GREATEST(2.5758 * (sqrt(f.rss) / CAST(s.n AS DOUBLE) / 10.0), 1e-6) AS is_anomaly
FROM solved s LEFT JOIN chosen f ON f.tenant_id = s.tenant_id AND f.cve_record_id = s.cve_record_id"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    q["detection_rule"] = with_ctes(["rule_rows"], "SELECT * FROM rule_rows")
    q["detection_rule_current"] = with_ctes(ENT + ["cdc_latest"], f"""
SELECT a.tenant_id, a.asset_id, a.device_type, n.ip_address, c.cve_id, c.cvss_score, c.severity,
       CAST(0.94 AS DOUBLE) AS anomaly_score, 'VULNERABLE_ACTIVE_DEVICE' AS finding_type,
       'CRITICAL' AS predicted_risk, 'demo-ml-v1' AS model_version,
       strftime(TIMESTAMP '2024-02-01 00:00:00', {MS_TEXT}) AS event_time
FROM (SELECT a.tenant_id, a.asset_id, a.device_type,
             CASE WHEN l.key_asset_id IS NOT NULL THEN l.risk_level ELSE a.risk_level END AS risk_level
      FROM assets a
      LEFT JOIN cdc_latest l ON l.key_tenant_id = a.tenant_id AND l.key_asset_id = a.asset_id
      WHERE l.op IS NULL OR l.op <> 'd') a
JOIN network_interfaces n ON a.tenant_id = n.tenant_id AND a.asset_id = n.asset_id
JOIN asset_cves c ON a.tenant_id = c.tenant_id AND a.asset_id = c.asset_id
WHERE a.risk_level = 'HIGH' AND n.is_active = TRUE AND c.cvss_score >= 9.0 AND c.severity = 'CRITICAL'""")
    # The incremental forms end where the batch forms do.
    q["detection_rule_incremental"] = q["detection_rule_current"]
    q["agg_high_risk_incremental"] = with_ctes(["assets", "cdc_latest"], """
SELECT a.tenant_id, COUNT(*) AS high_risk_assets
FROM assets a LEFT JOIN cdc_latest l ON l.key_tenant_id = a.tenant_id AND l.key_asset_id = a.asset_id
WHERE (l.op IS NULL OR l.op <> 'd')
  AND CASE WHEN l.key_asset_id IS NOT NULL THEN l.risk_level ELSE a.risk_level END = 'HIGH'
GROUP BY a.tenant_id""")
    q["enrichment"] = with_ctes(ENT, f"""
SELECT a.tenant_id, a.asset_id, a.device_type, n.ip_address, c.cve_id, c.cvss_score, c.severity,
       CAST(CASE WHEN c.cvss_score >= 9.0 THEN 0.94 WHEN c.cvss_score >= 7.0 THEN 0.82 ELSE 0.31 END AS DOUBLE)
         AS anomaly_score,
       strftime(TIMESTAMP '2024-02-01 00:00:00', {MS_TEXT}) AS event_time
{JOIN3}""")
    q["risk_prediction_features"] = with_ctes(ENT, f"""
SELECT a.tenant_id, a.asset_id, a.device_type, a.risk_level AS asset_risk_level, a.is_quarantined,
       n.ip_address, n.is_active, c.cve_id, c.cvss_score, c.severity,
       CASE WHEN c.cvss_score >= 9.0 AND n.is_active AND NOT a.is_quarantined THEN 'CRITICAL'
            WHEN c.cvss_score >= 7.0 OR UPPER(c.severity) = 'HIGH' THEN 'HIGH'
            WHEN c.cvss_score >= 4.0 OR UPPER(c.severity) = 'MEDIUM' THEN 'MEDIUM'
            ELSE 'LOW' END AS predicted_risk
{JOIN3}
WHERE n.is_active = TRUE""")
    q["anomaly_scores"] = with_ctes(["scored"], """
SELECT tenant_id, cve_record_id, interface_id, cvss_score, a_n AS n,
       a_forecast AS forecast, a_forecast - a_band AS lower, a_forecast + a_band AS upper,
       a_rmse AS rmse, is_anomaly
FROM scored""")
    q["anomaly_scores_cve"] = with_ctes(["cve_scored"], """
SELECT tenant_id, cve_record_id, cvss_score, a_n AS n,
       a_forecast AS forecast, a_forecast - a_band AS lower, a_forecast + a_band AS upper,
       a_rmse AS rmse, is_anomaly
FROM cve_scored""")
    q["anomaly_scores_order"] = with_ctes(["asset_cves"], order_sql())
    q["ml_scoring"] = with_ctes(["ml_findings"], "SELECT * FROM ml_findings")
    q["running_cvss_range"] = with_ctes(["asset_cves"], """
SELECT tenant_id, cve_record_id, cvss_score, discovered_at,
       COUNT(cvss_score) OVER w AS running_count,
       """ + avg_sql("cvss_score", " OVER w") + """ AS running_avg,
       MAX(cvss_score) OVER w AS running_max
FROM asset_cves
WINDOW w AS (PARTITION BY tenant_id ORDER BY discovered_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
    q["cep_incident"] = with_ctes(["rule_rows", "asset_activity"], """
SELECT * FROM rule_rows r
WHERE EXISTS (SELECT 1 FROM asset_activity s
              WHERE s.is_suspicious AND s.tenant_id = r.tenant_id AND s.asset_id = r.asset_id
                AND s.activity_time > TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 72 HOUR
                AND s.activity_time <= TIMESTAMP '2024-02-01 00:00:00')""")
    # Every pair of a critical CVE and a later suspicious activity; the operator makes none.
    q["cep_incident_ordered"] = with_ctes(["assets", "asset_cves", "asset_activity"], """
SELECT c.tenant_id, c.asset_id, c.cve_record_id, c.discovered_at, c.cve_id, COUNT(*) AS followers,
       ARG_MIN(s.activity_id, (s.activity_time, s.activity_id)) AS activity_id, MIN(s.activity_time) AS activity_time
FROM asset_cves c
JOIN asset_activity s ON s.tenant_id = c.tenant_id AND s.asset_id = c.asset_id AND s.is_suspicious
  AND s.activity_time > c.discovered_at AND s.activity_time <= c.discovered_at + INTERVAL 3 DAY
WHERE c.cvss_score >= 9.0 AND c.severity = 'CRITICAL'
  AND EXISTS (SELECT 1 FROM assets a WHERE a.tenant_id = c.tenant_id AND a.asset_id = c.asset_id
              AND a.risk_level = 'HIGH')
GROUP BY c.tenant_id, c.asset_id, c.cve_record_id, c.discovered_at, c.cve_id""")
    # A batch's watermark: the newest time of the batches before, less a day.
    q["activity_totals_late"] = with_ctes(["asset_activity"], """, arrived AS (SELECT *, LEAST(2, CASE WHEN activity_time < TIMESTAMP '2024-01-11' THEN 0
                                     WHEN activity_time < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END
                                + CASE WHEN activity_id % 5 = 0 THEN 1 ELSE 0 END) AS b,
                     time_bucket(INTERVAL '1 day', activity_time) AS window_start
              FROM asset_activity),
judged AS (SELECT r.*, (SELECT MAX(e.t) FROM (SELECT b, MAX(activity_time) AS t FROM arrived GROUP BY b) e
                        WHERE e.b < r.b) - INTERVAL 1 DAY AS wm
           FROM arrived r)
SELECT tenant_id, window_start,
       CASE WHEN COALESCE(window_start + INTERVAL 1 DAY <= wm, FALSE) THEN 'late'
            WHEN window_start + INTERVAL 1 DAY <= (SELECT MAX(activity_time) FROM arrived) - INTERVAL 1 DAY THEN 'closed'
            ELSE 'open' END AS place,
       COUNT(*) AS events, COUNT(*) FILTER (WHERE is_suspicious) AS suspicious
FROM judged GROUP BY ALL""")
    q["threat_intel_enrichment"] = with_ctes(["finding_docs", "threat_intel_feed"], f"""
SELECT d.*, f.threat_actor, COALESCE(f.known_exploited, FALSE) AS known_exploited,
       COALESCE(f.feed_entries, 0) AS feed_entries
FROM finding_docs d
LEFT JOIN (SELECT cve_id, MIN(threat_actor) AS threat_actor,
                  CAST(MAX(CAST(known_exploited AS INT)) AS BOOLEAN) AS known_exploited,
                  COUNT(*) AS feed_entries
           FROM threat_intel_feed GROUP BY cve_id) f ON d.cve_id = f.cve_id""")
    q["cep_burst_alert"] = with_ctes(["asset_activity"], """
SELECT tenant_id, asset_id, activity_id, activity_time, events_in_window FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY tenant_id, asset_id ORDER BY epoch_us(activity_time)
                           RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW) AS events_in_window
  FROM asset_activity WHERE is_suspicious)
WHERE events_in_window >= 3""")

    # findings sink semantics
    q["findings_upsert_latest"] = with_ctes(["findings_latest"], "SELECT * FROM findings_latest")
    q["finding_documents"] = with_ctes(["finding_docs"], "SELECT * FROM finding_docs")
    q["all_findings"] = with_ctes(["rule_rows", "ml_findings"], """
SELECT CONCAT(tenant_id, '|', asset_id, '|', cve_id) AS key, * FROM rule_rows
UNION ALL
SELECT * FROM ml_findings""")
    q["purge_missing_severity"] = with_ctes(["finding_docs"],
                                            "SELECT * FROM finding_docs WHERE severity IS NOT NULL "
                                            "AND cvss_score IS NOT NULL")
    q["conform_findings"] = with_ctes(["finding_docs"], """
SELECT * REPLACE (strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time) FROM finding_docs""")
    q["findings_retention"] = with_ctes(["findings_latest"], f"""
SELECT * FROM findings_latest
WHERE {TS} >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 604800000 MILLISECOND""")
    q["findings_retention_table"] = q["findings_retention"]
    q["findings_last_24h"] = with_ctes(["finding_docs"], """
SELECT * FROM finding_docs
WHERE strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') BETWEEN TIMESTAMP '2024-01-29 12:00:00'
                                                       AND TIMESTAMP '2024-01-30 12:00:00'""")
    cols = sorted(["anomaly_score", "asset_id", "cve_id", "cvss_score", "device_type", "event_time", "finding_type",
                   "ip_address", "model_version", "predicted_risk", "severity", "tenant_id"])
    q["findings_json"] = with_ctes(["finding_docs"], "SELECT _id, CAST(json_object(" +
                                   ", ".join(f"'{c}', {c}" for c in cols) + ") AS VARCHAR) AS json FROM finding_docs")
    q["normalize_event_time"] = with_ctes(["asset_cves"], f"""
SELECT cve_record_id, strftime(date_trunc('millisecond', discovered_at), {MS_TEXT}) AS event_time,
       strftime(date_trunc('millisecond', discovered_at), '%Y-%m-%dT%H:%M:%S.%fZ') AS normalized
FROM asset_cves""")
    q["severity_from_cvss"] = with_ctes(["asset_cves"], """
SELECT CASE WHEN cvss_score >= 9.0 THEN 'CRITICAL' WHEN cvss_score >= 7.0 THEN 'HIGH'
            WHEN cvss_score >= 4.0 THEN 'MEDIUM' ELSE 'LOW' END AS severity, COUNT(*) AS cves
FROM asset_cves GROUP BY 1""")

    q["decode_findings"] = with_ctes(["decoded_docs"], "SELECT * FROM decoded_docs")

    # aggregations
    q["agg_critical_cves"] = with_ctes(["asset_cves"], """
SELECT tenant_id, COUNT(*) AS critical_cves FROM asset_cves WHERE severity = 'CRITICAL' GROUP BY tenant_id""")
    q["agg_high_risk_assets"] = with_ctes(["assets"], """
SELECT tenant_id, COUNT(*) AS high_risk_assets FROM assets WHERE risk_level = 'HIGH' GROUP BY tenant_id""")
    q["agg_avg_cvss"] = with_ctes(["asset_cves"], f"""
SELECT tenant_id, {AVG_CVSS} AS avg_cvss
FROM asset_cves GROUP BY tenant_id""")
    q["agg_cves_per_tenant"] = with_ctes(["asset_cves"], """
SELECT tenant_id, COUNT(*) AS cve_count FROM asset_cves GROUP BY tenant_id""")
    q["agg_quarantined"] = with_ctes(["assets"], """
SELECT tenant_id, COUNT(*) AS quarantined_assets FROM assets WHERE is_quarantined = TRUE GROUP BY tenant_id""")
    q["active_vulnerable_devices"] = with_ctes(ENT, """
SELECT a.tenant_id, COUNT(*) AS active_vulnerable_devices FROM assets a
WHERE EXISTS (SELECT 1 FROM network_interfaces n
              WHERE n.is_active = TRUE AND n.tenant_id = a.tenant_id AND n.asset_id = a.asset_id)
  AND EXISTS (SELECT 1 FROM asset_cves c
              WHERE c.cvss_score >= 7.0 AND c.tenant_id = a.tenant_id AND c.asset_id = a.asset_id)
GROUP BY a.tenant_id""")
    q["high_risk_5min"] = with_ctes(["assets_cdc_flat"], """
SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ts_ms * 1000)) AS window_start,
       time_bucket(INTERVAL '5 minutes', make_timestamp(ts_ms * 1000)) + INTERVAL '5 minutes' AS window_end,
       key_tenant_id AS tenant_id, COUNT(DISTINCT key_asset_id) AS high_risk_assets
FROM assets_cdc_flat
WHERE op IN ('c', 'r', 'u') AND risk_level = 'HIGH'
GROUP BY 1, 2, 3""")
    q["top_device_types"] = with_ctes(["findings_latest"], f"""
SELECT device_type, COUNT(*) AS findings, {AVG_CVSS} AS avg_cvss_score
FROM findings_latest GROUP BY device_type ORDER BY findings DESC, device_type ASC NULLS LAST LIMIT 20""")
    q["kpi_total_findings"] = with_ctes(["finding_docs"], "SELECT COUNT(*) AS findings FROM finding_docs")
    q["kpi_critical_findings"] = with_ctes(["finding_docs"],
                                           "SELECT COUNT(*) AS findings FROM finding_docs WHERE severity = 'CRITICAL'")
    q["top_severity_findings"] = with_ctes(["finding_docs"], _top("finding_docs", "severity", 5))
    q["top_risk_findings"] = with_ctes(["finding_docs"], _top("finding_docs", "predicted_risk", 5))
    q["alerts_per_tenant"] = with_ctes(["finding_docs"], """
SELECT tenant_id, COUNT(*) AS alerts FROM finding_docs WHERE predicted_risk = 'CRITICAL' GROUP BY tenant_id""")
    q["findings_by_tenant"] = with_ctes(["finding_docs"],
                                        "SELECT tenant_id, COUNT(*) AS findings FROM finding_docs GROUP BY tenant_id")
    q["findings_by_severity"] = with_ctes(["finding_docs"],
                                          "SELECT severity, COUNT(*) AS findings FROM finding_docs GROUP BY severity")
    q["top_cves"] = with_ctes(["finding_docs"], _top("finding_docs", "cve_id", 10))
    q["avg_scores"] = with_ctes(["finding_docs"], f"""
SELECT tenant_id, COUNT(*) AS findings,
       {AVG_CVSS} AS avg_cvss_score,
       {AVG_SCORE} AS avg_anomaly_score
FROM finding_docs GROUP BY ROLLUP (tenant_id)""")
    q["findings_over_time"] = with_ctes(["finding_docs"], """
SELECT time_bucket(INTERVAL '1 hour', strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ')) AS bucket_start,
       COUNT(*) AS findings
FROM finding_docs GROUP BY 1""")
    q["findings_cvss_gt9"] = with_ctes(["finding_docs"], "SELECT * FROM finding_docs WHERE cvss_score > 9.0")
    q["findings_filter"] = with_ctes(["finding_docs"], """
SELECT * FROM finding_docs
WHERE tenant_id IN ('BUILDING', 'MACHINERY') AND severity IN ('CRITICAL')
  AND device_type IN ('server', 'router', 'firewall')""")
    q["top_devices"] = with_ctes(["findings_latest"], f"""
SELECT tenant_id, asset_id, device_type, COUNT(*) AS findings,
       {AVG_CVSS} AS avg_cvss_score
FROM findings_latest GROUP BY tenant_id, asset_id, device_type
ORDER BY findings DESC, tenant_id, asset_id LIMIT 10""")

    # BI
    q["bi_rollup"] = with_ctes(["bi_rows"], "SELECT * FROM bi_rows")
    q["bi_rollup_incremental"] = q["bi_rollup"]
    q["bi_documents"] = with_ctes(["bi_rows"], """
SELECT sha256(CONCAT_WS('|', strftime(window_start, '%Y-%m-%dT%H:%M:%SZ'), COALESCE(tenant_id, 'None'),
                        COALESCE(severity, 'None'), COALESCE(predicted_risk, 'None'))) AS _id,
       strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS window_start,
       strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end,
       tenant_id, severity, predicted_risk, findings, avg_cvss_score, avg_anomaly_score
FROM bi_rows""")
    q["bi_total_findings"] = with_ctes(["bi_rows"],
                                       "SELECT CAST(SUM(findings) AS BIGINT) AS total_findings FROM bi_rows")
    q["bi_recent_200"] = with_ctes(["bi_rows"], """
SELECT * FROM bi_rows
ORDER BY window_start DESC, findings DESC, tenant_id, severity, predicted_risk LIMIT 200""")
    q["bi_top_severity"] = with_ctes(["bi_rows"], _top("bi_rows", "severity", 5, "CAST(SUM(findings) AS BIGINT)"))
    q["bi_top_risk"] = with_ctes(["bi_rows"], _top("bi_rows", "predicted_risk", 5, "CAST(SUM(findings) AS BIGINT)"))
    q["bi_top_tenants"] = with_ctes(["bi_rows"], _top("bi_rows", "tenant_id", 10, "CAST(SUM(findings) AS BIGINT)"))
    q["bi_rollup_topn"] = with_ctes(["finding_docs"], f"""
SELECT l.window_start, l.window_end, l.tenant_id, l.severity, l.predicted_risk, l.findings, l.avg_cvss_score,
       l.avg_anomaly_score
FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY window_start, tenant_id, severity
                               ORDER BY findings DESC, predicted_risk) AS rr
  FROM (
    SELECT window_start, window_end, tenant_id, severity, predicted_risk, COUNT(*) AS findings,
           {AVG_CVSS} AS avg_cvss_score,
           {AVG_SCORE} AS avg_anomaly_score
    FROM base WHERE predicted_risk IS NOT NULL GROUP BY 1, 2, 3, 4, 5)) l
JOIN (SELECT window_start, tenant_id FROM (
        SELECT window_start, tenant_id,
               ROW_NUMBER() OVER (PARTITION BY window_start ORDER BY COUNT(*) DESC, tenant_id) AS tr
        FROM base GROUP BY 1, 2) WHERE tr <= 1000) t
  ON l.window_start = t.window_start AND l.tenant_id = t.tenant_id
JOIN (SELECT window_start, tenant_id, severity FROM (
        SELECT window_start, tenant_id, severity,
               ROW_NUMBER() OVER (PARTITION BY window_start, tenant_id ORDER BY COUNT(*) DESC, severity) AS sr
        FROM base GROUP BY 1, 2, 3) WHERE sr <= 10) s
  ON l.window_start = s.window_start AND l.tenant_id = s.tenant_id AND l.severity = s.severity
WHERE l.rr <= 10""").replace("FROM base", """FROM (SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
                   time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end, *
            FROM (SELECT *, strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts FROM finding_docs)
            WHERE severity IS NOT NULL AND ts IS NOT NULL AND tenant_id IS NOT NULL)""")

    # change data capture
    live = "op IN ('c', 'r', 'u') AND op <> 'd'"
    q["cdc_current_rows"] = with_ctes(["assets_cdc_flat"], f"""
SELECT key_tenant_id AS tenant_id, key_asset_id AS asset_id, os_version, risk_level, ts_ms, seq
FROM assets_cdc_flat WHERE {live}""")
    q["cdc_flat_event"] = with_ctes(["assets_cdc_flat"], """
SELECT key_tenant_id AS tenant_id, key_asset_id AS asset_id,
       CASE WHEN op <> 'd' THEN os_version END AS os_version,
       CASE WHEN op <> 'd' THEN risk_level END AS risk_level,
       op AS event_type, make_timestamp(ts_ms * 1000) AS event_time
FROM assets_cdc_flat""")
    q["cdc_latest_state"] = with_ctes(["cdc_latest"], f"""
SELECT key_tenant_id AS tenant_id, key_asset_id AS asset_id, os_version, risk_level, ts_ms, seq
FROM cdc_latest WHERE {live}""")
    q["cdc_deletes"] = with_ctes(["cdc_latest"], """
SELECT key_tenant_id AS tenant_id, key_asset_id AS asset_id, ts_ms, seq FROM cdc_latest WHERE op = 'd'""")
    q["cdc_snapshot_envelope"] = with_ctes(["assets"], """
SELECT *, epoch_ms(TIMESTAMP '2024-02-01 00:00:00') AS ts_ms, 'r' AS op FROM assets""")
    q["cdc_table_filter"] = with_ctes(["multiplexed"], """
SELECT * FROM (SELECT *, regexp_replace(topic, '^[^.]+\\.public\\.(.*)$', '\\1') AS table_name FROM multiplexed)
WHERE table_name IN ('assets', 'asset_cves')""")
    q["route_topic"] = with_ctes(["multiplexed"], """
SELECT topic, regexp_replace(topic, '^[^.]+\\.public\\.(.*)$', '\\1') AS table_name, COUNT(*) AS changes
FROM multiplexed GROUP BY 1, 2""")
    q["cdc_capture_types"] = with_ctes(["asset_cves"], """
SELECT tenant_id, cve_record_id, CAST(CAST(cvss_score AS DECIMAL(3, 1)) AS DOUBLE) AS cvss_score,
       date_trunc('millisecond', discovered_at) AS discovered_at
FROM asset_cves""")

    # contracts
    incoming = {"assets": "in_assets", "network_interfaces": "in_interfaces", "asset_cves": "in_cves"}
    IN = list(incoming.values())

    def pk(table, keys):
        return f"""SELECT '{table}' AS table_name, CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS distinct_keys,
       CAST(SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS BIGINT) AS duplicate_keys
FROM (SELECT {keys}, COUNT(*) AS n FROM {incoming[table]} GROUP BY {keys})"""
    q["check_pk"] = with_ctes(IN, "\nUNION ALL\n".join([
        pk("assets", "tenant_id, asset_id"), pk("network_interfaces", "tenant_id, interface_id"),
        pk("asset_cves", "tenant_id, cve_record_id")]))
    q["check_fk"] = with_ctes(["assets", *IN], """
SELECT 'network_interfaces' AS table_name, COUNT(*) AS orphans FROM in_interfaces n
WHERE NOT EXISTS (SELECT 1 FROM assets a WHERE a.tenant_id = n.tenant_id AND a.asset_id = n.asset_id)
UNION ALL
SELECT 'asset_cves', COUNT(*) FROM in_cves c
WHERE NOT EXISTS (SELECT 1 FROM assets a WHERE a.tenant_id = c.tenant_id AND a.asset_id = c.asset_id)""")
    from secflow import schemas as S
    nn = []
    for t, cols in S.NOT_NULL.items():
        for c in cols:
            nn.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) "
                      f"AS null_count FROM {incoming[t]}")
    q["check_not_null"] = with_ctes(IN, "\nUNION ALL\n".join(nn))
    ln = []
    for t, lim in S.LENGTH_LIMITS.items():
        for c, n in lim.items():
            ln.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, {n} AS max_length, "
                      f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS violations FROM {incoming[t]}")
    ln.append("SELECT 'asset_cves', 'cvss_score', 3, COUNT(*) FILTER (WHERE cvss_score IS NOT NULL AND "
              "(abs(cvss_score * 10 - round(cvss_score * 10)) > 1e-9 OR abs(cvss_score) >= 100.0)) FROM in_cves")
    q["check_lengths"] = with_ctes(IN, "\nUNION ALL\n".join(ln))
    q["apply_defaults"] = with_ctes(["in_assets", "in_interfaces"], """
SELECT 'assets' AS table_name, COALESCE(risk_level, 'LOW') AS value, COALESCE(is_quarantined, FALSE) AS flag,
       COUNT(*) AS rows
FROM in_assets GROUP BY 1, 2, 3
UNION ALL
SELECT 'network_interfaces', NULL, COALESCE(is_active, TRUE), COUNT(*) FROM in_interfaces GROUP BY 1, 2, 3""")
    q["cascade_deletes"] = with_ctes(["network_interfaces", "cdc_latest"], """
SELECT * FROM network_interfaces n
WHERE NOT EXISTS (SELECT 1 FROM cdc_latest d
                  WHERE d.op = 'd' AND d.key_tenant_id = n.tenant_id AND d.key_asset_id = n.asset_id)""")
    from secflow.operators.contracts import IPV4_PATTERN, IPV6_PATTERN
    v4 = f"regexp_full_match(ip_address, '{IPV4_PATTERN}')"
    v6 = f"regexp_full_match(ip_address, '{IPV6_PATTERN}')"
    q["check_ip"] = with_ctes(["in_interfaces"], f"""
SELECT COUNT(ip_address) AS checked,
       COUNT(*) FILTER (WHERE ip_address IS NOT NULL AND (NOT ({v4} OR {v6}) OR length(ip_address) > 45)) AS invalid,
       COUNT(*) FILTER (WHERE {v4}) AS ipv4,
       COUNT(*) FILTER (WHERE {v6}) AS ipv6
FROM in_interfaces""")

    # governance joined with data
    q["retention_expired"] = with_ctes(
        ["assets_cdc_flat", "network_interfaces", "asset_cves", "findings_latest"], """
SELECT m.topic, m.retention, m.retention_days,
       TIMESTAMP '2024-02-01 00:00:00' - to_days(m.retention_days) AS cutoff,
       COUNT(*) AS rows,
       COUNT(*) FILTER (WHERE d.ts < TIMESTAMP '2024-02-01 00:00:00' - to_days(m.retention_days)) AS expired_rows
FROM (SELECT 'assets' AS topic, make_timestamp(ts_ms * 1000) AS ts FROM assets_cdc_flat
      UNION ALL SELECT 'network_interfaces' AS topic, last_seen_at AS ts FROM network_interfaces
      UNION ALL SELECT 'asset_cves', discovered_at FROM asset_cves
      UNION ALL SELECT 'security_findings', TRY_CAST(event_time AS TIMESTAMP) FROM findings_latest) d
JOIN (VALUES ('assets', '30-days', 30), ('network_interfaces', '14-days', 14), ('asset_cves', '90-days', 90),
             ('security_findings', '180-days', 180)) AS m(topic, retention, retention_days)
  ON d.topic = m.topic
GROUP BY 1, 2, 3, 4""")
    return q
