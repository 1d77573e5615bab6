"""Reference SQL for every registered query, runnable by DuckDB on the driver tables.

The entity adapters are CTEs with the same definitions as ``secflow.sources.fixtures``.
Queries are composed from named CTE fragments so each oracle reads the raw
tables and recomputes the whole pipeline independently of Spark.
"""

from __future__ import annotations

AS_OF = "2024-02-01 00:00:00"


def avg_sql(col: str, over: str = "") -> str:
    """Average of a DOUBLE column: the values are whole multiples of 2**-60, whose sum is exact in 128 bits.

    The text between the sum and its double rounds once.
    """
    total = f"CAST(CAST(SUM(CAST({col} * 1152921504606846976e0 AS HUGEINT)){over} AS VARCHAR) AS DOUBLE)"
    n = f"COUNT({col}){over}"
    return f"CASE WHEN {n} > 0 THEN {total} / 1152921504606846976e0 / CAST({n} AS DOUBLE) END"


ADAPTERS = {
    "assets": """
SELECT c_mktsegment AS tenant_id,
       CAST(c_custkey AS VARCHAR) AS asset_id,
       CASE c_custkey % 6 WHEN 0 THEN 'firewall' WHEN 1 THEN 'router' WHEN 2 THEN 'switch'
            WHEN 3 THEN 'server' WHEN 4 THEN 'workstation' ELSE 'iot-gateway' END AS device_type,
       CASE c_nationkey % 6 WHEN 0 THEN 'Ubuntu' WHEN 1 THEN 'RedHat' WHEN 2 THEN 'Windows'
            WHEN 3 THEN 'Cisco' WHEN 4 THEN 'Fortinet' ELSE 'Palo Alto' END AS os_vendor,
       CONCAT(CAST(c_custkey % 15 + 1 AS VARCHAR), '.', CAST(c_custkey % 10 AS VARCHAR)) AS os_version,
       CONCAT(CAST(c_custkey % 4 + 1 AS VARCHAR), '.', CAST(c_custkey % 21 AS VARCHAR), '.',
              CAST(c_custkey % 51 AS VARCHAR)) AS firmware_version,
       CASE WHEN c_acctbal >= 6000 THEN 'HIGH' WHEN c_acctbal >= 2000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       (c_custkey % 7 = 0) AS is_quarantined
FROM customer""",
    "network_interfaces": """
SELECT c.c_mktsegment AS tenant_id,
       CAST(o.o_orderkey AS VARCHAR) AS interface_id,
       CAST(o.o_custkey AS VARCHAR) AS asset_id,
       CONCAT('02:00:00:00:', LPAD(CAST(o.o_orderkey % 100 AS VARCHAR), 2, '0'), ':',
              LPAD(CAST(o.o_custkey % 100 AS VARCHAR), 2, '0')) AS mac_address,
       CONCAT('10.', CAST(o.o_orderkey % 256 AS VARCHAR), '.', CAST(o.o_custkey % 256 AS VARCHAR), '.',
              CAST((o.o_orderkey + o.o_custkey) % 254 + 1 AS VARCHAR)) AS ip_address,
       (o.o_orderstatus <> 'F') AS is_active,
       o.o_orderdate AS last_seen_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "asset_cves": """
SELECT t.tenant_id, t.cve_record_id, t.asset_id, t.cve_id, t.cvss_score,
       CASE WHEN cvss_score >= 9.0 THEN 'CRITICAL' WHEN cvss_score >= 7.0 THEN 'HIGH'
            WHEN cvss_score >= 4.0 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
       t.discovered_at
FROM (
  SELECT c.c_mktsegment AS tenant_id,
         CAST(e.event_id AS BIGINT) AS cve_record_id,
         CAST(e.user_id AS VARCHAR) AS asset_id,
         CONCAT('CVE-2026-', CAST(10000 + e.event_id % 90000 AS VARCHAR)) AS cve_id,
         CASE WHEN e.event_id % 97 = 0 THEN NULL
              ELSE CAST(LEAST(100, 30 + CAST(FLOOR(ROUND(e.value * 100) / CAST(250 AS DOUBLE)) AS BIGINT)) AS DOUBLE)
                   / CAST(10 AS DOUBLE) END AS cvss_score,
         e.ts AS discovered_at
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
) t""",
    "assets_cdc_flat": """
SELECT c.c_mktsegment AS key_tenant_id,
       CAST(c.c_custkey AS VARCHAR) AS key_asset_id,
       CASE e.event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       epoch_us(e.ts) // 1000 AS ts_ms,
       e.event_id AS seq,
       CASE WHEN e.event_type = 'error' THEN NULL ELSE CAST(e.event_id % 15 + 1 AS VARCHAR) END AS os_version,
       CASE WHEN e.event_type = 'error' THEN NULL
            WHEN e.value >= 60 THEN 'HIGH' WHEN e.value >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
    "in_assets": """
SELECT * FROM assets
UNION ALL
SELECT * REPLACE (CASE WHEN asset_id::BIGINT % 100 = 0 THEN repeat(os_vendor, 40) ELSE os_vendor END AS os_vendor,
                  CASE WHEN asset_id::BIGINT % 150 = 0 THEN NULL ELSE risk_level END AS risk_level,
                  CASE WHEN asset_id::BIGINT % 200 = 0 THEN NULL ELSE is_quarantined END AS is_quarantined)
FROM assets WHERE asset_id::BIGINT % 50 = 0""",
    "in_interfaces": """
SELECT * FROM network_interfaces
UNION ALL
SELECT * REPLACE (
  CASE WHEN interface_id::BIGINT % 120 = 0 THEN CONCAT('X', asset_id) ELSE asset_id END AS asset_id,
  CASE WHEN interface_id::BIGINT % 80 = 0 THEN CONCAT('v6-', interface_id) ELSE interface_id END AS interface_id,
  (['::1', '::ffff:1.2.3.4', '2001:db8::8a2e:370:7334', 'fe80::', '1:2:3:4:5:6:7:8', ':', ':1', '1::2:',
    '1:2:3:4:5:6:7::1:2:3:4', '256.1.1.1', '10.0.0', ''])[(interface_id::BIGINT // 40) % 12 + 1] AS ip_address,
  CASE WHEN interface_id::BIGINT % 160 = 0 THEN repeat(mac_address, 20) ELSE mac_address END AS mac_address,
  CASE WHEN interface_id::BIGINT % 200 = 0 THEN NULL ELSE is_active END AS is_active)
FROM network_interfaces WHERE interface_id::BIGINT % 40 = 0""",
    "in_cves": """
SELECT * FROM asset_cves
UNION ALL
SELECT * REPLACE (
  CASE WHEN cve_record_id % 90 = 0 THEN CONCAT('X', asset_id) ELSE asset_id END AS asset_id,
  CASE WHEN cve_record_id % 60 = 0 THEN NULL ELSE severity END AS severity,
  CASE WHEN cve_record_id % 120 = 0 THEN repeat(cve_id, 20) ELSE cve_id END AS cve_id,
  CASE WHEN cve_record_id % 150 = 0 THEN cvss_score + 0.25e0 WHEN cve_record_id % 210 = 0 THEN cvss_score * 100e0
       ELSE cvss_score END AS cvss_score)
FROM asset_cves WHERE cve_record_id % 30 = 0""",
    "asset_activity": """
SELECT c.c_mktsegment AS tenant_id, CAST(e.user_id AS VARCHAR) AS asset_id, e.event_id AS activity_id,
       e.event_type AS activity_type, e.ts AS activity_time, (e.event_type IN ('error')) AS is_suspicious
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
    "threat_intel_feed": """
SELECT CONCAT('CVE-2026-', CAST(10000 + (s_suppkey * 7) % 90000 AS VARCHAR)) AS cve_id,
       s_name AS threat_actor, (s_suppkey % 3 = 0) AS known_exploited
FROM supplier""",
}

# Pipeline fragments (each may reference adapters and earlier fragments).
FRAGMENTS = {
    "joined_active": """
SELECT a.tenant_id, a.asset_id, a.device_type, n.interface_id, n.ip_address,
       c.cve_record_id, c.cve_id, c.cvss_score, c.severity, c.discovered_at
FROM assets a
JOIN network_interfaces n ON a.tenant_id = n.tenant_id AND a.asset_id = n.asset_id
JOIN asset_cves c ON a.tenant_id = c.tenant_id AND a.asset_id = c.asset_id
WHERE n.is_active = TRUE""",
    "ml_findings": """
SELECT CONCAT(tenant_id, '|', asset_id, '|', cve_id) AS key,
       tenant_id, asset_id, device_type, ip_address, cve_id, cvss_score, severity,
       CAST(CASE WHEN COALESCE(is_anomaly, FALSE) THEN 0.99 ELSE cvss_score / 10.0 END AS DOUBLE) AS anomaly_score,
       'ML_ANOMALY_RISK_PREDICTION' AS finding_type,
       CASE WHEN COALESCE(is_anomaly, FALSE) AND cvss_score >= 7.0 THEN 'CRITICAL'
            WHEN COALESCE(is_anomaly, FALSE) OR cvss_score >= 7.0 THEN 'HIGH'
            WHEN cvss_score >= 4.0 THEN 'MEDIUM'
            ELSE 'LOW' END AS predicted_risk,
       'arima-anomaly-v1' AS model_version,
       strftime(date_trunc('millisecond', discovered_at), '%Y-%m-%d %H:%M:%S.%g') AS event_time
FROM scored""",
    "findings_latest": """
SELECT key, tenant_id, asset_id, device_type, ip_address, cve_id, cvss_score, severity, anomaly_score,
       finding_type, predicted_risk, model_version, event_time
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY event_time DESC NULLS LAST,
        ip_address DESC NULLS LAST, device_type DESC NULLS LAST, cvss_score DESC NULLS LAST,
        severity DESC NULLS LAST, anomaly_score DESC NULLS LAST, finding_type DESC NULLS LAST,
        predicted_risk DESC NULLS LAST, model_version DESC NULLS LAST) AS rn
      FROM ml_findings WHERE key IS NOT NULL) WHERE rn = 1""",
    "doc_prep": """
SELECT tenant_id, asset_id, device_type, ip_address, cve_id, cvss_score, severity, anomaly_score,
       finding_type, predicted_risk, model_version,
       strftime(TRY_CAST(event_time AS TIMESTAMPTZ), '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time
FROM ml_findings""",
    "finding_docs": """
SELECT _id, tenant_id, asset_id, device_type, ip_address, cve_id, cvss_score, severity, anomaly_score,
       finding_type, predicted_risk, model_version, event_time
FROM (SELECT d.*, ROW_NUMBER() OVER (PARTITION BY _id ORDER BY ip_address DESC NULLS LAST,
        device_type DESC NULLS LAST, cvss_score DESC NULLS LAST, severity DESC NULLS LAST,
        anomaly_score DESC NULLS LAST, finding_type DESC NULLS LAST, model_version DESC NULLS LAST) AS rn
      FROM (SELECT *, sha256(CONCAT_WS('|', COALESCE(tenant_id, ''), COALESCE(asset_id, ''),
                 COALESCE(cve_id, ''), COALESCE(event_time, ''), COALESCE(predicted_risk, ''))) AS _id
            FROM doc_prep WHERE event_time IS NOT NULL) d) WHERE rn = 1""",
    "bi_rows": """
SELECT time_bucket(INTERVAL '10 minutes', ts) AS window_start,
       time_bucket(INTERVAL '10 minutes', ts) + INTERVAL '10 minutes' AS window_end,
       tenant_id, severity, predicted_risk, COUNT(*) AS findings,
       """ + avg_sql("cvss_score") + """ AS avg_cvss_score,
       """ + avg_sql("anomaly_score") + """ AS avg_anomaly_score
FROM (SELECT *, TRY_CAST(event_time AS TIMESTAMP) AS ts FROM findings_latest) WHERE ts IS NOT NULL
GROUP BY ALL""",
    "rule_rows": """
SELECT a.tenant_id, a.asset_id, a.device_type, n.ip_address, c.cve_id, c.cvss_score, c.severity,
       CAST(0.94 AS DOUBLE) AS anomaly_score, 'VULNERABLE_ACTIVE_DEVICE' AS finding_type,
       'CRITICAL' AS predicted_risk, 'demo-ml-v1' AS model_version,
       strftime(TIMESTAMP '2024-02-01 00:00:00', '%Y-%m-%d %H:%M:%S.%g') AS event_time
FROM assets a
JOIN network_interfaces n ON a.tenant_id = n.tenant_id AND a.asset_id = n.asset_id
JOIN asset_cves c ON a.tenant_id = c.tenant_id AND a.asset_id = c.asset_id
WHERE a.risk_level = 'HIGH' AND n.is_active = TRUE AND c.cvss_score >= 9.0 AND c.severity = 'CRITICAL'""",
    "decoded_docs": """
SELECT _id, tenant_id, asset_id, device_type, ip_address, cve_id, cvss_score, severity, anomaly_score,
       finding_type, predicted_risk, model_version, event_time
FROM (SELECT d.*, ROW_NUMBER() OVER (PARTITION BY _id ORDER BY ip_address DESC NULLS LAST,
        device_type DESC NULLS LAST, cvss_score DESC NULLS LAST, severity DESC NULLS LAST,
        anomaly_score DESC NULLS LAST, finding_type DESC NULLS LAST, model_version DESC NULLS LAST) AS rn
      FROM (SELECT *, sha256(CONCAT_WS('|', tenant_id, asset_id, cve_id, event_time, predicted_risk)) AS _id
            FROM (SELECT COALESCE(tenant_id, '') AS tenant_id, COALESCE(asset_id, '') AS asset_id,
                         COALESCE(device_type, '') AS device_type, COALESCE(ip_address, '') AS ip_address,
                         COALESCE(cve_id, '') AS cve_id, COALESCE(cvss_score, 0.0) AS cvss_score,
                         COALESCE(severity, '') AS severity, COALESCE(anomaly_score, 0.0) AS anomaly_score,
                         COALESCE(finding_type, '') AS finding_type, COALESCE(predicted_risk, '') AS predicted_risk,
                         COALESCE(model_version, '') AS model_version,
                         strftime(TRY_CAST(event_time AS TIMESTAMP), '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time
                  FROM ml_findings)
            WHERE event_time IS NOT NULL) d) WHERE rn = 1""",
    "cdc_latest": """
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key_tenant_id, key_asset_id
                                            ORDER BY ts_ms DESC, seq DESC) AS rn
               FROM assets_cdc_flat) WHERE rn = 1""",
    "multiplexed": """
SELECT 'secflow.public.assets' AS topic, CONCAT_WS('|', key_tenant_id, key_asset_id) AS key_text, op, ts_ms
FROM assets_cdc_flat
UNION ALL
SELECT 'secflow.public.network_interfaces', CONCAT_WS('|', tenant_id, interface_id), 'r',
       epoch_us(last_seen_at) // 1000 FROM network_interfaces
UNION ALL
SELECT 'secflow.public.asset_cves', CONCAT_WS('|', tenant_id, CAST(cve_record_id AS VARCHAR)), 'r',
       epoch_us(discovered_at) // 1000 FROM asset_cves""",
}



def series_chain(prefix: str, source: str, order: str) -> dict[str, str]:
    """SQL fragments of the anomaly model over ``source`` ordered by ``order`` within a tenant."""
    win = f"PARTITION BY tenant_id ORDER BY (cvss_score IS NULL), {order}"
    has = "x IS NOT NULL AND y IS NOT NULL"
    sums = ",\n       ".join(f"SUM(CASE WHEN {has} THEN {e} ELSE 0 END) OVER cw AS c_{k}"
                             for k, e in (("n", "1"), ("x", "x"), ("y", "y"), ("xx", "x * x"), ("xy", "x * y"),
                                          ("yy", "y * y")))
    lags = ",\n       ".join(f"LAG(c_{k}, 1, 0) OVER lw - LAG(c_{k}, 101, 0) OVER lw AS w_{k}"
                             for k in ("n", "x", "y", "xx", "xy", "yy"))
    band = "GREATEST(2.5758 * (sqrt(rss) / CAST(w_n AS DOUBLE) / 10.0), 1e-6)"
    return {
        f"{prefix}series_prep": f"""
SELECT j.*, CAST(ROUND(cvss_score * 10) AS BIGINT) AS y,
       LAG(CAST(ROUND(cvss_score * 10) AS BIGINT)) OVER sw AS x
FROM {source} j
WINDOW sw AS ({win})""",
        f"{prefix}series_cum": f"""
SELECT p.*, {sums}
FROM {prefix}series_prep p
WINDOW cw AS ({win} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        f"{prefix}series_win": f"""
SELECT s.*, {lags}
FROM {prefix}series_cum s
WINDOW lw AS ({win})""",
        f"{prefix}series_fit": f"""
SELECT v.*,
       (w_n >= 10 AND (w_n * w_xx - w_x * w_x) <> 0 AND y IS NOT NULL) AS fit,
       CAST(w_n * w_xy - w_x * w_y AS DOUBLE) / CAST(w_n * w_xx - w_x * w_x AS DOUBLE) AS slope
FROM {prefix}series_win v""",
        f"{prefix}series_model": f"""
SELECT f.*,
       (CAST(w_y AS DOUBLE) - slope * CAST(w_x AS DOUBLE)) / CAST(w_n AS DOUBLE)
         + slope * CAST(x AS DOUBLE) AS fc_t,
       GREATEST(CAST(w_n * w_yy - w_y * w_y AS DOUBLE) - slope * CAST(w_n * w_xy - w_x * w_y AS DOUBLE), 0.0) AS rss
FROM {prefix}series_fit f""",
        f"{prefix}scored": f"""
SELECT m.*,
       CASE WHEN y IS NOT NULL THEN CAST(w_n AS INT) END AS a_n,
       CASE WHEN fit THEN fc_t / 10.0 END AS a_forecast,
       CASE WHEN fit THEN sqrt(rss) / CAST(w_n AS DOUBLE) / 10.0 END AS a_rmse,
       CASE WHEN fit THEN abs(CAST(y AS DOUBLE) - fc_t) / 10.0 > {band} END AS is_anomaly,
       {band} AS a_band
FROM {prefix}series_model m""",
    }


FRAGMENTS.update(series_chain("", "joined_active",
                              "date_trunc('millisecond', discovered_at), cve_record_id, interface_id"))
FRAGMENTS.update(series_chain("cve_", "asset_cves", "date_trunc('millisecond', discovered_at), cve_record_id"))

_DEPENDS = {
    "in_assets": ["assets"],
    "in_interfaces": ["network_interfaces"],
    "in_cves": ["asset_cves"],
    "joined_active": ["assets", "network_interfaces", "asset_cves"],
    "series_prep": ["joined_active"],
    "series_cum": ["series_prep"],
    "series_win": ["series_cum"],
    "series_fit": ["series_win"],
    "series_model": ["series_fit"],
    "scored": ["series_model"],
    "cve_series_prep": ["asset_cves"],
    "cve_series_cum": ["cve_series_prep"],
    "cve_series_win": ["cve_series_cum"],
    "cve_series_fit": ["cve_series_win"],
    "cve_series_model": ["cve_series_fit"],
    "cve_scored": ["cve_series_model"],
    "ml_findings": ["scored"],
    "findings_latest": ["ml_findings"],
    "doc_prep": ["ml_findings"],
    "finding_docs": ["doc_prep"],
    "bi_rows": ["findings_latest"],
    "decoded_docs": ["ml_findings"],
    "rule_rows": ["assets", "network_interfaces", "asset_cves"],
    "cdc_latest": ["assets_cdc_flat"],
    "multiplexed": ["assets_cdc_flat", "network_interfaces", "asset_cves"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str):
        for d in _DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(uses: list[str], body: str) -> str:
    parts = []
    for name in _closure(uses):
        text = ADAPTERS.get(name) or FRAGMENTS[name]
        parts.append(f"{name} AS ({text}\n)")
    return "WITH " + ",\n".join(parts) + "\n" + body
