"""Declared schemas and fixed domain values.

Nothing is inferred at query time: every entity, envelope and sink table has an
explicit StructType here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the modelled pipeline's for identical results.
# ---------------------------------------------------------------------------
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH"]
SEVERITIES = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
PREDICTED_RISKS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
LIVE_OPS = ["c", "r", "u"]
FINDING_TYPE_RULE = "VULNERABLE_ACTIVE_DEVICE"
FINDING_TYPE_ML = "ML_ANOMALY_RISK_PREDICTION"
MODEL_VERSION_RULE = "demo-ml-v1"
MODEL_VERSION_ML = "arima-anomaly-v1"
RULE_SCORE = 0.94
BAND_SCORES = (0.94, 0.82, 0.31)      # cvss >= 9.0, >= 7.0, else
ANOMALY_SCORE = 0.99
BI_WINDOW = "10 minutes"
BI_WINDOW_MS = 600_000
RETENTION_MS = 604_800_000            # 7 days
ANOMALY_MIN_TRAINING = 10
ANOMALY_MAX_TRAINING = 100
# Column length limits of the source tables (VARCHAR(n)); UUID columns are 36 chars.
LENGTH_LIMITS = {
    "assets": {"tenant_id": 64, "asset_id": 36, "device_type": 50, "os_vendor": 100,
               "os_version": 50, "firmware_version": 50, "risk_level": 20},
    "network_interfaces": {"tenant_id": 64, "interface_id": 36, "asset_id": 36,
                           "mac_address": 17, "ip_address": 45},
    "asset_cves": {"tenant_id": 64, "asset_id": 36, "cve_id": 20, "severity": 20},
}
NOT_NULL = {
    "assets": ["tenant_id", "asset_id", "device_type"],
    "network_interfaces": ["tenant_id", "interface_id", "asset_id", "mac_address"],
    "asset_cves": ["tenant_id", "cve_record_id", "asset_id", "cve_id", "severity"],
}
PRIMARY_KEYS = {
    "assets": ["tenant_id", "asset_id"],
    "network_interfaces": ["tenant_id", "interface_id"],
    "asset_cves": ["tenant_id", "cve_record_id"],
}
# Column defaults of the source tables.
DEFAULTS = {
    "assets": {"risk_level": "LOW", "is_quarantined": False},
    "network_interfaces": {"is_active": True},
}
# Topic routing: "<server>.public.<table>" -> "<table>".
ROUTE_PATTERN = r"^[^.]+\.public\.(.*)$"
ROUTE_REPLACEMENT = "$1"
INCLUDED_TABLES = ["assets", "network_interfaces", "asset_cves"]

# ---------------------------------------------------------------------------
# Entity schemas
# ---------------------------------------------------------------------------
ASSETS = T.StructType([
    T.StructField("tenant_id", T.StringType(), False),
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("device_type", T.StringType(), False),
    T.StructField("os_vendor", T.StringType()),
    T.StructField("os_version", T.StringType()),
    T.StructField("firmware_version", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("is_quarantined", T.BooleanType()),
])

NETWORK_INTERFACES = T.StructType([
    T.StructField("tenant_id", T.StringType(), False),
    T.StructField("interface_id", T.StringType(), False),
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("mac_address", T.StringType(), False),
    T.StructField("ip_address", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])

ASSET_CVES = T.StructType([
    T.StructField("tenant_id", T.StringType(), False),
    T.StructField("cve_record_id", T.IntegerType(), False),
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("cve_id", T.StringType(), False),
    T.StructField("cvss_score", T.DoubleType()),
    T.StructField("severity", T.StringType(), False),
    T.StructField("discovered_at", T.TimestampType()),
])

# Finding as written to the findings sink (upsert on ``key``).
FINDING = T.StructType([
    T.StructField("key", T.BinaryType(), False),
    T.StructField("tenant_id", T.StringType()),
    T.StructField("asset_id", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("cve_id", T.StringType()),
    T.StructField("cvss_score", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("anomaly_score", T.DoubleType()),
    T.StructField("finding_type", T.StringType()),
    T.StructField("predicted_risk", T.StringType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("event_time", T.StringType()),
])

FINDING_COLUMNS = [f.name for f in FINDING.fields]
DOCUMENT_COLUMNS = [c for c in FINDING_COLUMNS if c != "key"]

# Typed mapping of the finding document table (keyword/ip -> string, float -> double, date -> timestamp).
FINDING_DOCUMENT = T.StructType(
    [T.StructField("_id", T.StringType(), False)]
    + [T.StructField(c, T.DoubleType() if c in ("cvss_score", "anomaly_score") else T.StringType())
       for c in DOCUMENT_COLUMNS]
)

def envelope(after: T.StructType, key_fields: list[str]) -> T.StructType:
    """Change envelope: message key, row image after the change, op code, change time."""
    key = T.StructType([f for f in after.fields if f.name in key_fields])
    return T.StructType([
        T.StructField("key", key),
        T.StructField("after", after),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


# Governance metadata (one JSON document per dataset).
GOVERNANCE_METADATA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("environment", T.StringType()),
    T.StructField("owner", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("classification", T.StringType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("labels", T.StructType([
        T.StructField("sensitivity", T.StringType()),
        T.StructField("retention", T.StringType()),
        T.StructField("source", T.StringType()),
    ])),
])

TAG_DEFINITION = T.StructType([
    T.StructField("entityTypes", T.ArrayType(T.StringType())),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
])
