"""Adapters deriving the security entities from the driver's tables.

``customer`` -> assets, ``orders`` -> network interfaces, ``events`` -> CVE
records, the asset change stream and asset activity, ``supplier`` -> a threat
intelligence feed.  The adapters are plain projections and equi-joins, so their
cost grows linearly with the input and they compose into the downstream plans
(Catalyst prunes whatever columns a query does not use).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.functions.scoring import severity_from_cvss
from secflow.sources.tables import read_table

# Fixed value lists used by the adapters (index = key modulo list length).
DEVICE_TYPES = ["firewall", "router", "switch", "server", "workstation", "iot-gateway"]
OS_VENDORS = ["Ubuntu", "RedHat", "Windows", "Cisco", "Fortinet", "Palo Alto"]
# events.event_type -> change op ('error' is a delete, 'signup' a create, 'view' a snapshot read).
EVENT_OPS = {"signup": "c", "view": "r", "error": "d"}
SUSPICIOUS_EVENT_TYPES = ["error"]
# Addresses that incoming interfaces may carry besides IPv4 (valid IPv6 first, then malformed).
BAD_AND_V6_ADDRESSES = ["::1", "::ffff:1.2.3.4", "2001:db8::8a2e:370:7334", "fe80::", "1:2:3:4:5:6:7:8",
                        ":", ":1", "1::2:", "1:2:3:4:5:6:7::1:2:3:4", "256.1.1.1", "10.0.0", ""]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def _str(c: Column) -> Column:
    return c.cast("string")


def _tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    k = F.col("c_custkey")
    return c.select(
        F.col("c_mktsegment").alias("tenant_id"),
        _str(k).alias("asset_id"),
        _pick(DEVICE_TYPES, k % 6).alias("device_type"),
        _pick(OS_VENDORS, F.col("c_nationkey") % 6).alias("os_vendor"),
        F.concat(_str(k % 15 + 1), F.lit("."), _str(k % 10)).alias("os_version"),
        F.concat(_str(k % 4 + 1), F.lit("."), _str(k % 21), F.lit("."), _str(k % 51)).alias("firmware_version"),
        F.when(F.col("c_acctbal") >= 6000, "HIGH").when(F.col("c_acctbal") >= 2000, "MEDIUM")
         .otherwise("LOW").alias("risk_level"),
        (k % 7 == 0).alias("is_quarantined"),
    )


def network_interfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    c = _tenants(spark, sf_dir)
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_mktsegment").alias("tenant_id"),
        _str(ok).alias("interface_id"),
        _str(ck).alias("asset_id"),
        F.concat(F.lit("02:00:00:00:"), F.lpad(_str(ok % 100), 2, "0"), F.lit(":"),
                 F.lpad(_str(ck % 100), 2, "0")).alias("mac_address"),
        F.concat(F.lit("10."), _str(ok % 256), F.lit("."), _str(ck % 256), F.lit("."),
                 _str((ok + ck) % 254 + 1)).alias("ip_address"),
        (F.col("o_orderstatus") != "F").alias("is_active"),
        F.col("o_orderdate").alias("last_seen_at"),
    )


def _cvss_from_value(event_id: Column, value: Column) -> Column:
    tenths = F.least(F.lit(100), F.lit(30) + F.floor(F.round(value * 100) / F.lit(250.0)).cast("bigint"))
    return F.when(event_id % 97 == 0, F.lit(None).cast("double")).otherwise(tenths.cast("double") / F.lit(10.0))


def asset_cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    c = _tenants(spark, sf_dir)
    eid = F.col("event_id")
    rows = e.join(c, e.user_id == c.c_custkey).select(
        F.col("c_mktsegment").alias("tenant_id"),
        eid.cast("long").alias("cve_record_id"),
        _str(F.col("user_id")).alias("asset_id"),
        F.concat(F.lit("CVE-2026-"), _str(10000 + eid % 90000)).alias("cve_id"),
        _cvss_from_value(eid, F.col("value")).alias("cvss_score"),
        F.col("ts").alias("discovered_at"),
    )
    return rows.select("tenant_id", "cve_record_id", "asset_id", "cve_id", "cvss_score",
                       severity_from_cvss(F.col("cvss_score")).alias("severity"), "discovered_at")


def incoming(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities as a source might deliver them, for the contract checks: every row of the entities plus
    rows that break the contract, derived from the same tables (repeated keys, missing and unknown
    references, missing values, over-long text, IPv6 and malformed addresses, out-of-range scores)."""
    a, n, c = assets(spark, sf_dir), network_interfaces(spark, sf_dir), asset_cves(spark, sf_dir)
    aid, iid = F.col("asset_id").cast("long"), F.col("interface_id").cast("long")
    text = lambda v: F.lit(v).cast("string")
    a_bad = a.filter(aid % 50 == 0).withColumns({
        "os_vendor": F.when(aid % 100 == 0, F.repeat(F.col("os_vendor"), 40)).otherwise(F.col("os_vendor")),
        "risk_level": F.when(aid % 150 == 0, text(None)).otherwise(F.col("risk_level")),
        "is_quarantined": F.when(aid % 200 == 0, F.lit(None).cast("boolean")).otherwise(F.col("is_quarantined"))})
    ips = F.array(*[F.lit(v) for v in BAD_AND_V6_ADDRESSES])
    n_bad = n.filter(iid % 40 == 0).withColumns({
        "asset_id": F.when(iid % 120 == 0, F.concat(F.lit("X"), F.col("asset_id"))).otherwise(F.col("asset_id")),
        "interface_id": F.when(iid % 80 == 0, F.concat(F.lit("v6-"), F.col("interface_id")))
                         .otherwise(F.col("interface_id")),
        "ip_address": F.element_at(ips, (F.floor(iid / 40).cast("long") % len(BAD_AND_V6_ADDRESSES) + 1).cast("int")),
        "mac_address": F.when(iid % 160 == 0, F.repeat(F.col("mac_address"), 20)).otherwise(F.col("mac_address")),
        "is_active": F.when(iid % 200 == 0, F.lit(None).cast("boolean")).otherwise(F.col("is_active"))})
    rid = F.col("cve_record_id")
    c_bad = c.filter(rid % 30 == 0).withColumns({
        "asset_id": F.when(rid % 90 == 0, F.concat(F.lit("X"), F.col("asset_id"))).otherwise(F.col("asset_id")),
        "severity": F.when(rid % 60 == 0, text(None)).otherwise(F.col("severity")),
        "cve_id": F.when(rid % 120 == 0, F.repeat(F.col("cve_id"), 20)).otherwise(F.col("cve_id")),
        "cvss_score": F.when(rid % 150 == 0, F.col("cvss_score") + 0.25).when(
            rid % 210 == 0, F.col("cvss_score") * 100).otherwise(F.col("cvss_score"))})
    return a.unionByName(a_bad), n.unionByName(n_bad), c.unionByName(c_bad)


def event_millis(ts: Column) -> Column:
    """Epoch milliseconds of a (possibly zone-less) timestamp, truncating like a CDC capture."""
    return F.unix_millis(ts.cast("timestamp"))


def assets_cdc_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat asset change rows: key columns, op, ts_ms, seq and the changed attributes."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    c = _tenants(spark, sf_dir)
    et = F.col("event_type")
    op = F.coalesce(_pick_map(EVENT_OPS, et), F.lit("u"))
    deleted = et == "error"
    return e.join(c, e.user_id == c.c_custkey).select(
        F.col("c_mktsegment").alias("key_tenant_id"),
        _str(F.col("c_custkey")).alias("key_asset_id"),
        op.alias("op"),
        event_millis(F.col("ts")).alias("ts_ms"),
        F.col("event_id").alias("seq"),
        F.when(deleted, F.lit(None).cast("string")).otherwise(_str(F.col("event_id") % 15 + 1)).alias("os_version"),
        F.when(deleted, F.lit(None).cast("string"))
         .when(F.col("value") >= 60, "HIGH").when(F.col("value") >= 20, "MEDIUM").otherwise("LOW")
         .alias("risk_level"),
    )


def _pick_map(mapping: dict[str, str], c: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr


def assets_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset change stream in envelope form: key struct, after struct (NULL on delete), op, ts_ms, seq."""
    flat = assets_cdc_flat(spark, sf_dir)
    return flat.select(
        F.struct(F.col("key_tenant_id").alias("tenant_id"), F.col("key_asset_id").alias("asset_id")).alias("key"),
        F.when(F.col("op") != "d", F.struct(
            F.col("key_tenant_id").alias("tenant_id"), F.col("key_asset_id").alias("asset_id"),
            "os_version", "risk_level")).alias("after"),
        "op", "ts_ms", "seq",
    )


def asset_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device activity per asset with a suspicious flag (event type 'error')."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    c = _tenants(spark, sf_dir)
    return e.join(c, e.user_id == c.c_custkey).select(
        F.col("c_mktsegment").alias("tenant_id"),
        _str(F.col("user_id")).alias("asset_id"),
        F.col("event_id").alias("activity_id"),
        F.col("event_type").alias("activity_type"),
        F.col("ts").alias("activity_time"),
        F.col("event_type").isin(SUSPICIOUS_EVENT_TYPES).alias("is_suspicious"),
    )


def threat_intel_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known-exploited CVE feed: one entry per supplier, CVE id derived from the supplier key."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    return s.select(
        F.concat(F.lit("CVE-2026-"), _str(10000 + (F.col("s_suppkey") * 7) % 90000)).alias("cve_id"),
        F.col("s_name").alias("threat_actor"),
        (F.col("s_suppkey") % 3 == 0).alias("known_exploited"),
    )
