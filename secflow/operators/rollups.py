"""Aggregations, tumbling-window rollups, KPIs and top-N reports.

All group-bys run as partial + final hash aggregation (one shuffle of
already-combined rows), so a hot group costs one row per map task in the
exchange.  Top-N reports end in ``orderBy(...).limit(n)``, which Spark plans
as ``TakeOrderedAndProject`` (per-partition top-n, then a merge of n rows per
partition), never a full sort.  Per-parent top-N uses ``dense_rank`` windows
over the already-aggregated buckets, whose count is bounded by the number of
distinct key combinations, not by the number of findings.

Averages of scores are taken over the values as they are (``exact_avg``), with
sums that do not depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.functions import keys as K
from secflow.functions.exact import exact_avg


def avg_cvss(col: str = "cvss_score") -> Column:
    return exact_avg(F.col(col))


def avg_score(col: str = "anomaly_score") -> Column:
    return exact_avg(F.col(col))


# --- per-tenant demo aggregations -------------------------------------------------

def critical_cves(cves: DataFrame) -> DataFrame:
    return cves.filter(F.col("severity") == "CRITICAL").groupBy("tenant_id") \
               .agg(F.count(F.lit(1)).alias("critical_cves"))


def high_risk_assets(assets: DataFrame) -> DataFrame:
    return assets.filter(F.col("risk_level") == "HIGH").groupBy("tenant_id") \
                 .agg(F.count(F.lit(1)).alias("high_risk_assets"))


def tenant_avg_cvss(cves: DataFrame) -> DataFrame:
    return cves.groupBy("tenant_id").agg(avg_cvss().alias("avg_cvss"))


def cves_per_tenant(cves: DataFrame) -> DataFrame:
    return cves.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("cve_count"))


def quarantined_assets(assets: DataFrame) -> DataFrame:
    return assets.filter(F.col("is_quarantined") == F.lit(True)).groupBy("tenant_id") \
                 .agg(F.count(F.lit(1)).alias("quarantined_assets"))


def active_vulnerable_devices(assets: DataFrame, interfaces: DataFrame, cves: DataFrame,
                              min_cvss: float = 7.0) -> DataFrame:
    """Assets with an active interface and a CVE of CVSS >= ``min_cvss``, per tenant.

    Two semi joins instead of the full three-way join: no interface x CVE
    fan-out is ever materialized, and no distinct count is needed.
    """
    keys = ["tenant_id", "asset_id"]
    act = interfaces.filter(F.col("is_active") == F.lit(True)).select(*keys).distinct()
    vul = cves.filter(F.col("cvss_score") >= min_cvss).select(*keys).distinct()
    hit = assets.select(*keys).join(act, keys, "left_semi").join(vul, keys, "left_semi")
    return hit.groupBy("tenant_id").agg(F.count(F.lit(1)).alias("active_vulnerable_devices"))


def high_risk_per_window(asset_versions: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Distinct assets seen at risk HIGH per tumbling window of change time."""
    hi = asset_versions.filter(F.col("risk_level") == "HIGH")
    g = hi.groupBy(F.window(K.change_time(F.col("ts_ms")), width).alias("w"), "tenant_id") \
          .agg(F.count_distinct("asset_id").alias("high_risk_assets"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "tenant_id", "high_risk_assets")


# --- findings reports -----------------------------------------------------------------

def count_by(df: DataFrame, key: str | list[str], name: str = "findings") -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_n(df: DataFrame, key: str, n: int, metric: str | None = None, name: str = "findings") -> DataFrame:
    """Terms panel: top ``n`` keys by document count (or by ``sum(metric)``), ties by key."""
    value = F.count(F.lit(1)) if metric is None else F.sum(metric)
    g = df.groupBy(key).agg(value.alias(name))
    return g.orderBy(F.col(name).desc(), F.col(key).asc_nulls_last()).limit(n)


def kpi_count(df: DataFrame, predicate: Column | None = None, name: str = "findings") -> DataFrame:
    if predicate is not None:
        df = df.filter(predicate)
    return df.agg(F.count(F.lit(1)).alias(name))


def alerts_per_tenant(findings: DataFrame) -> DataFrame:
    return findings.filter(F.col("predicted_risk") == "CRITICAL").groupBy("tenant_id") \
                   .agg(F.count(F.lit(1)).alias("alerts"))


def top_device_types(findings: DataFrame, n: int = 20) -> DataFrame:
    g = findings.groupBy("device_type").agg(F.count(F.lit(1)).alias("findings"),
                                            avg_cvss().alias("avg_cvss_score"))
    return g.orderBy(F.col("findings").desc(), F.col("device_type").asc_nulls_last()).limit(n)


def top_devices(findings: DataFrame, n: int = 10) -> DataFrame:
    g = findings.groupBy("tenant_id", "asset_id", "device_type").agg(
        F.count(F.lit(1)).alias("findings"), avg_cvss().alias("avg_cvss_score"))
    return g.orderBy(F.col("findings").desc(), "tenant_id", "asset_id").limit(n)


def top_cves(findings: DataFrame, n: int = 10) -> DataFrame:
    return top_n(findings, "cve_id", n)


def avg_scores(findings: DataFrame) -> DataFrame:
    """Average CVSS and anomaly score by tenant plus the overall row (tenant NULL)."""
    return findings.rollup("tenant_id").agg(
        F.count(F.lit(1)).alias("findings"),
        avg_cvss().alias("avg_cvss_score"),
        avg_score().alias("avg_anomaly_score"))


def findings_over_time(docs: DataFrame, width: str = "1 hour") -> DataFrame:
    ts = K.parse_event_time(F.col("event_time"))
    g = docs.filter(ts.isNotNull()).groupBy(F.window(ts, width).alias("w")) \
            .agg(F.count(F.lit(1)).alias("findings"))
    return g.select(F.col("w.start").alias("bucket_start"), "findings")


def cvss_above(findings: DataFrame, threshold: float = 9.0) -> DataFrame:
    return findings.filter(F.col("cvss_score") > threshold)


def facet_filter(findings: DataFrame, **facets) -> DataFrame:
    """Dashboard filters: each of tenant_id / severity / device_type / cve_id / finding_type
    may be a value or a list of values; omitted facets do not filter."""
    allowed = {"tenant_id", "severity", "device_type", "cve_id", "finding_type"}
    pred = F.lit(True)
    for name, val in facets.items():
        if name not in allowed:
            raise ValueError(f"unknown facet {name}")
        if val is None:
            continue
        vals = val if isinstance(val, (list, tuple, set)) else [val]
        pred = pred & F.col(name).isin(list(vals))
    return findings.filter(pred)


# --- BI rollup ------------------------------------------------------------------------

def bi_rollup(findings: DataFrame, width: str = S.BI_WINDOW) -> DataFrame:
    """Tumbling windows x tenant x severity x predicted risk; only non-empty windows."""
    ts = K.parse_event_time(F.col("event_time"))
    return window_buckets(findings.filter(ts.isNotNull()), ts, width)


def window_buckets(findings: DataFrame, instant: Column, width: str) -> DataFrame:
    """Counts and average scores by window, tenant, severity and predicted risk."""
    g = findings.groupBy(F.window(instant, width).alias("w"), "tenant_id", "severity", "predicted_risk").agg(
        F.count(F.lit(1)).alias("findings"), avg_cvss().alias("avg_cvss_score"), avg_score().alias("avg_anomaly_score"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *[c for c in g.columns if c != "w"])


def bi_documents(bi: DataFrame) -> DataFrame:
    """BI rows as documents: UTC ``...Z`` window bounds and a deterministic ``_id``."""
    start = K.iso_utc_seconds(F.col("window_start"))
    return bi.select(
        K.bi_doc_id(start, F.col("tenant_id"), F.col("severity"), F.col("predicted_risk")).alias("_id"),
        start.alias("window_start"), K.iso_utc_seconds(F.col("window_end")).alias("window_end"),
        "tenant_id", "severity", "predicted_risk", "findings", "avg_cvss_score", "avg_anomaly_score")


def bi_total(bi: DataFrame) -> DataFrame:
    return bi.agg(F.sum("findings").alias("total_findings"))


def bi_recent(bi: DataFrame, n: int = 200) -> DataFrame:
    return bi.orderBy(F.col("window_start").desc(), F.col("findings").desc(), "tenant_id", "severity",
                      "predicted_risk").limit(n)


def bi_rollup_topn(docs: DataFrame, tenants: int = 1000, severities: int = 10, risks: int = 10,
                   width: str = S.BI_WINDOW, salts: int = 32) -> DataFrame:
    """Nested bucket form: per window the top tenants, per tenant the top severities, per
    severity the top risks, each level ranked by its document count then key.  Documents
    lacking a severity are not counted; a document lacking a deeper key still counts for the
    levels above it, like nested terms buckets."""
    ts = K.parse_event_time(F.col("event_time"))
    # One aggregate over the documents; everything below works on its buckets.
    counted = docs.filter(F.col("severity").isNotNull() & ts.isNotNull() & F.col("tenant_id").isNotNull())
    buckets = window_buckets(counted, ts, width)
    in_tenant = Window.partitionBy("window_start", "tenant_id")
    totals = buckets.withColumn("_tt", F.sum("findings").over(in_tenant)).withColumn(
        "_st", F.sum("findings").over(Window.partitionBy("window_start", "tenant_id", "severity")))
    by_severity = totals.withColumn("_sr", F.dense_rank().over(
        in_tenant.orderBy(F.col("_st").desc(), F.col("severity")))).filter(F.col("_sr") <= severities)
    leaf = by_severity.filter(F.col("predicted_risk").isNotNull()).withColumn("_rr", F.row_number().over(
        Window.partitionBy("window_start", "tenant_id", "severity").orderBy(
            F.col("findings").desc(), F.col("predicted_risk")))).filter(F.col("_rr") <= risks)
    # Tenants: top-k per window in two phases, so no task ranks all tenants of a window.  A tenant's
    # rows share their total, so dense ranks count tenants, and the top k of every salt hold the top k.
    by_tot = [F.col("_tt").desc(), F.col("tenant_id")]
    salted = leaf.withColumn("_salt", F.pmod(F.xxhash64("tenant_id"), F.lit(salts)))
    first = salted.withColumn("_r1", F.dense_rank().over(
        Window.partitionBy("window_start", "_salt").orderBy(*by_tot))).filter(F.col("_r1") <= tenants)
    kept = first.withColumn("_tr", F.dense_rank().over(Window.partitionBy("window_start").orderBy(*by_tot))) \
                .filter(F.col("_tr") <= tenants)
    return kept.select("window_start", "window_end", "tenant_id", "severity", "predicted_risk", "findings",
                       "avg_cvss_score", "avg_anomaly_score")
