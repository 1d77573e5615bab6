"""Three-way entity join and the rules evaluated on it.

Every join is an inner equi-join on ``(tenant_id, asset_id)``.  Filters written
after the join (risk level, activity, CVSS) are pushed below it by Catalyst.
No broadcast hint is given: AQE switches a side to broadcast only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold``.

Hot assets.  AQE splits a skewed partition only where both inputs of a join
come straight from a shuffle.  A second join that reuses the first one's
partitioning has no such shuffle, and one asset's interfaces x CVEs would stay
in one task.  The second join is therefore keyed by the pair as one struct,
which costs one shuffle of the small asset-interface side and lets AQE split
the CVE side of a hot asset over many tasks.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.functions.keys import EVENT_TIME_FORMAT
from secflow.functions.scoring import band_score, feature_risk

JOIN_KEYS = ["tenant_id", "asset_id"]


def as_of_literal(as_of: str | datetime) -> Column:
    """An injected clock value (replaces CURRENT_TIMESTAMP so results are reproducible)."""
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp")


def as_of_text(as_of: str | datetime) -> Column:
    return F.date_format(as_of_literal(as_of), EVENT_TIME_FORMAT)


def join_entities(assets: DataFrame, interfaces: DataFrame, cves: DataFrame,
                  asset_cols: list[str], interface_cols: list[str], cve_cols: list[str]) -> DataFrame:
    a = assets.select(*JOIN_KEYS, *asset_cols)
    n = interfaces.select(*JOIN_KEYS, *interface_cols)
    c = cves.select(*JOIN_KEYS, *cve_cols)
    pair = F.struct(*JOIN_KEYS)
    # A struct equals itself even with NULL fields, an inner join on the columns would not.
    known = F.col(JOIN_KEYS[0]).isNotNull() & F.col(JOIN_KEYS[1]).isNotNull()
    left = a.join(n, JOIN_KEYS).withColumn("_pair", pair)
    return left.join(c.filter(known).withColumn("_pair", pair).drop(*JOIN_KEYS), "_pair").drop("_pair")


def detection_rule(assets: DataFrame, interfaces: DataFrame, cves: DataFrame, as_of) -> DataFrame:
    """HIGH-risk asset with an active interface and a CRITICAL CVE of CVSS >= 9.0."""
    a = assets.filter(F.col("risk_level") == "HIGH")
    n = interfaces.filter(F.col("is_active") == F.lit(True))
    c = cves.filter((F.col("cvss_score") >= 9.0) & (F.col("severity") == "CRITICAL"))
    j = join_entities(a, n, c, ["device_type"], ["ip_address"], ["cve_id", "cvss_score", "severity"])
    return j.select(
        "tenant_id", "asset_id", "device_type", "ip_address", "cve_id", "cvss_score", "severity",
        F.lit(S.RULE_SCORE).cast("double").alias("anomaly_score"),
        F.lit(S.FINDING_TYPE_RULE).alias("finding_type"),
        F.lit("CRITICAL").alias("predicted_risk"),
        F.lit(S.MODEL_VERSION_RULE).alias("model_version"),
        as_of_text(as_of).alias("event_time"),
    )


def enrichment(assets: DataFrame, interfaces: DataFrame, cves: DataFrame, as_of) -> DataFrame:
    """Every asset x interface x CVE combination with the CVSS band score."""
    j = join_entities(assets, interfaces, cves, ["device_type"], ["ip_address"],
                      ["cve_id", "cvss_score", "severity"])
    return j.select(
        "tenant_id", "asset_id", "device_type", "ip_address", "cve_id", "cvss_score", "severity",
        band_score(F.col("cvss_score")).alias("anomaly_score"),
        as_of_text(as_of).alias("event_time"),
    )


def risk_features(assets: DataFrame, interfaces: DataFrame, cves: DataFrame) -> DataFrame:
    """Feature view: active interfaces only, with the activity/quarantine-aware risk."""
    n = interfaces.filter(F.col("is_active") == F.lit(True))
    j = join_entities(assets, n, cves, ["device_type", "risk_level", "is_quarantined"],
                      ["ip_address", "is_active"], ["cve_id", "cvss_score", "severity"])
    return j.select(
        "tenant_id", "asset_id", "device_type",
        F.col("risk_level").alias("asset_risk_level"),
        "is_quarantined", "ip_address", "is_active", "cve_id", "cvss_score", "severity",
        feature_risk(F.col("cvss_score"), F.col("is_active"), F.col("is_quarantined"),
                     F.col("severity")).alias("predicted_risk"),
    )


def join_active(assets: DataFrame, interfaces: DataFrame, cves: DataFrame) -> DataFrame:
    """Input of the scoring job: one row per (active interface, CVE record) of an asset."""
    n = interfaces.filter(F.col("is_active") == F.lit(True))
    return join_entities(assets, n, cves, ["device_type"], ["interface_id", "ip_address"],
                         ["cve_record_id", "cve_id", "cvss_score", "severity", "discovered_at"])


def incident(rule_rows: DataFrame, activity: DataFrame, as_of=None, hours: int = 72) -> DataFrame:
    """Rule finding on an asset with suspicious activity in the ``hours`` before the finding (``as_of``),
    or at any time without ``as_of``."""
    recent = F.lit(True)
    if as_of is not None:
        end, seen = as_of_literal(as_of), F.col("activity_time").cast("timestamp")
        recent = (seen > end - F.make_dt_interval(hours=F.lit(hours))) & (seen <= end)
    # Distinct keys (partial aggregation): a hot asset adds one build row, not all its events.
    sus = activity.filter(F.col("is_suspicious") & recent).select(*JOIN_KEYS).distinct()
    return rule_rows.join(sus, JOIN_KEYS, "left_semi")


def threat_intel(df: DataFrame, feed: DataFrame) -> DataFrame:
    """Left-join findings with a threat-intelligence feed on ``cve_id``.

    The feed is pre-aggregated to one row per CVE (partial aggregation, so a CVE
    listed many times costs one row per map task) and the join therefore never
    multiplies finding rows.
    """
    per_cve = feed.groupBy("cve_id").agg(
        F.min("threat_actor").alias("threat_actor"),
        F.max(F.col("known_exploited").cast("int")).cast("boolean").alias("known_exploited"),
        F.count(F.lit(1)).alias("feed_entries"),
    )
    return df.join(per_cve, "cve_id", "left").select(
        *df.columns, "threat_actor",
        F.coalesce(F.col("known_exploited"), F.lit(False)).alias("known_exploited"),
        F.coalesce(F.col("feed_entries"), F.lit(0)).alias("feed_entries"),
    )
