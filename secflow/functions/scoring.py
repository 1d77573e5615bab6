"""Scoring and banding column expressions (all JVM-side, codegen-friendly).

Three-valued logic is kept on purpose: ``is_active``/``is_quarantined`` and
``cvss_score`` are nullable, and a NULL comparison never selects a branch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from secflow import schemas as S


def _dbl(x: float) -> Column:
    return F.lit(x).cast("double")


def severity_from_cvss(cvss: Column) -> Column:
    """CVSS -> severity with 9/7/4 bands; NULL cvss falls through to LOW."""
    return (F.when(cvss >= 9.0, "CRITICAL").when(cvss >= 7.0, "HIGH")
             .when(cvss >= 4.0, "MEDIUM").otherwise("LOW"))


def band_score(cvss: Column) -> Column:
    """Enrichment score: 0.94 for cvss >= 9, 0.82 for >= 7, else 0.31 (NULL included)."""
    hi, mid, lo = S.BAND_SCORES
    return F.when(cvss >= 9.0, _dbl(hi)).when(cvss >= 7.0, _dbl(mid)).otherwise(_dbl(lo))


def feature_risk(cvss: Column, is_active: Column, is_quarantined: Column, severity: Column) -> Column:
    """Predicted risk of the feature view (activity, quarantine and severity aware)."""
    sev = F.upper(severity)
    return (F.when((cvss >= 9.0) & is_active & ~is_quarantined, "CRITICAL")
             .when((cvss >= 7.0) | (sev == "HIGH"), "HIGH")
             .when((cvss >= 4.0) | (sev == "MEDIUM"), "MEDIUM")
             .otherwise("LOW"))


def anomaly_flag(anomaly: Column) -> Column:
    """``COALESCE(anomaly.is_anomaly, FALSE)``."""
    return F.coalesce(anomaly.getField("is_anomaly"), F.lit(False))


def anomaly_score(is_anomaly: Column, cvss: Column) -> Column:
    """0.99 when anomalous, else cvss/10 (NULL cvss stays NULL)."""
    return F.when(is_anomaly, _dbl(S.ANOMALY_SCORE)).otherwise(cvss / F.lit(10.0)).cast("double")


def anomaly_risk(is_anomaly: Column, cvss: Column) -> Column:
    """Predicted risk of the scoring job."""
    return (F.when(is_anomaly & (cvss >= 7.0), "CRITICAL")
             .when(is_anomaly | (cvss >= 7.0), "HIGH")
             .when(cvss >= 4.0, "MEDIUM")
             .otherwise("LOW"))
