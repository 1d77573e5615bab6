from datetime import datetime

from secflow import schemas as S


def ts(text):
    return datetime.fromisoformat(text)


def assets_df(spark, rows):
    """rows: (tenant, asset, device_type, risk_level, is_quarantined)"""
    return spark.createDataFrame([(t, a, d, "Ubuntu", "1.0", "1.0.0", r, q) for t, a, d, r, q in rows], S.ASSETS)


def interfaces_df(spark, rows):
    """rows: (tenant, interface, asset, ip, is_active)"""
    return spark.createDataFrame([(t, i, a, "02:00:00:00:00:00", ip, act) for t, i, a, ip, act in rows],
                                 S.NETWORK_INTERFACES)


def cves_df(spark, rows):
    """rows: (tenant, record_id, asset, cve, cvss, severity, discovered_at)"""
    return spark.createDataFrame([(t, r, a, c, s, sev, ts(d) if isinstance(d, str) else d)
                                  for t, r, a, c, s, sev, d in rows], S.ASSET_CVES)
