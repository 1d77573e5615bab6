"""The joined series scored run by run against the same model over every joined row."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.operators import anomaly, findings
from secflow.operators.anomaly import AnomalyParams, detect
from secflow.operators.enrich import join_active
from secflow.plans import catalog
from tests.helpers import assets_df, cves_df, interfaces_df

BASE = datetime(2024, 1, 1)
TABLES = "/root/testdata/sf0.001"


def _entities(spark, seed, finer=False, shared=True):
    """Tenants of different size; assets with none to 130 interfaces, one twice; missing scores, times and ids;
    with ``shared`` records of two assets with one id and time."""
    rnd = random.Random(seed)
    assets, interfaces, cves, rid = [], [], [], 0
    for t, n in (("A", 12), ("B", 3)):
        for i in range(n):
            a = f"{t}{i}"
            assets.append((t, a, "server", "HIGH", False))
            for k in range(130 if (t, i) == ("A", 1) else rnd.randrange(0, 6)):
                interfaces.append((t, f"{i}-{rnd.randrange(10**6)}-{k}", a, f"10.0.{i}.{k}", rnd.random() < 0.8))
            for _ in range(rnd.randrange(20, 50)):
                rid += 1
                score = None if rnd.random() < 0.05 else rnd.uniform(3, 10) if finer else round(rnd.uniform(3, 10), 1)
                when = None if rnd.random() < 0.02 else BASE + timedelta(seconds=rnd.randrange(100))
                cves.append((t, rid, a, f"CVE-{rid}", score, "HIGH", when))
                if shared and rnd.random() < 0.1:
                    other = f"{t}{(i + rnd.randrange(1, n)) % n}"
                    cves.append((t, rid, other, f"CVE-{rid}", round(rnd.uniform(3, 10), 1), "HIGH", when))
    return assets_df(spark, assets), interfaces_df(spark, interfaces), cves_df(spark, cves)


def _rows(df):
    return sorted((tuple(r) for r in df.select(
        "tenant_id", "asset_id", "device_type", "interface_id", "ip_address", "cve_record_id", "cve_id", "cvss_score",
        "discovered_at", "anomaly.*").collect()), key=str)


@pytest.mark.parametrize("finer, share", [(False, 1 << 18), (True, 1 << 18), (False, 100)])
def test_runs_give_the_scores_of_every_joined_row(spark, monkeypatch, finer, share):
    monkeypatch.setattr(findings, "JOINED_PER_TASK", share)
    ents = _entities(spark, 5, finer)
    params = AnomalyParams(block_rows=150)
    expect = detect(join_active(*ents), "cvss_score", "tenant_id", findings.series_order(), params, num_partitions=4)
    got = findings.scored_series(*ents, params)
    assert _rows(got) == _rows(expect)
    flags = findings.scored_series(*ents, params, fields=("is_anomaly",)).groupBy("anomaly.is_anomaly").count()
    assert sorted(map(tuple, flags.collect()), key=str) == sorted(
        map(tuple, expect.groupBy("anomaly.is_anomaly").count().collect()), key=str)


def test_no_rows(spark):
    ents = [df.limit(0) for df in _entities(spark, 1)]
    assert findings.scored_series(*ents).count() == 0


def test_series_is_sorted_as_one_row_per_record(spark, monkeypatch):
    """Neither the positions nor a task of the join grows with the fan-out."""
    written = []

    def spy(df, name):
        out = keep(df, name)
        written.append(out.count())
        return out
    keep = anomaly.materialize
    monkeypatch.setattr(anomaly, "materialize", spy)
    ents = _entities(spark, 3, shared=False)
    scored = findings.scored_series(*ents)
    assert written and max(written) <= ents[2].count() < scored.count()


def test_join_of_findings_has_tasks_by_joined_rows(spark, monkeypatch):
    monkeypatch.setattr(findings, "JOINED_PER_TASK", 500)
    found = catalog.ml_findings(spark, TABLES)
    n = found.count()
    per_task = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert n > 5000 and per_task < 1500


def _above_join(df):
    """Plan lines above the fan-out join, top first."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return lines[:next(i for i, line in enumerate(lines) if "Join" in line)]


def test_documents_share_the_join_shuffle_and_hash_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(findings, "JOINED_PER_TASK", 2000)
    lines = _above_join(findings.documents(catalog.ml_findings(spark, TABLES)))
    grouped = [i for i, line in enumerate(lines) if "Aggregate(" in line]
    assert sum("Exchange" in line for line in lines) == 1
    # Ids are hashed above the first grouping of the joined rows, not for each of them.
    hashed = [i for i, line in enumerate(lines) if "sha2(" in line]
    assert hashed and max(hashed) < max(grouped)


def test_upsert_parses_times_of_what_is_left(spark, monkeypatch):
    monkeypatch.setattr(findings, "JOINED_PER_TASK", 2000)
    lines = _above_join(findings.upsert_latest(catalog.ml_findings(spark, TABLES)))
    grouped = [i for i, line in enumerate(lines) if "Aggregate(" in line]
    parsed = [i for i, line in enumerate(lines) if "regexp_replace" in line or "gettimestamp" in line]
    assert sum("Exchange" in line for line in lines) == 1
    assert parsed and max(parsed) < max(grouped)


def _finding(tenant, asset, cve, when, ip, risk="HIGH", key="k"):
    return (key.encode(), tenant, asset, "server", ip, cve, 7.5, "HIGH", 0.75, S.FINDING_TYPE_ML, risk,
            S.MODEL_VERSION_ML, when)


def test_grouping_in_two_steps_meets_across_texts_and_fields(spark):
    rows = [_finding("t", "a", "c", "2026-08-27 10:30:00.000", "10.0.0.1"),
            _finding("t", "a", "c", "2026-08-27T10:30:00Z", "10.0.0.9"),          # the same instant
            _finding("t|a", "c", None, "2026-08-27 10:30:00.000", "10.0.0.2"),
            _finding("t", "a|c", "", "2026-08-27 12:30:00+02:00", "10.0.0.3")]    # runs together with the row before
    docs = findings.documents(spark.createDataFrame(rows, S.FINDING)).collect()
    assert sorted((r.ip_address, r.tenant_id, r.event_time) for r in docs) == [
        ("10.0.0.3", "t", "2026-08-27T10:30:00.000000Z"), ("10.0.0.9", "t", "2026-08-27T10:30:00.000000Z")]
    newest = findings.upsert_latest(spark.createDataFrame(
        rows + [_finding("t", "b", "c", "2026-08-27 11:00:00+02:00", "10.9.9.9")], S.FINDING)).collect()
    assert [(r.tenant_id, r.asset_id, r.ip_address) for r in newest] == [("t", "a", "10.0.0.9")]
