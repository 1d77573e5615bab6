"""Registered queries: each builds one DataFrame plan from the driver tables.

A query is ``fn(spark, sf_dir) -> DataFrame``.  Everything below composes the
library operators over the fixture adapters; no rows are collected.  Queries
on global positions (anomaly model, running statistics, bursts) write a
position table to the shared folder and read it back while the plan is built.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.functions import keys as K
from secflow.operators import anomaly, cdc, contracts, enrich, findings, governance, rollups
from secflow.operators import autoregressive, cep
from secflow.plans.oracle import AS_OF
from secflow.session import materialize, scratch_folder
from secflow.sinks.dated import DatedTable
from secflow.sources import fixtures as fx
from secflow.streaming import current, late

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    """Register ``fn``; naive timestamps mean UTC, so the session zone is pinned before planning."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def _entities(spark, d):
    return fx.assets(spark, d), fx.network_interfaces(spark, d), fx.asset_cves(spark, d)


def ml_findings(spark, d) -> DataFrame:
    return findings.ml_scoring(*_entities(spark, d))


def findings_table(spark, d) -> DataFrame:
    """Lakehouse copy of the upsert topic: current state per key."""
    return findings.upsert_latest(ml_findings(spark, d))


def finding_docs(spark, d) -> DataFrame:
    return findings.documents(ml_findings(spark, d))


def bi_rows(spark, d) -> DataFrame:
    return rollups.bi_rollup(findings_table(spark, d))


def _key_text(df: DataFrame) -> DataFrame:
    """Binary finding key shown as its UTF-8 text for comparison outputs."""
    return df.withColumn("key", F.decode(F.col("key"), "UTF-8"))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


# --- joins and rules -------------------------------------------------------------------

@query("detection_rule")
def q_detection_rule(spark, d):
    return enrich.detection_rule(*_entities(spark, d), as_of=AS_OF)


@query("detection_rule_current")
def q_detection_rule_current(spark, d):
    a, n, c = _entities(spark, d)
    current = cdc.apply_changes(a, fx.assets_cdc(spark, d), ["tenant_id", "asset_id"])
    return enrich.detection_rule(current, n, c, as_of=AS_OF)


# --- current state, micro-batch by micro-batch ---------------------------------------------

MICRO_BATCHES = 2
INCIDENT_WITHIN_MS = 3 * 86_400_000
LATE_BATCHES, LATE_DELAY_MS = 3, 86_400_000
STATE_BUCKETS = 8      # for tables of this size; a deployment takes as many as keep a bucket small


def _changes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A snapshot as changes that are older than any other."""
    return rows.select(F.struct(*keys).alias("key"), F.struct(*rows.columns).alias("after"), F.lit("r").alias("op"),
                       F.lit(-1).cast("long").alias("ts_ms"), F.lit(-1).cast("long").alias("seq"))


def asset_changes(spark, d) -> DataFrame:
    """Snapshot and change events of the assets with whole images."""
    keys = ["tenant_id", "asset_id"]
    rows = fx.assets(spark, d).select(*keys, "device_type", "risk_level")
    come = fx.assets_cdc(spark, d).select("key", F.col("after.risk_level").alias("risk"), "op", "ts_ms",
                                          F.col("seq").cast("long").alias("seq"))
    known = rows.select(F.struct(*keys).alias("key"), "device_type")
    image = F.struct(*[F.col("key." + k).alias(k) for k in keys], "device_type", F.col("risk").alias("risk_level"))
    full = come.join(known, "key").select("key", F.when(F.col("op") != "d", image).alias("after"), "op", "ts_ms", "seq")
    return _changes(rows, keys).unionByName(full)


def _arrivals(changes: DataFrame, batch: int) -> DataFrame:
    """The changes that arrive in a micro-batch: any mixture of old and new ones, deletes and snapshot rows."""
    return changes.filter(F.pmod(F.xxhash64("key", "seq"), F.lit(MICRO_BATCHES)) == batch)


def _rule_sources(spark, d) -> tuple[dict, dict[str, DataFrame]]:
    n = fx.network_interfaces(spark, d).select("tenant_id", "interface_id", "asset_id", "ip_address", "is_active")
    c = fx.asset_cves(spark, d).select("tenant_id", "cve_record_id", "asset_id", "cve_id", "cvss_score", "severity")
    changes = {"assets": asset_changes(spark, d), "interfaces": _changes(n, ["tenant_id", "interface_id"]),
               "cves": _changes(c, ["tenant_id", "cve_record_id"])}
    keys = {k: df.schema["key"].dataType.names for k, df in changes.items()}
    return {k: (df.schema["after"].dataType, keys[k]) for k, df in changes.items()}, changes


@query("detection_rule_incremental")
def q_rule_incremental(spark, d):
    entities, changes = _rule_sources(spark, d)
    rule = current.current_detection_rule(spark, scratch_folder(spark, "rule"), entities, AS_OF, buckets=STATE_BUCKETS)
    for b in range(MICRO_BATCHES):
        rule.apply({n: _arrivals(df, b) for n, df in changes.items()}, b)
    return rule.rows()


@query("agg_high_risk_incremental")
def q_high_risk_incremental(spark, d):
    entities, changes = _rule_sources(spark, d)
    folder = scratch_folder(spark, "high-risk")
    latest = current.LatestRows(spark, folder + "/assets", *entities["assets"], buckets=STATE_BUCKETS)
    risk = current.high_risk_assets(spark, folder + "/risk", buckets=STATE_BUCKETS)
    for b in range(MICRO_BATCHES):
        latest.apply(_arrivals(changes["assets"], b), b)
        risk.apply(latest.delta(b), b)
    return risk.rows().filter("high_risk_assets > 0")


@query("bi_rollup_incremental")
def q_rollup_incremental(spark, d):
    found = materialize(findings_table(spark, d), "rollup-findings")
    roll = current.IncrementalRollup(spark, scratch_folder(spark, "rollup"))
    for b in range(MICRO_BATCHES):
        roll.apply(found.filter(F.pmod(F.xxhash64("key"), F.lit(MICRO_BATCHES)) == b), b)
    return _ntz(roll.rows(), "window_start", "window_end")


@query("activity_totals_late")
def q_activity_late(spark, d):
    """Suspicious and other activity per tenant and day on a stream of three micro-batches, a fifth of the rows one batch late."""
    rows = fx.asset_activity(spark, d).select("tenant_id", "activity_id", F.col("activity_time").cast("timestamp")
                                              .alias("activity_time"), "is_suspicious")
    day = F.to_date("activity_time")
    due = F.when(day < "2024-01-11", 0).when(day < "2024-01-21", 1).otherwise(2)
    batch = F.least(due + F.when(F.col("activity_id") % 5 == 0, 1).otherwise(0), F.lit(LATE_BATCHES - 1))
    totals = late.LateAwareTotals(spark, scratch_folder(spark, "late"), rows.schema, "activity_time", "1 day", LATE_DELAY_MS,
                                  ["tenant_id"], {"events": F.lit(True), "suspicious": F.col("is_suspicious")})
    for b, part in enumerate(late.in_batches(rows, batch, LATE_BATCHES)):
        totals.apply(part, b)
    keys = ["tenant_id", "window_start", "events", "suspicious"]
    lost = totals.late_rows().groupBy("tenant_id", F.window("activity_time", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count(F.when(F.col("is_suspicious"), 1)).alias("suspicious"))
    lost = lost.withColumn("window_start", F.col("w.start"))
    out = [df.select(*keys, F.lit(place).alias("place")) for place, df in
           (("closed", totals.closed()), ("open", totals.open()), ("late", lost))]
    return _ntz(out[0].unionByName(out[1]).unionByName(out[2]), "window_start")


@query("enrichment")
def q_enrichment(spark, d):
    return enrich.enrichment(*_entities(spark, d), as_of=AS_OF)


@query("risk_prediction_features")
def q_risk_features(spark, d):
    return enrich.risk_features(*_entities(spark, d))


@query("anomaly_scores")
def q_anomaly_scores(spark, d):
    s = findings.scored_series(*_entities(spark, d))
    a = F.col("anomaly")
    return s.select("tenant_id", "cve_record_id", "interface_id", "cvss_score",
                    a.n.alias("n"), a.forecast.alias("forecast"), a.lower.alias("lower"),
                    a.upper.alias("upper"), a.rmse.alias("rmse"), a.is_anomaly.alias("is_anomaly"))


@query("anomaly_scores_cve")
def q_anomaly_scores_cve(spark, d):
    c = fx.asset_cves(spark, d).select("tenant_id", "cve_record_id", "cvss_score", "discovered_at")
    a = F.col("anomaly")
    return findings.score_cves(c).select(
        "tenant_id", "cve_record_id", "cvss_score", a.n.alias("n"), a.forecast.alias("forecast"),
        a.lower.alias("lower"), a.upper.alias("upper"), a.rmse.alias("rmse"), a.is_anomaly.alias("is_anomaly"))


@query("anomaly_scores_order")
def q_anomaly_order(spark, d):
    c = fx.asset_cves(spark, d).select("tenant_id", "cve_record_id", "cvss_score", "discovered_at")
    a = F.col("anomaly")
    scored = autoregressive.detect_order(c, "cvss_score", "tenant_id", [F.col("discovered_at"), F.col("cve_record_id")])
    return scored.select(
        "tenant_id", "cve_record_id", "cvss_score", a.n.alias("n"), a.p.alias("p"), a.d.alias("d"),
        a.forecast.alias("forecast"), a.rmse.alias("rmse"), a.is_anomaly.alias("is_anomaly"))


@query("ml_scoring")
def q_ml_scoring(spark, d):
    return _key_text(ml_findings(spark, d))


@query("running_cvss_range")
def q_running(spark, d):
    c = fx.asset_cves(spark, d).select("tenant_id", "cve_record_id", "cvss_score", "discovered_at")
    return anomaly.running_stats(c, "cvss_score", "tenant_id", "discovered_at", ["cve_record_id"])


@query("cep_incident")
def q_cep_incident(spark, d):
    rule = enrich.detection_rule(*_entities(spark, d), as_of=AS_OF)
    return enrich.incident(rule, fx.asset_activity(spark, d), as_of=AS_OF)


@query("cep_incident_ordered")
def q_incident_ordered(spark, d):
    a, _, c = _entities(spark, d)
    high = a.filter(F.col("risk_level") == "HIGH").select("tenant_id", "asset_id").distinct()
    critical = c.filter((F.col("cvss_score") >= 9.0) & (F.col("severity") == "CRITICAL"))
    return cep.followed_by(
        critical.join(high, ["tenant_id", "asset_id"], "left_semi"), fx.asset_activity(spark, d).filter("is_suspicious"),
        keys=["tenant_id", "asset_id"], ts="discovered_at", id_col="cve_record_id", then_ts="activity_time",
        then_id="activity_id", within_ms=INCIDENT_WITHIN_MS, carry=["cve_id"])


@query("threat_intel_enrichment")
def q_threat_intel(spark, d):
    return enrich.threat_intel(finding_docs(spark, d), fx.threat_intel_feed(spark, d))


@query("cep_burst_alert")
def q_burst(spark, d):
    return cep.burst(fx.asset_activity(spark, d).filter(F.col("is_suspicious")),
                     keys=["tenant_id", "asset_id"], ts="activity_time", id_col="activity_id",
                     window_ms=cep.DEFAULT_WINDOW_MS, min_events=cep.DEFAULT_MIN_EVENTS)


# --- findings sink semantics ------------------------------------------------------------

@query("findings_upsert_latest")
def q_upsert(spark, d):
    return _key_text(findings_table(spark, d))


@query("finding_documents")
def q_docs(spark, d):
    return finding_docs(spark, d)


@query("all_findings")
def q_all(spark, d):
    a, n, c = _entities(spark, d)
    return _key_text(findings.all_findings(enrich.detection_rule(a, n, c, as_of=AS_OF),
                                           findings.ml_scoring(a, n, c)))


@query("purge_missing_severity")
def q_purge(spark, d):
    # A record without a score has no trustworthy severity: its document arrives without one.
    docs = finding_docs(spark, d).withColumn("severity", F.when(F.col("cvss_score").isNotNull(), F.col("severity")))
    return findings.purge_missing_severity(docs)


@query("conform_findings")
def q_conform(spark, d):
    return _ntz(findings.conform_documents(finding_docs(spark, d)), "event_time")


@query("findings_retention_table")
def q_retention_table(spark, d):
    """Findings streamed into a table by event date, expired dates dropped, then read from the cutoff on."""
    found = materialize(findings_table(spark, d), "retention-findings")
    table = DatedTable(spark, scratch_folder(spark, "dated"), found.schema, K.parse_event_time(F.col("event_time")))
    for b in range(MICRO_BATCHES):
        table.write(found.filter(F.pmod(F.xxhash64("key"), F.lit(MICRO_BATCHES)) == b), b)
    cutoff = datetime.fromisoformat(AS_OF) - timedelta(milliseconds=S.RETENTION_MS)
    table.expire(cutoff)
    return _key_text(table.read(since=cutoff))


@query("findings_retention")
def q_retention(spark, d):
    return _key_text(findings.retention(findings_table(spark, d), AS_OF))


@query("findings_last_24h")
def q_last24(spark, d):
    return findings.last_hours(finding_docs(spark, d), "2024-01-30 12:00:00", 24)


@query("findings_json")
def q_json(spark, d):
    return findings.to_json_lines(finding_docs(spark, d))


@query("normalize_event_time")
def q_normalize(spark, d):
    c = fx.asset_cves(spark, d)
    return c.select("cve_record_id", K.event_time_text(F.col("discovered_at")).alias("event_time")) \
            .select("cve_record_id", "event_time",
                    K.normalize_event_time(F.col("event_time")).alias("normalized"))


@query("severity_from_cvss")
def q_severity(spark, d):
    from secflow.functions.scoring import severity_from_cvss
    c = fx.asset_cves(spark, d)
    return c.groupBy(severity_from_cvss(F.col("cvss_score")).alias("severity")) \
            .agg(F.count(F.lit(1)).alias("cves"))


@query("decode_findings")
def q_decode(spark, d):
    from secflow.sources.decode import decode_findings, encode_findings
    ok, _ = decode_findings(encode_findings(ml_findings(spark, d)))
    return findings.documents(ok, by_asset=False)


# --- aggregations ----------------------------------------------------------------------

@query("agg_critical_cves")
def q_e1(spark, d):
    return rollups.critical_cves(fx.asset_cves(spark, d))


@query("agg_high_risk_assets")
def q_e2(spark, d):
    return rollups.high_risk_assets(fx.assets(spark, d))


@query("agg_avg_cvss")
def q_e3(spark, d):
    return rollups.tenant_avg_cvss(fx.asset_cves(spark, d))


@query("agg_cves_per_tenant")
def q_s1(spark, d):
    return rollups.cves_per_tenant(fx.asset_cves(spark, d))


@query("agg_quarantined")
def q_s3(spark, d):
    return rollups.quarantined_assets(fx.assets(spark, d))


@query("active_vulnerable_devices")
def q_s4(spark, d):
    return rollups.active_vulnerable_devices(*_entities(spark, d))


@query("high_risk_5min")
def q_s2(spark, d):
    versions = cdc.current_rows(fx.assets_cdc(spark, d))
    return _ntz(rollups.high_risk_per_window(versions, "5 minutes"), "window_start", "window_end")


@query("top_device_types")
def q_e4(spark, d):
    return rollups.top_device_types(findings_table(spark, d), 20)


@query("kpi_total_findings")
def q_e5(spark, d):
    return rollups.kpi_count(finding_docs(spark, d))


@query("kpi_critical_findings")
def q_e6(spark, d):
    return rollups.kpi_count(finding_docs(spark, d), F.col("severity") == "CRITICAL")


@query("top_severity_findings")
def q_h3(spark, d):
    return rollups.top_n(finding_docs(spark, d), "severity", 5)


@query("top_risk_findings")
def q_h4(spark, d):
    return rollups.top_n(finding_docs(spark, d), "predicted_risk", 5)


@query("alerts_per_tenant")
def q_s5(spark, d):
    return rollups.alerts_per_tenant(finding_docs(spark, d))


@query("findings_by_tenant")
def q_s9(spark, d):
    return rollups.count_by(finding_docs(spark, d), "tenant_id")


@query("findings_by_severity")
def q_s10(spark, d):
    return rollups.count_by(finding_docs(spark, d), "severity")


@query("top_cves")
def q_s11(spark, d):
    return rollups.top_cves(finding_docs(spark, d), 10)


@query("avg_scores")
def q_s12(spark, d):
    return rollups.avg_scores(finding_docs(spark, d))


@query("findings_over_time")
def q_s13(spark, d):
    return _ntz(rollups.findings_over_time(finding_docs(spark, d), "1 hour"), "bucket_start")


@query("findings_cvss_gt9")
def q_s14(spark, d):
    return rollups.cvss_above(finding_docs(spark, d), 9.0)


@query("findings_filter")
def q_s15(spark, d):
    return rollups.facet_filter(finding_docs(spark, d), tenant_id=["BUILDING", "MACHINERY"],
                                severity="CRITICAL", device_type=["server", "router", "firewall"])


@query("top_devices")
def q_s16(spark, d):
    return rollups.top_devices(findings_table(spark, d), 10)


# --- BI rollups ------------------------------------------------------------------------

@query("bi_rollup")
def q_g1(spark, d):
    return _ntz(bi_rows(spark, d), "window_start", "window_end")


@query("bi_documents")
def q_bi_docs(spark, d):
    return rollups.bi_documents(bi_rows(spark, d))


@query("bi_total_findings")
def q_e7(spark, d):
    return rollups.bi_total(bi_rows(spark, d))


@query("bi_recent_200")
def q_h1(spark, d):
    return _ntz(rollups.bi_recent(bi_rows(spark, d), 200), "window_start", "window_end")


@query("bi_top_severity")
def q_h5(spark, d):
    return rollups.top_n(bi_rows(spark, d), "severity", 5, metric="findings")


@query("bi_top_risk")
def q_h6(spark, d):
    return rollups.top_n(bi_rows(spark, d), "predicted_risk", 5, metric="findings")


@query("bi_top_tenants")
def q_h7(spark, d):
    return rollups.top_n(bi_rows(spark, d), "tenant_id", 10, metric="findings")


@query("bi_rollup_topn")
def q_h8(spark, d):
    return _ntz(rollups.bi_rollup_topn(finding_docs(spark, d)), "window_start", "window_end")


# --- change data capture ----------------------------------------------------------------

@query("cdc_current_rows")
def q_c1(spark, d):
    return cdc.current_rows(fx.assets_cdc(spark, d))


@query("cdc_flat_event")
def q_c12(spark, d):
    return _ntz(cdc.flat_events(fx.assets_cdc(spark, d)), "event_time")


@query("cdc_latest_state")
def q_j3(spark, d):
    return cdc.latest_state(fx.assets_cdc(spark, d))


@query("cdc_deletes")
def q_c11(spark, d):
    return cdc.deleted_keys(fx.assets_cdc(spark, d))


@query("cdc_snapshot_envelope")
def q_a1(spark, d):
    env = cdc.snapshot_envelope(fx.assets(spark, d), ["tenant_id", "asset_id"], AS_OF)
    return cdc.current_rows(env).withColumn("op", F.lit("r"))


@query("cdc_table_filter")
def q_a9(spark, d):
    mux = cdc.multiplexed_changes(spark, d)
    return cdc.table_filter(cdc.route_topics(mux), ["assets", "asset_cves"])


@query("route_topic")
def q_a10(spark, d):
    mux = cdc.multiplexed_changes(spark, d)
    return cdc.route_topics(mux).groupBy("topic", "table_name").agg(F.count(F.lit(1)).alias("changes"))


@query("cdc_capture_types")
def q_i17(spark, d):
    return _ntz(cdc.capture_types(fx.asset_cves(spark, d)), "discovered_at")


# --- contracts ------------------------------------------------------------------------

@query("check_pk")
def q_n1(spark, d):
    return contracts.check_pk_all(*fx.incoming(spark, d))


@query("check_fk")
def q_n2(spark, d):
    _, n, c = fx.incoming(spark, d)
    return contracts.check_fk_all(fx.assets(spark, d), n, c)


@query("check_not_null")
def q_n3(spark, d):
    return contracts.check_not_null_all(*fx.incoming(spark, d))


@query("check_lengths")
def q_n4(spark, d):
    return contracts.check_lengths_all(*fx.incoming(spark, d))


@query("apply_defaults")
def q_n5(spark, d):
    a, n, _ = fx.incoming(spark, d)
    a = contracts.apply_defaults(a, S.DEFAULTS["assets"])
    n = contracts.apply_defaults(n, S.DEFAULTS["network_interfaces"])
    return a.groupBy(F.lit("assets").alias("table_name"), F.col("risk_level").alias("value"),
                     F.col("is_quarantined").alias("flag")).agg(F.count(F.lit(1)).alias("rows")).unionByName(
        n.groupBy(F.lit("network_interfaces").alias("table_name"), F.lit(None).cast("string").alias("value"),
                  F.col("is_active").alias("flag")).agg(F.count(F.lit(1)).alias("rows")))


@query("cascade_deletes")
def q_n6(spark, d):
    deleted = cdc.deleted_keys(fx.assets_cdc(spark, d))
    return contracts.cascade(fx.network_interfaces(spark, d), deleted)


@query("check_ip")
def q_n7(spark, d):
    return contracts.check_ip(fx.incoming(spark, d)[1])


# --- governance joined with data ---------------------------------------------------------

@query("retention_expired")
def q_m11(spark, d):
    a, n, c = _entities(spark, d)
    changes = fx.assets_cdc_flat(spark, d)
    data = {
        "assets": changes.select(F.timestamp_millis("ts_ms").cast("timestamp_ntz").alias("ts")),
        "network_interfaces": n.select(F.col("last_seen_at").alias("ts")),
        "asset_cves": c.select(F.col("discovered_at").alias("ts")),
        "security_findings": findings_table(spark, d).select(K.parse_event_time(F.col("event_time"))
                                                                 .cast("timestamp_ntz").alias("ts")),
    }
    return governance.retention_expired(governance.metadata_frame(spark), data, AS_OF)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)
