"""Finding records: scoring projection, upsert semantics, documents, retention.

Last-writer-wins per key is a grouped ``max`` over a struct whose leading
fields are the ordering columns.  It is an ordinary aggregate, so Spark runs
it as partial + final (sort-based) aggregation: a hot key collapses to one row
per map task before the shuffle instead of landing whole in one task (which a
``row_number()`` window over the key would do).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.functions import keys as K
from secflow.functions.exact import not_nan
from secflow.functions.scoring import anomaly_flag, anomaly_risk, anomaly_score
from secflow.operators.anomaly import FIELDS, AnomalyParams, detect, detect_runs, tasks_for
from secflow.operators.enrich import JOIN_KEYS, as_of_literal, join_active, join_entities  # noqa: F401
from secflow.session import materialize


def series_order() -> list[Column]:
    """Order of the literal scoring series inside a tenant; ties broken by record ids."""
    return [K.to_millis_precision(F.col("discovered_at")), F.col("cve_record_id"), F.col("interface_id")]


def score(df: DataFrame) -> DataFrame:
    """Finding columns from joined rows carrying an ``anomaly`` struct."""
    flag = anomaly_flag(F.col("anomaly"))
    cvss = F.col("cvss_score")
    return df.select(
        K.finding_key(F.col("tenant_id"), F.col("asset_id"), F.col("cve_id")).alias("key"),
        "tenant_id", "asset_id", "device_type", "ip_address", "cve_id", "cvss_score", "severity",
        anomaly_score(flag, cvss).alias("anomaly_score"),
        F.lit(S.FINDING_TYPE_ML).alias("finding_type"),
        anomaly_risk(flag, cvss).alias("predicted_risk"),
        F.lit(S.MODEL_VERSION_ML).alias("model_version"),
        (F.col("event_time") if "event_time" in df.columns else
         K.event_time_text(F.col("discovered_at")).alias("event_time")),
    )


def cve_series_order() -> list[Column]:
    return [K.to_millis_precision(F.col("discovered_at")), F.col("cve_record_id")]


def score_cves(cves: DataFrame, params: AnomalyParams = AnomalyParams()) -> DataFrame:
    """Anomaly struct per CVE record: the series has one point per record (no interface fan-out)."""
    return detect(cves, "cvss_score", "tenant_id", cve_series_order(), params)


CVE_COLUMNS = ["cve_record_id", "cve_id", "cvss_score", "severity", "discovered_at"]


def scored_series(assets: DataFrame, interfaces: DataFrame, cves: DataFrame,
                  params: AnomalyParams = AnomalyParams(), series: str = "joined",
                  fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """Joined active rows with the anomaly struct.

    ``series="joined"`` (default, literal): one point per joined (interface, CVE) row.
    ``series="cve"``: each CVE record is scored once before the join, so the
    window stage sees the CVE table instead of its interface fan-out.
    ``fields`` are the fields of the struct that the caller reads (joined series).
    """
    if series == "joined":
        return _scored_joined(assets, interfaces, cves, params, fields)
    if series == "cve":
        scored = score_cves(cves, params)
        n = interfaces.filter(F.col("is_active") == F.lit(True))
        return join_entities(assets, n, scored, ["device_type"], ["interface_id", "ip_address"],
                             ["cve_record_id", "cve_id", "cvss_score", "severity", "discovered_at", "anomaly"])
    raise ValueError(f"unknown series {series!r}")


JOINED_PER_TASK = 1 << 18


def _scored_joined(assets: DataFrame, interfaces: DataFrame, cves: DataFrame, params: AnomalyParams,
                   fields: tuple[str, ...]) -> DataFrame:
    """The rows of ``join_active`` with their anomalies, scored before the fan-out.

    A CVE record's joined rows are neighbours in the series (one per active interface, by interface id) with one
    value, so the series is sorted and scored as one row per record with the number of its interfaces.  The join
    comes last and takes from the record's array what belongs to the interface's rank.  Records that share tenant,
    time and id mix by interface id and are put into the series interface by interface.

    Tasks of the join are counted by joined rows; an asset with more than one task's share is dealt to several, with
    its interfaces repeated in each.
    """
    spark = cves.sparkSession
    active = interfaces.filter(F.col("is_active") == F.lit(True)).select(*JOIN_KEYS, "interface_id", "ip_address")
    pairs = assets.select(*JOIN_KEYS, "device_type").join(active, JOIN_KEYS)

    def ranked(rows):
        return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*JOIN_KEYS).orderBy(
            "interface_id", "device_type", "ip_address")) - 1)

    extra = [c for c in ("event_time",) if c in cves.columns]
    records = cves.select(*JOIN_KEYS, *CVE_COLUMNS, *extra).join(
        pairs.groupBy(*JOIN_KEYS).agg(F.count(F.lit(1)).alias("_weight")), JOIN_KEYS)
    records = materialize(records, "scored-records")

    place = {"_p_tenant": F.col("tenant_id"), "_p_null": not_nan(F.col("cvss_score")).isNull(),
             "_p_time": K.to_millis_precision(F.col("discovered_at")), "_p_id": F.col("cve_record_id")}
    shared = records.groupBy(*[c.alias(n) for n, c in place.items()]).agg(F.count(F.lit(1)).alias("_p_n")) \
                    .filter("_p_n > 1").drop("_p_n")
    shared = materialize(shared, "scored-shared")
    sizes = records.groupBy(*JOIN_KEYS).agg(F.sum("_weight").alias("_rows"))
    dealt = materialize(sizes.filter(F.col("_rows") > JOINED_PER_TASK).select(
        *JOIN_KEYS, F.ceil(F.col("_rows") / F.lit(JOINED_PER_TASK)).cast("int").alias("_ways")), "scored-dealt")

    points = records.withColumn("_own_rank", F.lit(None).cast("int")).withColumn(
        "interface_id", F.lit(None).cast("string"))
    if not shared.isEmpty():
        same = [c.eqNullSafe(shared[n]) for n, c in place.items()]
        on = same[0] & same[1] & same[2] & same[3]
        mixed = records.join(shared, on, "left_semi").withColumn("_weight", F.lit(1).cast("long")).join(
            ranked(pairs).select(*JOIN_KEYS, F.col("_rank").alias("_own_rank"), "interface_id"), JOIN_KEYS)
        points = materialize(points.join(shared, on, "left_anti").unionByName(mixed), "scored-points")
    hot = not dealt.isEmpty()
    if hot:
        points = points.join(dealt, JOIN_KEYS, "left").withColumn("_way", F.when(F.col("_ways").isNotNull(), F.pmod(
            F.xxhash64("cve_record_id", "discovered_at"), F.col("_ways"))).otherwise(0).cast("int")).drop("_ways")

    size = points.agg(F.count(F.lit(1)).alias("points"), F.sum("_weight").alias("rows")).first()
    scored = detect_runs(points, "cvss_score", "tenant_id", series_order(), "_weight", size["points"], params, fields)
    tasks = tasks_for(size["rows"] or 0, spark, JOINED_PER_TASK)
    # Both sides are dealt by the columns themselves: ranks, join and what is grouped by asset later share one shuffle.
    keys = [*JOIN_KEYS, "_way"] if hot else JOIN_KEYS
    if hot:
        left = ranked(pairs).join(dealt, JOIN_KEYS, "left").withColumn("_way", F.explode(F.sequence(
            F.lit(0), F.coalesce(F.col("_ways"), F.lit(1)) - 1))).drop("_ways").repartition(tasks, *keys)
    else:
        left = ranked(pairs.repartition(tasks, *keys))
    right = scored.drop("interface_id", "_weight").repartition(tasks, *keys)
    rows = left.join(right, keys).filter(F.col("_own_rank").isNull() | (F.col("_own_rank") == F.col("_rank")))
    place = F.when(F.col("_own_rank").isNull(), F.col("_rank")).otherwise(0)
    return rows.select(*JOIN_KEYS, "device_type", "interface_id", "ip_address", *CVE_COLUMNS, *extra, F.struct(*[
        F.get("_" + f, F.least(place, F.size("_" + f) - 1)).alias(f) for f in fields]).alias("anomaly"))


def ml_scoring(assets: DataFrame, interfaces: DataFrame, cves: DataFrame,
               params: AnomalyParams = AnomalyParams(), series: str = "joined") -> DataFrame:
    if series == "joined":
        # A record's time text is made once, not for each of its interfaces.
        cves = cves.withColumn("event_time", K.event_time_text(F.col("discovered_at")))
    return score(scored_series(assets, interfaces, cves, params, series, ("is_anomaly",)))


def with_key(df: DataFrame) -> DataFrame:
    return df.select(K.finding_key(F.col("tenant_id"), F.col("asset_id"), F.col("cve_id")).alias("key"),
                     *[c for c in S.DOCUMENT_COLUMNS])


def all_findings(rule_rows: DataFrame, ml_rows: DataFrame) -> DataFrame:
    """Rule findings and ML findings in the one sink schema."""
    return with_key(rule_rows).unionByName(ml_rows.select(*S.FINDING_COLUMNS))


# Ordering of versions of one key: newest event (by instant, ``_instant``), then greatest address, then the rest.
UPSERT_ORDER = ["_instant", "ip_address", "device_type", "cvss_score", "severity", "anomaly_score",
                "finding_type", "predicted_risk", "model_version", "event_time"]


def with_instant(findings: DataFrame) -> DataFrame:
    return findings.withColumn("_instant", K.parse_event_time(F.col("event_time")))


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` tuple (NULL lowest)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*order, *rest)).alias("_v")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col("_v." + c).alias(c) for c in order + rest]) \
             .select(*df.columns)


def upsert_latest(findings: DataFrame) -> DataFrame:
    """Current state of the upsert table keyed by ``key`` (NULL keys are rejected by the sink).

    Versions of one event time are compared first, within their asset (no shuffle behind the scoring join); only what
    is left has its time text parsed and is compared across the key.
    """
    same = ["key", "tenant_id", "asset_id", "event_time"]
    order = [c for c in UPSERT_ORDER if c in findings.columns and c not in same]
    known = with_instant(latest_by(findings.filter(F.col("key").isNotNull()), same, order))
    return latest_by(known, ["key"], UPSERT_ORDER).drop("_instant")


def documents(findings: DataFrame, by_asset: bool = True) -> DataFrame:
    """Index documents: normalized event time + deterministic ``_id``, one per id.

    Records whose event time cannot be parsed are skipped, as the consumer does.  A finding's rows on many interfaces
    share the five fields of the id: they become one row before times are parsed and ids hashed.  Different texts of
    one instant, and fields that run together in the id, meet by id.  Without ``by_asset`` an asset's rows are not known
    to lie together (decoded messages): they are grouped by id alone, which is one shuffle.
    """
    same = ["tenant_id", "asset_id", "cve_id", "event_time", "predicted_risk"]
    order = ["ip_address", "device_type", "cvss_score", "severity", "anomaly_score", "finding_type",
             "model_version"]
    docs = findings.select(*S.DOCUMENT_COLUMNS)
    if by_asset:
        docs = latest_by(docs, same, order)
    docs = docs.withColumn("event_time", K.normalize_event_time(F.col("event_time"))) \
        .filter(F.col("event_time").isNotNull())
    docs = docs.withColumn("_id", K.finding_doc_id(F.col("tenant_id"), F.col("asset_id"), F.col("cve_id"),
                                                   F.col("event_time"), F.col("predicted_risk")))
    return latest_by(docs, ["_id"], order).select("_id", *S.DOCUMENT_COLUMNS)


def purge_missing_severity(docs: DataFrame) -> DataFrame:
    """Documents left after deleting those without a severity ('' counts as present)."""
    return docs.filter(F.col("severity").isNotNull())


def conform(df: DataFrame, schema) -> DataFrame:
    """Cast/rename columns to a declared sink schema (missing columns become NULL)."""
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def conform_documents(docs: DataFrame) -> DataFrame:
    """Document columns typed like the index mapping (event_time as a timestamp)."""
    typed = conform(docs, S.FINDING_DOCUMENT)
    return typed.withColumn("event_time", K.parse_event_time(F.col("event_time")))


def retention(findings: DataFrame, as_of, retention_ms: int = S.RETENTION_MS) -> DataFrame:
    """Rows still inside the table's retention period at ``as_of``."""
    ts = K.parse_event_time(F.col("event_time"))
    cutoff = F.timestamp_millis(F.unix_millis(as_of_literal(as_of)) - F.lit(retention_ms))
    return findings.filter(ts >= cutoff)


def last_hours(docs: DataFrame, now, hours: int = 24) -> DataFrame:
    """Dashboard time filter: ``now-<hours>h`` .. ``now`` on the document time."""
    ts = K.parse_event_time(F.col("event_time"))
    end = as_of_literal(now)
    start = F.timestamp_millis(F.unix_millis(end) - F.lit(hours * 3_600_000))
    return docs.filter((ts >= start) & (ts <= end))


def to_json_lines(docs: DataFrame) -> DataFrame:
    """One JSON text per document with keys in sorted order and every key present (console form)."""
    cols = sorted(c for c in docs.columns if c != "_id")
    return docs.select("_id", F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("json"))


def normalize_times(df: DataFrame, col: str = "event_time") -> DataFrame:
    return df.select(col, K.normalize_event_time(F.col(col)).alias("normalized"))
