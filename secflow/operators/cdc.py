"""Change-data-capture envelopes: views, flat events, latest state, routing.

Latest state per primary key is a grouped ``max`` over ``struct(ts_ms, seq, ...)``
(partial + final aggregation), so a key with very many versions is combined
map-side instead of being sorted whole inside one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow import schemas as S
from secflow.functions.keys import change_time, to_millis_precision
from secflow.operators.enrich import as_of_literal
from secflow.sources import fixtures as fx

TOPIC_PREFIX = "secflow.public."


def _fields(df: DataFrame, struct_col: str) -> list[str]:
    return [f.name for f in df.schema[struct_col].dataType.fields]


def snapshot_envelope(rows: DataFrame, key_cols: list[str], as_of) -> DataFrame:
    """Wrap a table snapshot as change records with op 'r' (snapshot read)."""
    return rows.select(
        F.struct(*key_cols).alias("key"),
        F.struct(*rows.columns).alias("after"),
        F.lit("r").alias("op"),
        F.unix_millis(as_of_literal(as_of)).alias("ts_ms"),
    )


def current_rows(changes: DataFrame, meta: tuple[str, ...] = ("ts_ms", "seq")) -> DataFrame:
    """The view over a change stream: every live row version (``after.*``)."""
    live = changes.filter(F.col("after").isNotNull() & F.col("op").isin(S.LIVE_OPS))
    extra = [c for c in meta if c in changes.columns]
    return live.select("after.*", *extra)


def flat_events(changes: DataFrame) -> DataFrame:
    """Flat event form: key columns, the other row columns, ``event_type`` (op), ``event_time``."""
    key_fields = _fields(changes, "key")
    other = [f for f in _fields(changes, "after") if f not in key_fields]
    return changes.select(
        *[F.col("key." + k).alias(k) for k in key_fields],
        *[F.col("after." + f).alias(f) for f in other],
        F.col("op").alias("event_type"),
        change_time(F.col("ts_ms")).alias("event_time"),
    )


def _latest(changes: DataFrame, order: tuple[str, ...]) -> DataFrame:
    key_fields = _fields(changes, "key")
    ordered = [c for c in order if c in changes.columns]
    packed = F.struct(*ordered, "op", "after")
    return changes.groupBy(*[F.col("key." + k).alias(k) for k in key_fields]).agg(F.max(packed).alias("_v")), \
        key_fields, ordered


def latest_state(changes: DataFrame, order: tuple[str, ...] = ("ts_ms", "seq")) -> DataFrame:
    """Current table from c/r/u/d changes: newest version per key, deleted keys absent."""
    g, key_fields, ordered = _latest(changes, order)
    other = [f for f in _fields(changes, "after") if f not in key_fields]
    live = g.filter(F.col("_v.op").isin(S.LIVE_OPS) & F.col("_v.after").isNotNull())
    return live.select(*key_fields, *[F.col("_v.after." + f).alias(f) for f in other],
                       *[F.col("_v." + c).alias(c) for c in ordered])


def deleted_keys(changes: DataFrame, order: tuple[str, ...] = ("ts_ms", "seq")) -> DataFrame:
    """Keys whose newest change is a delete."""
    g, key_fields, ordered = _latest(changes, order)
    return g.filter(F.col("_v.op") == "d").select(*key_fields,
                                                  *[F.col("_v." + c).alias(c) for c in ordered])


def apply_changes(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Current table = snapshot with each key's newest change applied.

    Deleted keys disappear; for live keys the columns carried by the change
    image replace the snapshot's, the other columns keep their snapshot value.
    Two aggregations/joins on the key, no window over a key's history.
    """
    latest = latest_state(changes)
    changed = [f for f in _fields(changes, "after") if f not in keys and f in snapshot.columns]
    live = latest.select(*keys, *[F.col(c).alias("_new_" + c) for c in changed], F.lit(True).alias("_hit"))
    cur = snapshot.join(deleted_keys(changes).select(*keys), keys, "left_anti").join(live, keys, "left")
    return cur.select(*[F.when(F.col("_hit"), F.col("_new_" + c)).otherwise(F.col(c)).alias(c) if c in changed
                        else F.col(c) for c in snapshot.columns])


def capture_types(cves: DataFrame) -> DataFrame:
    """Types as captured: DECIMAL(3,1) score delivered as DOUBLE, timestamps at millisecond precision."""
    return cves.select(
        "tenant_id", "cve_record_id",
        F.col("cvss_score").cast("decimal(3,1)").cast("double").alias("cvss_score"),
        to_millis_precision(F.col("discovered_at")).alias("discovered_at"),
    )


def multiplexed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All captured tables on one change stream: topic, key text, op, ts_ms."""
    assets = fx.assets_cdc(spark, sf_dir).select(
        F.lit(TOPIC_PREFIX + "assets").alias("topic"),
        F.concat_ws("|", "key.tenant_id", "key.asset_id").alias("key_text"), "op", "ts_ms")
    ifaces = fx.network_interfaces(spark, sf_dir).select(
        F.lit(TOPIC_PREFIX + "network_interfaces").alias("topic"),
        F.concat_ws("|", "tenant_id", "interface_id").alias("key_text"), F.lit("r").alias("op"),
        fx.event_millis(F.col("last_seen_at")).alias("ts_ms"))
    cves = fx.asset_cves(spark, sf_dir).select(
        F.lit(TOPIC_PREFIX + "asset_cves").alias("topic"),
        F.concat_ws("|", F.col("tenant_id"), F.col("cve_record_id").cast("string")).alias("key_text"),
        F.lit("r").alias("op"), fx.event_millis(F.col("discovered_at")).alias("ts_ms"))
    return assets.unionByName(ifaces).unionByName(cves)


def route_topics(changes: DataFrame) -> DataFrame:
    """Topic router: ``<server>.public.<table>`` -> ``<table>``."""
    return changes.withColumn("table_name", F.regexp_replace("topic", S.ROUTE_PATTERN, S.ROUTE_REPLACEMENT))


def table_filter(changes: DataFrame, include: list[str] = S.INCLUDED_TABLES) -> DataFrame:
    return changes.filter(F.col("table_name").isin(list(include)))
