"""Current state from change streams: latest rows, a join with retractions, signed aggregates, incremental rollups.

Every class here is the body of a ``foreachBatch``: it is called with the micro-batch and its id, keeps its state in
bucketed tables (``sinks.keyed``), reads and rewrites only the buckets that the batch touches, and gives the same result
when a batch is replayed.  Changes may arrive in any order: versions of a key are compared by (ts_ms, seq).

A delta is a table of rows with ``sign``: -1 for a row that is gone, +1 for a row that is new.  An update is both.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow import schemas as S
from secflow.functions import keys as K
from secflow.functions.exact import PARTS, mean, not_nan, split
from secflow.operators import enrich
from secflow.session import materialize, materialized_count, release_materialized
from secflow.sinks.keyed import KeyedTable, hash_bucket

ASSET = ["tenant_id", "asset_id"]
BUCKETS = 64


def _with(schema: T.StructType, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]
                        + [T.StructField(n, t) for n, t in more])


class LatestRows:
    """The newest image of every key of one captured table, deleted keys as tombstones.

    Changes have (key, after, op, ts_ms, seq).  A change that is older than the stored version changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, image: T.StructType, keys: list[str], buckets: int = BUCKETS):
        self.keys, self.image = keys, [f.name for f in image.fields]
        kept = _with(image, ("_op", T.StringType()), ("_ts_ms", T.LongType()), ("_seq", T.LongType()))
        self.table = KeyedTable(spark, path, kept, hash_bucket(keys, buckets))

    def _newest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys and c not in ("_ts_ms", "_seq", "_op")]
        packed = F.max(F.struct("_ts_ms", "_seq", "_op", *rest)).alias("v")
        got = rows.groupBy(*self.keys).agg(packed)
        return got.select(*[F.col(c) if c in self.keys else F.col("v." + c).alias(c) for c in rows.columns])

    def apply(self, changes: DataFrame, batch_id: int) -> None:
        if self.table.published(batch_id):
            return
        image = [F.col("key." + c).alias(c) if c in self.keys else F.col("after." + c).alias(c) for c in self.image]
        come = changes.select(*image, F.col("op").alias("_op"), F.col("ts_ms").alias("_ts_ms"),
                              F.col("seq").cast("long").alias("_seq"))
        come = self._newest(come.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.keys])))
        buckets = self.table.buckets_of(come)
        # Compared with what is stored: one aggregate over the touched buckets, no join.
        self.table.rewrite(batch_id, self._newest(self.table.read(buckets, batch_id).unionByName(come)), buckets)

    def rows(self) -> DataFrame:
        return self.table.read().filter(F.col("_op").isin(S.LIVE_OPS)).select(*self.image)

    def delta(self, batch_id: int) -> DataFrame:
        """Images that the batch removed (sign -1) and brought (+1); rows that it left alone are in neither."""
        buckets = list(self.table._list(batch_id))
        live = F.col("_op").isin(S.LIVE_OPS)
        old = self.table.read(buckets, batch_id).filter(live).select(*self.image, F.lit(-1).alias("sign"))
        new = self.table.read(buckets, batch_id + 1).filter(live).select(*self.image, F.lit(1).alias("sign"))
        return net(old.unionByName(new))


def net(signed: DataFrame) -> DataFrame:
    """Signed rows without those that cancel out, one row per copy that is left."""
    rows = [c for c in signed.columns if c != "sign"]
    left = signed.groupBy(*rows).agg(F.sum("sign").alias("n")).filter("n <> 0")
    return left.withColumn("copy", F.explode(F.sequence(F.lit(1), F.abs("n").cast("int")))).select(
        *rows, F.signum("n").cast("int").alias("sign"))


def apply_delta(table: KeyedTable, delta: DataFrame, batch_id: int) -> list[str]:
    """Bring a table up to date with a delta of its rows; returns the buckets."""
    if table.published(batch_id):
        return list(table._list(batch_id))
    buckets = table.buckets_of(delta)
    names = [f.name for f in table.schema.fields]
    old = table.read(buckets, batch_id).select(*names, F.lit(1).alias("sign"))
    table.rewrite(batch_id, net(old.unionByName(delta.select(*names, "sign"))).drop("sign"), buckets)
    return buckets


class CurrentRule:
    """A rule over the current assets, interfaces and CVEs, kept up to date by deltas.

    ``apply`` takes the micro-batch's changes of the three tables.  Their deltas name the touched assets; the
    rule is evaluated again for those alone, and its rows replace the asset's earlier ones.  The state is the current
    rows, never the history.  ``rule(assets, interfaces, cves)`` must give rows with tenant_id and asset_id.
    """

    def __init__(self, spark: SparkSession, path: str, entities: dict[str, tuple[T.StructType, list[str]]], rule,
                 out: T.StructType, buckets: int = BUCKETS):
        self.spark, self.rule = spark, rule
        self.latest = {n: LatestRows(spark, os.path.join(path, n), image, keys, buckets)
                       for n, (image, keys) in entities.items()}
        by = hash_bucket(ASSET, buckets)
        # The same rows bucketed by asset: an interface that moves leaves one asset's bucket for another's.
        self.by_asset = {n: KeyedTable(spark, os.path.join(path, n + "_by_asset"), image, by)
                         for n, (image, _) in entities.items()}
        self.result = KeyedTable(spark, os.path.join(path, "result"), out, by)

    def apply(self, changes: dict[str, DataFrame], batch_id: int) -> None:
        if self.result.published(batch_id):
            return
        touched = None
        for name, latest in self.latest.items():
            latest.apply(changes[name], batch_id)
            delta = latest.delta(batch_id)
            apply_delta(self.by_asset[name], delta, batch_id)
            keys = delta.select(*ASSET)
            touched = keys if touched is None else touched.unionByName(keys)
        mark = materialized_count()
        touched = materialize(touched.distinct(), "touched")      # read four times below
        buckets = self.result.buckets_of(touched)
        now = [t.read(buckets, batch_id + 1).join(touched, ASSET, "left_semi") for t in self.by_asset.values()]
        names = [f.name for f in self.result.schema.fields]
        rest = self.result.read(buckets, batch_id).join(touched, ASSET, "left_anti")
        self.result.rewrite(batch_id, rest.unionByName(self.rule(*now).select(*names)), buckets)
        release_materialized(self.spark, since=mark)

    def rows(self) -> DataFrame:
        return self.result.read()

    def delta(self, batch_id: int) -> DataFrame:
        """Rows of the rule that the batch retracted (sign -1) and added (+1)."""
        buckets = list(self.result._list(batch_id))
        old = self.result.read(buckets, batch_id).withColumn("sign", F.lit(-1))
        return net(old.unionByName(self.result.read(buckets, batch_id + 1).withColumn("sign", F.lit(1))))


def current_detection_rule(spark: SparkSession, path: str, entities: dict, as_of, buckets: int = BUCKETS) -> CurrentRule:
    """The detection rule on current state."""
    out = T.StructType([T.StructField(c, T.DoubleType() if c in ("cvss_score", "anomaly_score") else T.StringType())
                        for c in S.DOCUMENT_COLUMNS])
    return CurrentRule(spark, path, entities, lambda a, n, c: enrich.detection_rule(a, n, c, as_of), out, buckets)


class SignedAggregates:
    """Counts and averages per group that follow a delta: a row that leaves lowers them.

    ``counts`` maps a name to the condition of the rows that it counts, ``averages`` a name to a column of
    doubles.  Sums are whole numbers (``functions.exact``), so that what was added can be taken away without a trace;
    the averages of values outside that range are as exact as sums of doubles are.  A group without rows disappears.
    """

    def __init__(self, spark: SparkSession, path: str, groups: T.StructType, counts: dict[str, Column],
                 averages: dict[str, str] | None = None, buckets: int = BUCKETS):
        self.groups, self.counts, self.averages = [f.name for f in groups.fields], counts, averages or {}
        sums = [("_rows", T.LongType()), *((n, T.LongType()) for n in counts)]
        for n in self.averages:
            sums += [(f"_{n}_n", T.LongType()), *((f"_{n}_{p}", T.DoubleType() if p == "rest" else T.LongType())
                                                 for p in PARTS)]
        self.sums = [n for n, _ in sums]
        self.table = KeyedTable(spark, path, _with(groups, *sums), hash_bucket(self.groups, buckets))

    def _partial(self, delta: DataFrame) -> DataFrame:
        sign = F.col("sign").cast("long")
        out = {"_rows": sign, **{n: F.when(c, sign).otherwise(0) for n, c in self.counts.items()}}
        for n, col in self.averages.items():
            out[f"_{n}_n"] = F.when(not_nan(F.col(col)).isNotNull(), sign).otherwise(0)
            out.update({f"_{n}_{p}": F.coalesce(c * sign, F.lit(0)) for p, c in split(F.col(col)).items()})
        return delta.groupBy(*self.groups).agg(*[F.sum(c).alias(n) for n, c in out.items()])

    def apply(self, delta: DataFrame, batch_id: int) -> None:
        if self.table.published(batch_id):
            return
        come = self._partial(delta)
        buckets = self.table.buckets_of(come)
        both = self.table.read(buckets, batch_id).unionByName(come)
        merged = both.groupBy(*self.groups).agg(*[F.sum(c).alias(c) for c in self.sums]).filter("_rows <> 0")
        self.table.rewrite(batch_id, merged, buckets)

    def rows(self) -> DataFrame:
        avgs = [mean({p: F.col(f"_{n}_{p}") for p in PARTS}, F.col(f"_{n}_n")).alias(n) for n in self.averages]
        return self.table.read().select(*self.groups, *self.counts, *avgs)


class IncrementalRollup:
    """The BI rollup as mergeable partial aggregates; a refresh reads new findings and rewrites their days.

    ``apply`` takes the findings that arrived since the last refresh (or, with a ``sign`` column, a delta of them).
    """

    KEYS = ["window_start", "window_end", "tenant_id", "severity", "predicted_risk"]

    def __init__(self, spark: SparkSession, path: str, width: str = S.BI_WINDOW):
        self.width = width
        times, texts = (T.StructField(c, T.TimestampType()) for c in self.KEYS[:2]), (
            T.StructField(c, T.StringType()) for c in self.KEYS[2:])
        self.sums = SignedAggregates(spark, path, T.StructType([*times, *texts]), {"findings": F.lit(True)},
                                     {"avg_cvss_score": "cvss_score", "avg_anomaly_score": "anomaly_score"})
        # One bucket per day of the windows: a refresh rewrites the days that it has rows of.
        self.sums.table.bucket = F.date_format("window_start", "yyyyMMdd")

    def apply(self, findings: DataFrame, batch_id: int) -> None:
        ts = K.parse_event_time(F.col("event_time"))
        known = findings.filter(ts.isNotNull()).withColumn("_w", F.window(ts, self.width))
        if "sign" not in findings.columns:
            known = known.withColumn("sign", F.lit(1))
        self.sums.apply(known.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}), batch_id)

    def rows(self) -> DataFrame:
        return self.sums.rows()


def high_risk_assets(spark: SparkSession, path: str, buckets: int = BUCKETS) -> SignedAggregates:
    """Assets at risk HIGH per tenant, from the delta of the assets; ``rows`` has tenants with none, too."""
    return SignedAggregates(spark, path, T.StructType([T.StructField("tenant_id", T.StringType())]),
                            {"high_risk_assets": F.col("risk_level") == "HIGH"}, buckets=buckets)


# --- change streams of several tables in one query -------------------------------------------

CHANGE = ["key", "after", "op", "ts_ms", "seq"]


def tagged(changes: dict[str, DataFrame]) -> DataFrame:
    """Changes of several tables as one stream: ``table_name`` and, under that name, the change."""
    kinds = {n: df.select(F.struct(*CHANGE).alias("c")).schema["c"].dataType for n, df in changes.items()}
    parts = [df.select(F.lit(name).alias("table_name"), *[
        F.struct(*CHANGE).cast(t).alias(n) if n == name else F.lit(None).cast(t).alias(n) for n, t in kinds.items()])
        for name, df in changes.items()]
    return reduce(DataFrame.unionByName, parts)


def split_tags(batch: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    return {n: batch.filter(F.col("table_name") == n).select(n + ".*") for n in names}


def rule_sink(rule: CurrentRule):
    """``foreachBatch`` target: one micro-batch of ``tagged`` changes."""
    return lambda batch, batch_id: rule.apply(split_tags(batch, list(rule.latest)), batch_id)
