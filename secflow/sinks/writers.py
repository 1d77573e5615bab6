"""Sinks with the modelled delivery semantics, on plain parquet.

* Upsert (last writer wins per key): merge-on-read log.  Every micro-batch is
  deduplicated by key and written to a staging directory that is renamed to
  ``<path>/batch_id=<n>`` when complete; a retried batch that is already there
  is skipped, so replays are idempotent and readers never list a half-written
  batch.  The current table is ``latest_by`` over the complete batches (partial
  aggregation per key) in the same order as the batch operator, the batch id
  deciding exact ties only.  ``compact`` folds the log into a new snapshot
  directory.  ``merge_into`` does the same on a table format that supports
  ``MERGE INTO``.
* Documents by deterministic id: the same log, keyed by ``_id``; ``write_documents``
  sends them to an index connector, ``_id`` mapped to the document id.
* Full rebuild: each refresh writes a new versioned directory; readers take the
  newest complete one (a ``_SUCCESS`` marker), so they never see an empty table.
* Retention on write: ``write_retained`` filters each micro-batch before it is appended.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.functions.keys import parse_event_time_sql
from secflow.operators.findings import latest_by, retention, with_instant


class UpsertLog:
    """``order`` may name ``_instant``, the event time as an instant (see ``findings.UPSERT_ORDER``)."""

    def __init__(self, path: str, keys: list[str], order: list[str]):
        self.path, self.keys, self.order = path, keys, order

    def _ordered(self, df: DataFrame) -> DataFrame:
        return with_instant(df) if "_instant" in self.order else df

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` target: reject NULL keys, dedupe by key, publish the batch's directory."""
        spark = batch.sparkSession
        out = os.path.join(self.path, f"batch_id={batch_id}")
        if _complete(spark, out):
            return
        known = batch
        for k in self.keys:
            known = known.filter(F.col(k).isNotNull())
        deduped = latest_by(self._ordered(known), self.keys, self.order).select(*batch.columns)
        staging = os.path.join(self.path, f"_staging-{batch_id}-{uuid.uuid4().hex}")
        deduped.write.parquet(staging)
        fs, src, jvm = _hadoop_fs(spark, staging)
        dst = jvm.org.apache.hadoop.fs.Path(out)
        if not _complete(spark, out):
            fs.delete(dst, True)          # left by a writer that broke off
            fs.rename(src, dst)
        else:
            fs.delete(src, True)

    def current(self, spark: SparkSession) -> DataFrame:
        """Current state: the row order decides as in ``upsert_latest``, the newest batch exact ties."""
        done = _complete_children(spark, self.path, "batch_id=")
        if not done:
            raise FileNotFoundError(f"no complete batch under {self.path}")
        log = spark.read.option("basePath", self.path).parquet(*done)
        cols = [c for c in log.columns if c != "batch_id"]
        latest = latest_by(self._ordered(log), self.keys, self.order + ["batch_id"])
        return latest.select(*cols)

    def compact(self, spark: SparkSession, batch_id: int, new_path: str) -> "UpsertLog":
        """Fold the log into a new log at ``new_path`` holding one snapshot as ``batch_id``;
        writers continue on the returned log with ids above ``batch_id``."""
        self.current(spark).write.mode("overwrite").parquet(os.path.join(new_path, f"batch_id={batch_id}"))
        return UpsertLog(new_path, self.keys, self.order)


def merge_sql(table: str, source: str, keys: list[str], columns: list[str]) -> str:
    """MERGE statement of one deduplicated batch (view ``source``) into ``table``: an event of an earlier instant
    never replaces a later one, whatever the form and offset of their texts.  ``table`` must be in a format that
    supports MERGE."""
    new, old = parse_event_time_sql("s.event_time"), parse_event_time_sql("t.event_time")
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"t.{c} = s.{c}" for c in columns if c not in keys)
    return (f"MERGE INTO {table} t USING {source} s ON {on} "
            f"WHEN MATCHED AND ({old} IS NULL OR {new} >= {old}) THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({', '.join('s.' + c for c in columns)})")


def merge_into(batch: DataFrame, table: str, keys: list[str], order: list[str]) -> None:
    """``foreachBatch`` body for a table format with MERGE (needs its jars)."""
    deduped = latest_by(with_instant(batch) if "_instant" in order else batch, keys, order).select(*batch.columns)
    view = f"merge_{uuid.uuid4().hex}"
    deduped.createOrReplaceTempView(view)
    batch.sparkSession.sql(merge_sql(table, view, keys, batch.columns))


def write_documents(docs: DataFrame, connector: str, resource: str, options: dict[str, str] | None = None) -> None:
    """Send documents to an index connector (a Spark data source), ``_id`` as the document id."""
    writer = docs.write.format(connector).mode("append").option("es.mapping.id", "_id").option(
        "es.mapping.exclude", "_id")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(resource)


def write_retained(batch: DataFrame, path: str, batch_id: int, as_of, retention_ms: int) -> None:
    """``foreachBatch`` body of a stream table with retention: only rows still retained are written."""
    retention(batch, as_of, retention_ms).write.mode("overwrite").parquet(
        os.path.join(path, f"batch_id={batch_id}"))


def write_full_rebuild(df: DataFrame, path: str, version: int) -> str:
    """Write a complete new version of a rebuilt table; returns its directory."""
    out = os.path.join(path, f"v={version:012d}")
    df.write.mode("overwrite").parquet(out)
    return out


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def _complete(spark: SparkSession, path: str) -> bool:
    fs, root, jvm = _hadoop_fs(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(root, "_SUCCESS"))


def _complete_children(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Sorted subdirectories with a ``_SUCCESS`` marker (Hadoop FileSystem API: any shared storage)."""
    fs, root, jvm = _hadoop_fs(spark, path)
    done = []
    if fs.exists(root):
        for st in fs.listStatus(root):
            p = st.getPath()
            if st.isDirectory() and p.getName().startswith(prefix) and \
                    fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
                done.append(p.toString())
    return sorted(done)


def read_latest_version(spark: SparkSession, path: str) -> DataFrame:
    """Newest version directory that has a ``_SUCCESS`` marker."""
    done = _complete_children(spark, path, "v=")
    if not done:
        raise FileNotFoundError(f"no complete version under {path}")
    return spark.read.parquet(done[-1])


def count_written(df: DataFrame) -> DataFrame:
    """Bulk-write report without driver iteration: one row with the document count."""
    return df.agg(F.count(F.lit(1)).alias("indexed_documents"))
