"""Streams that log an error and go on: dead letters of the change stream, retried batches, restarts from the checkpoint.

Three layers, each for what the one before lets through:

* ``split_changes`` takes records apart that do not decode; ``DeadLetters`` keeps them, whole, with topic, partition and offset,
  so that they can be found and replayed.  Tombstones (no value) are skipped.
* ``RetriedSink`` tries a micro-batch's sink again.  A batch that keeps failing is stored under ``batches/batch_id=N``
  for a later replay (``replay``) and the stream goes on with the next one.
* ``supervise`` starts a stream that has ended with an error again, from its checkpoint.

Every failure is one row of the error table (``errors``).  Sinks must be idempotent by batch id, as all of this library's are.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from secflow.sinks.dated import DatedTable

BAD = "_corrupt"
RECORD = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType())])
ERRORS = T.StructType([
    T.StructField("at", T.TimestampType()), T.StructField("stage", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("attempt", T.IntegerType()), T.StructField("error", T.StringType()),
    T.StructField("message", T.StringType())])
# Codes of changes: create, read (snapshot), update, delete.
OPS = ["c", "r", "u", "d"]


def reject_reason(change: Column, corrupt: Column) -> Column:
    """Why a decoded change cannot be used; NULL if it can."""
    return (F.when(change.isNull() | corrupt.isNotNull(), "not JSON of the schema")
            .when(change["key"].isNull(), "no key")
            .when(change["op"].isNull() | ~change["op"].isin(OPS), "unknown op")
            .when((change["op"] != "d") & change["after"].isNull(), "no image"))


def split_changes(records: DataFrame, change: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(changes, rejects) of a topic's raw records; the values are JSON changes (key, after, op, ts_ms, seq).

    A reject is the whole record and its ``reason``.  Works on batches and on streams.
    """
    with_bad = T.StructType(list(change.fields) + [T.StructField(BAD, T.StringType())])
    read = F.from_json(F.col("value").cast("string"), with_bad,
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    parsed = records.filter(F.col("value").isNotNull() & (F.length("value") > 0)).withColumn("_c", read)
    parsed = parsed.withColumn("reason", reject_reason(F.col("_c"), F.col("_c." + BAD)))
    good = parsed.filter(F.col("reason").isNull()).select(*["_c." + f.name for f in change.fields])
    return good, parsed.filter(F.col("reason").isNotNull()).select(*records.columns, "reason")


class DeadLetters:
    """Rejected records by date of arrival; ``sink`` feeds the good changes of a micro-batch on."""

    def __init__(self, spark: SparkSession, path: str, change: T.StructType):
        rows = T.StructType(list(RECORD.fields) + [T.StructField("reason", T.StringType())])
        self.change, self.table = change, DatedTable(spark, path, rows, F.col("timestamp"), keep_undated=True)

    def sink(self, onward: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, batch_id: int) -> None:
            good, bad = split_changes(batch.select(*RECORD.names), self.change)
            self.table.write(bad, batch_id)
            onward(good, batch_id)
        return run

    def rows(self) -> DataFrame:
        return self.table.read()


def record_error(spark: SparkSession, path: str, stage: str, batch_id: int | None, attempt: int,
                 exc: BaseException) -> None:
    row = (datetime.now(timezone.utc), stage, batch_id, attempt, type(exc).__name__, str(exc)[:4000])
    spark.createDataFrame([row], ERRORS).coalesce(1).write.mode("append").parquet(os.path.join(path, "errors"))


def errors(spark: SparkSession, path: str) -> DataFrame:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "errors"))
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], ERRORS)
    return spark.read.schema(ERRORS).parquet(where.toString())


class RetriedSink:
    """``foreachBatch`` target: ``sink`` with up to ``attempts`` tries, then the batch is put aside."""

    def __init__(self, sink: Callable[[DataFrame, int], None], path: str, attempts: int = 3, wait_s: float = 1.0):
        if attempts < 1:
            raise ValueError("attempts must be at least 1")
        self.sink, self.path, self.attempts, self.wait_s = sink, path, attempts, wait_s

    def _aside(self, batch_id: int) -> str:
        return os.path.join(self.path, "batches", f"batch_id={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, self.attempts + 1):
            try:
                self.sink(batch, batch_id)
                return
            except Exception as exc:  # noqa: BLE001 - whatever the sink raises is recorded, and the batch kept
                record_error(batch.sparkSession, self.path, "batch", batch_id, attempt, exc)
                if attempt < self.attempts:
                    time.sleep(self.wait_s * 2 ** (attempt - 1))
        batch.write.mode("overwrite").parquet(self._aside(batch_id))

    def replay(self, spark: SparkSession, batch_id: int) -> None:
        """Run the sink on a batch that was put aside; the batch stays until it went through."""
        path = self._aside(batch_id)
        self.sink(spark.read.parquet(path), batch_id)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class _Progress(StreamingQueryListener):
    """Counts the micro-batches with rows that went through, by query id (the same over restarts)."""

    def __init__(self):
        self.batches: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.batches.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self.batches[str(event.progress.id)] = self.batches.get(str(event.progress.id), 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def supervise(spark: SparkSession, start: Callable[[], StreamingQuery], path: str, max_restarts: int = 5,
              wait_s: float = 1.0) -> int:
    """Run ``start()``'s stream to its end, starting it again from its checkpoint when it ends with an error.

    ``start`` must give the same checkpoint each time.  After ``max_restarts`` restarts in a row without a finished
    micro-batch the error is raised.  Returns the number of restarts.
    """
    progress, total, in_row, seen = _Progress(), 0, 0, 0
    spark.streams.addListener(progress)
    try:
        while True:
            query = start()
            try:
                query.awaitTermination()
                return total
            except StreamingQueryException as exc:
                done = progress.batches.get(str(query.id), 0)
                in_row = 0 if done > seen else in_row
                seen = done
                record_error(spark, path, "query", None, in_row + 1, exc)
                if in_row >= max_restarts:
                    raise
                time.sleep(wait_s * 2 ** min(in_row, 6))
                in_row, total = in_row + 1, total + 1
    finally:
        spark.streams.removeListener(progress)
