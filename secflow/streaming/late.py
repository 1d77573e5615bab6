"""Windowed totals on a stream with a side output of late rows.

Spark drops rows behind the watermark without a trace.  ``LateAwareTotals`` is the body of a ``foreachBatch`` that
compares each row with the batch's watermark itself: the newest event time of the batches before, less the allowed
delay, as Spark's own.  A row whose window has ended by then is late and goes to the late table, as do rows without an
event time; every other row is in the totals of its window.  So every input row is in a closed window (the output), in an
open one (the state) or in the late table, and a closed window never changes.

A replayed batch meets the watermark that it met before and changes nothing.  A micro-batch reads and rewrites the
days of its windows only; the watermark is one row.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.sinks.dated import DatedTable
from secflow.sinks.keyed import KeyedTable
from secflow.streaming.current import SignedAggregates

LATE, UNDATED = "late", "no event time"


class LateAwareTotals:
    """``counts`` and ``averages`` per ``groups`` and window of ``width``, as in ``SignedAggregates``.

    ``rows`` is the schema of the input; ``time_col`` is its event time.
    """

    def __init__(self, spark: SparkSession, path: str, rows: T.StructType, time_col: str, width: str, delay_ms: int,
                 groups: list[str], counts: dict[str, Column], averages: dict[str, str] | None = None):
        self.spark, self.time_col, self.width, self.delay_us = spark, time_col, width, delay_ms * 1000
        times = [T.StructField(c, T.TimestampType()) for c in ("window_start", "window_end")]
        keys = T.StructType(times + [T.StructField(g, rows[g].dataType) for g in groups])
        self.totals = SignedAggregates(spark, os.path.join(path, "totals"), keys, counts, averages)
        self.totals.table.bucket = F.date_format("window_start", "yyyyMMdd")
        late = T.StructType(list(rows.fields) + [T.StructField("late_reason", T.StringType()),
                                                 T.StructField("watermark_us", T.LongType())])
        self.late = DatedTable(spark, os.path.join(path, "late"), late, self._time(), keep_undated=True)
        mark = T.StructType([T.StructField("watermark_us", T.LongType())])
        self.marks = KeyedTable(spark, os.path.join(path, "watermark"), mark, F.lit("all"))

    def _time(self) -> Column:
        return F.col(self.time_col).cast("timestamp")

    def watermark_us(self, before: int | None = None) -> int | None:
        """The watermark that batch ``before`` meets (the newest one by default); one row."""
        found = self.marks.read(before=before).agg(F.max("watermark_us")).first()
        return found[0] if found else None

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        if self.marks.published(batch_id):
            return
        batch = batch.persist()                  # read for the late rows, the totals and the watermark
        try:
            self._take(batch, batch_id, self.watermark_us(batch_id))
        finally:
            batch.unpersist()

    def _take(self, batch: DataFrame, batch_id: int, wm: int | None) -> None:
        w = F.window(self._time(), self.width)
        known = batch.filter(self._time().isNotNull()).withColumn("_w", w)
        ended = F.lit(False) if wm is None else F.unix_micros(F.col("_w.end")) <= F.lit(wm)
        note = [F.lit(wm).cast("long").alias("watermark_us")]
        late = known.filter(ended).select(*batch.columns, F.lit(LATE).alias("late_reason"), *note)
        undated = batch.filter(self._time().isNull()).select(*batch.columns, F.lit(UNDATED).alias("late_reason"), *note)
        self.late.write(late.unionByName(undated), batch_id)
        on_time = known.filter(~ended).withColumns({
            "window_start": F.col("_w.start"), "window_end": F.col("_w.end"), "sign": F.lit(1)})
        self.totals.apply(on_time, batch_id)
        newest = batch.agg((F.max(F.unix_micros(self._time())) - F.lit(self.delay_us)).alias("watermark_us"))
        newest = newest.select(F.greatest(F.col("watermark_us"), F.lit(wm).cast("long")).alias("watermark_us"))
        # Last, as its publication says that the batch is done.
        self.marks.rewrite(batch_id, newest.filter("watermark_us IS NOT NULL"), ["all"])

    def _windows(self, closed: bool) -> DataFrame:
        wm, rows = self.watermark_us(), self.totals.rows()
        if wm is None:
            return rows.limit(0) if closed else rows
        done = F.unix_micros("window_end") <= F.lit(wm)
        return rows.filter(done if closed else ~done)

    def closed(self) -> DataFrame:
        """Windows that have ended by the watermark: final."""
        return self._windows(True)

    def open(self) -> DataFrame:
        """Windows that can still take rows."""
        return self._windows(False)

    def late_rows(self) -> DataFrame:
        return self.late.read()


def in_batches(rows: DataFrame, batch: Column, n: int) -> list[DataFrame]:
    """The rows of each micro-batch, for replays of stored rows in an order of arrival."""
    return [rows.filter(batch == b) for b in range(n)]


def accounted(totals: LateAwareTotals, count: str) -> DataFrame:
    """How many input rows are where: one row per place (closed, open, late)."""
    parts = [totals.closed().agg(F.sum(count).alias("n")).select(F.lit("closed").alias("place"), "n"),
             totals.open().agg(F.sum(count).alias("n")).select(F.lit("open").alias("place"), "n"),
             totals.late_rows().agg(F.count(F.lit(1)).alias("n")).select(F.lit("late").alias("place"), "n")]
    return reduce(DataFrame.unionByName, parts).select("place", F.coalesce("n", F.lit(0)).alias("n"))
