"""A stream's table partitioned by event date, with retention that drops dates without reading rows.

Layout: ``batch_id=N/event_date=D``.  A micro-batch is written under a staging name and published by one rename, so
readers see all of it or nothing, and a replayed batch is skipped.  ``expire`` deletes the directories of the dates
that lie wholly before the cutoff and marks the cutoff with an empty file ``_expired-D``; rows of those dates that
arrive later are not stored.  Reads from an instant on filter by date (Spark prunes the directories) and by the
instant itself, so what a date kept beyond the cutoff is not seen.
"""

from __future__ import annotations

import os
import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE = "event_date"
_MARK = "_expired-"


class DatedTable:
    """``event_time`` is the instant of a row as a timestamp expression over its columns.

    Rows without an instant are in no retention period: they are dropped, or with ``keep_undated`` stored under the NULL date,
    which no cutoff reaches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, event_time: Column,
                 keep_undated: bool = False):
        self.spark, self.path, self.schema = spark, path, schema
        self.event_time, self.keep_undated = event_time, keep_undated

    def _fs(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def batches(self) -> list[int]:
        return sorted(int(n.split("=", 1)[1]) for n in self._names(self.path) if n.startswith("batch_id="))

    def expired_before(self) -> date | None:
        """Dates before this one are gone."""
        marks = [n[len(_MARK):] for n in self._names(self.path) if n.startswith(_MARK)]
        return date.fromisoformat(max(marks)) if marks else None

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` target."""
        if batch_id in self.batches():
            return
        rows = batch.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(
            DATE, F.to_date(self.event_time))
        first = self.expired_before()
        stored = F.lit(True) if first is None else F.col(DATE) >= F.lit(first)
        rows = rows.filter(F.coalesce(stored, F.lit(True)) if self.keep_undated else stored & F.col(DATE).isNotNull())
        staging = os.path.join(self.path, f"_staging-{batch_id}-{uuid.uuid4().hex}")
        # Adaptive execution joins small dates in a task and splits a large one.
        rows.hint("rebalance", DATE).write.partitionBy(DATE).parquet(staging)
        fs, src = self._fs(staging)
        if batch_id in self.batches():
            fs.delete(src, True)
        elif not fs.rename(src, self._fs(os.path.join(self.path, f"batch_id={batch_id}"))[1]):
            raise OSError(f"batch {batch_id} was not published")

    def expire(self, cutoff) -> list[str]:
        """Drop the dates that end at or before the instant ``cutoff`` (a UTC datetime); returns the directories."""
        first = cutoff.date()
        if (self.expired_before() or date.min) < first:
            fs, mark = self._fs(os.path.join(self.path, _MARK + first.isoformat()))
            fs.create(mark, True).close()
        gone = []
        for b in self.batches():
            batch = os.path.join(self.path, f"batch_id={b}")
            for name in self._names(batch):
                text = name.split("=", 1)[-1]
                if name.startswith(DATE + "=") and text[:1].isdigit() and date.fromisoformat(text) < first:
                    gone.append(os.path.join(batch, name))
        for path in gone:
            fs, where = self._fs(path)
            fs.delete(where, True)
        return gone

    def read(self, since=None, until=None) -> DataFrame:
        """The rows with ``since`` <= instant <= ``until`` (UTC datetimes; without both, every stored row)."""
        schema = T.StructType(list(self.schema.fields) + [T.StructField("batch_id", T.LongType()),
                                                          T.StructField(DATE, T.DateType())])
        # A stored table without a batch is no folder yet; an expired or empty batch is one without dates.
        if not any(n.startswith(DATE + "=") for b in self.batches()
                   for n in self._names(os.path.join(self.path, f"batch_id={b}"))):
            rows = self.spark.createDataFrame([], schema)
        else:
            rows = self.spark.read.schema(schema).parquet(self.path)
        for bound, keep in ((since, lambda c, v: c >= v), (until, lambda c, v: c <= v)):
            if bound is not None:
                rows = rows.filter(keep(F.col(DATE), F.lit(bound.date()))).filter(keep(self.event_time, _instant(bound)))
        return rows.select(*[f.name for f in self.schema.fields])


def _instant(utc) -> Column:
    return F.timestamp_micros(F.lit((utc - utc.replace(1970, 1, 1, 0, 0, 0, 0)) // timedelta(microseconds=1)).cast("long"))
