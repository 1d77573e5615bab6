"""Keyed stream operators on typed state: rows wait for the watermark in list state, event-time timers release them.

``InOrder`` is the common part.  Rows of a key wait in list state.  A timer at the earliest waiting millisecond fires when
the watermark has passed it; then all rows before the watermark are processed in their order.  Spark drops rows at or
behind the watermark, so nothing that arrives later belongs before them: the results do not depend on the order of
arrival, and equal the batch operator's on the rows that were not late (``late.LateAwareTotals`` keeps such rows).

State is bounded by the rows between the watermark and now plus what the operator needs of the past.  A key without rows for
``idle_ms`` of event time loses its state: in event-time mode this is done with timers, as Spark's TTL counts
processing time.  Rows without an event time are left out.

A key's released rows are one task's work.  For few hot tenants ``pipelines.AnomalyBatchScorer`` spreads a micro-batch.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from secflow.operators.anomaly import AnomalyParams
from secflow.session import ship_package
from secflow.streaming.scorer import score_points

# --- rows in order -------------------------------------------------------------------------


class InOrder(StatefulProcessor):
    """``waiting`` is the schema of a row without the key; its first column is the event time in microseconds."""

    waiting: T.StructType
    out: T.StructType

    def __init__(self, idle_ms: int | None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("waiting", self.waiting)
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("ms", T.LongType())]))
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        """Open the operator's own state."""
        raise NotImplementedError

    def process(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        """Rows in order, each after all rows processed before; returns rows of ``out``."""
        raise NotImplementedError

    def forget(self) -> None:
        """Clear the operator's own state."""
        raise NotImplementedError

    @staticmethod
    def order(row: tuple):
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        names, come = self.waiting.names, []
        for pdf in rows:
            columns = [[None if pd.isna(v) else v for v in pdf[n].astype(object)] for n in names]
            come += zip(*columns, strict=True)
        yield from self._release(key, come, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._release(key, [], timerValues.getCurrentWatermarkInMs())

    def _release(self, key, come: list[tuple], wm: int) -> Iterator[pd.DataFrame]:
        """Process what lies before the watermark's millisecond: rows of equal milliseconds are released together."""
        held = [tuple(r) for r in self.rows.get()]
        known = held + come
        ready = sorted((r for r in known if r[0] // 1000 < wm), key=self.order)
        rest = [r for r in known if r[0] // 1000 >= wm]
        if ready:
            newest = max(r[0] for r in ready) // 1000
            if self.newest.exists():
                newest = max(newest, self.newest.get()[0])
            self.newest.update((newest,))
            made = self.process(key, ready)
            if made:
                yield pd.DataFrame(dict(zip(self.out.names, zip(*made, strict=True), strict=True)), dtype=object)
        if not rest:
            if held:
                self.rows.clear()
        elif ready:
            self.rows.put(rest)
        elif come:
            self.rows.appendList(come)
        if rest:
            self.handle.registerTimer(min(r[0] for r in rest) // 1000 + 1)
        elif self.idle_ms is not None and self.newest.exists():
            end = self.newest.get()[0] + self.idle_ms
            if end <= wm:
                self.newest.clear()
                self.forget()
            else:
                self.handle.registerTimer(end)

    def close(self) -> None:
        pass


def _struct(ddl: str) -> T.StructType:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
             "boolean": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


# --- online anomaly scoring ------------------------------------------------------------------


class AnomalyProcessor(InOrder):
    """State per tenant: the last ``max_training_size + 1`` values of the series, as they are."""

    waiting = _struct("us long, cve_record_id int, interface_id string, cvss_score double")
    out = _struct("tenant_id string, cve_record_id int, interface_id string, us long, cvss_score double, n int, "
                  "forecast double, is_anomaly boolean")

    def __init__(self, params: AnomalyParams, idle_ms: int | None):
        super().__init__(idle_ms)
        self.params = params

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.history = handle.getListState("history", _struct("y double"))

    def forget(self) -> None:
        self.history.clear()

    @staticmethod
    def order(row: tuple):
        us, record, interface, y = row
        # The series order: points without a value last, NULL ids first.
        return y is None, us // 1000, record is not None, record or 0, interface is not None, interface or ""

    def process(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        scored, history = score_points([r[0] for r in self.history.get()], [r[3] for r in rows], self.params)
        if history:
            self.history.put([(y,) for y in history])
        return [(key[0], record, interface, us, y, n, forecast, flag)
                for (us, record, interface, y), (n, forecast, flag) in zip(rows, scored, strict=True)]


def anomaly_state_stream(joined: DataFrame, watermark: str, params: AnomalyParams = AnomalyParams(),
                         idle_ms: int | None = None) -> DataFrame:
    """Online scoring of the joined series; the rows of ``pipelines.anomaly_stream`` in any order of arrival."""
    ship_package(joined.sparkSession)
    at = F.col("discovered_at").cast("timestamp")
    src = joined.filter(at.isNotNull()).select(
        "tenant_id", at.alias("discovered_at"), F.unix_micros(at).alias("us"), F.col("cve_record_id").cast("int"),
        "interface_id", "cvss_score").withWatermark("discovered_at", watermark)
    made = src.groupBy("tenant_id").transformWithStateInPandas(
        AnomalyProcessor(params, idle_ms), AnomalyProcessor.out, "Append", "EventTime")
    return made.select("tenant_id", "cve_record_id", "interface_id", F.timestamp_micros("us").alias("discovered_at"),
                       "cvss_score", "n", "forecast", "is_anomaly")


# --- bursts -----------------------------------------------------------------------------------


class BurstProcessor(InOrder):
    """State per asset: the times of its events inside one window; it goes when event time has passed the window."""

    waiting = _struct("us long, activity_id long")
    out = _struct("tenant_id string, asset_id string, activity_id long, us long, events_in_window long")

    def __init__(self, window_ms: int, min_events: int):
        super().__init__(window_ms + 1)
        self.window_us, self.min_events = window_ms * 1000, min_events

    def open(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", _struct("us long"))

    def forget(self) -> None:
        self.recent.clear()

    @staticmethod
    def order(row: tuple):
        return row[0], row[1] is not None, row[1] or 0

    def process(self, key: tuple, rows: list[tuple]) -> list[tuple]:
        times = sorted([r[0] for r in self.recent.get()] + [r[0] for r in rows])
        kept = times[bisect.bisect_left(times, times[-1] - self.window_us):]
        self.recent.put([(t,) for t in kept])
        out = []
        for us, activity in rows:
            n = bisect.bisect_right(times, us) - bisect.bisect_left(times, us - self.window_us)
            if n >= self.min_events:
                out.append((key[0], key[1], activity, us, n))
        return out


def burst_state_stream(events: DataFrame, window_ms: int, min_events: int, watermark: str) -> DataFrame:
    """Burst alerts per asset; the rows of ``cep.burst`` in any order of arrival within the watermark."""
    ship_package(events.sparkSession)
    at = F.col("activity_time").cast("timestamp")
    src = events.filter(at.isNotNull()).select(
        "tenant_id", "asset_id", F.col("activity_id").cast("long"), at.alias("activity_time"),
        F.unix_micros(at).alias("us")).withWatermark("activity_time", watermark)
    made = src.groupBy("tenant_id", "asset_id").transformWithStateInPandas(
        BurstProcessor(window_ms, min_events), BurstProcessor.out, "Append", "EventTime")
    return made.select("tenant_id", "asset_id", "activity_id", F.timestamp_micros("us").alias("activity_time"),
                       "events_in_window")
