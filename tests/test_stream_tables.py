"""Dated tables, late rows, supervised streams and bulk documents."""

import json
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.sinks import bulk_documents as bulk
from secflow.sinks.dated import DatedTable
from secflow.streaming import late, supervise

DAY = timedelta(days=1)
BASE = datetime(2026, 1, 1)
EVENTS = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType()),
                       T.StructField("at", T.TimestampType())])


def events(spark, rows):
    return spark.createDataFrame(rows, EVENTS)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_dates_expire_without_being_read(spark, tmp_path):
    path = str(tmp_path / "t")
    table = DatedTable(spark, path, EVENTS, F.col("at"))
    assert table.read().count() == 0 and table.expire(BASE) == []
    rows = [(i, "a", BASE + i * timedelta(hours=9)) for i in range(24)] + [(99, "b", None)]
    table.write(events(spark, rows[::2]), 0)
    table.write(events(spark, rows[1::2]), 1)
    table.write(events(spark, rows), 1)                            # a replayed batch is skipped
    assert ids(table.read()) == list(range(24))
    cutoff = BASE + 4 * DAY + timedelta(hours=5)
    # Files of expired dates are broken: dropping and reading must not open them.
    for d in range(4):
        for b in (0, 1):
            folder = os.path.join(path, f"batch_id={b}", f"event_date=2026-01-0{d + 1}")
            for f in os.listdir(folder) if os.path.isdir(folder) else []:
                if f.endswith(".parquet"):
                    with open(os.path.join(folder, f), "wb") as out:
                        out.write(b"broken")
    kept = [i for i, _, t in rows if t is not None and t >= cutoff]
    plan = table.read(since=cutoff)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert ids(table.read(since=cutoff)) == kept
    gone = table.expire(cutoff)
    assert len(gone) == 8 and not any(os.path.exists(g) for g in gone)
    assert ids(table.read(since=cutoff)) == kept
    assert ids(table.read()) == [i for i, _, t in rows if t is not None and t.date() >= cutoff.date()]
    assert ids(table.read(since=cutoff, until=BASE + 6 * DAY)) == [i for i in kept if rows[i][2] <= BASE + 6 * DAY]
    # What expired does not come back with a later batch.
    table.write(events(spark, [(200, "a", BASE), (201, "a", BASE + 8 * DAY)]), 2)
    assert 200 not in ids(table.read()) and 201 in ids(table.read())


def test_undated_rows_and_broken_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    table = DatedTable(spark, path, EVENTS, F.col("at"), keep_undated=True)
    table.write(events(spark, [(1, "a", None), (2, "a", BASE)]), 0)
    events(spark, [(9, "a", BASE)]).withColumn("event_date", F.to_date("at")).write.partitionBy("event_date").parquet(
        os.path.join(path, "_staging-1-x"))                        # a writer that broke off before publishing
    assert ids(table.read()) == [1, 2]
    table.expire(BASE + 3 * DAY)
    assert ids(table.read()) == [1]
    assert ids(table.read(since=BASE)) == []


def test_every_row_is_in_output_state_or_late_table(spark, tmp_path):
    rnd = random.Random(6)
    totals = late.LateAwareTotals(spark, str(tmp_path / "l"), EVENTS, "at", "10 minutes", 15 * 60_000, ["k"],
                                  {"events": F.lit(True), "odd": F.col("id") % 2 == 1})
    batches = [[(b * 100 + i, rnd.choice("xy"),
                 None if i == 7 else BASE + timedelta(minutes=b * 30 + rnd.randrange(-60, 30))) for i in range(40)]
               for b in range(4)] + [[]]
    wm, windows, lost, seen = None, {}, [], 0
    closed_before = set()
    for b, part in enumerate(batches):
        for i, k, t in part:
            start = None if t is None else t - timedelta(minutes=t.minute % 10)
            if t is None or (wm is not None and start + timedelta(minutes=10) <= wm):
                lost.append((i, late.UNDATED if t is None else late.LATE))
            else:
                n, odd = windows.get((k, start), (0, 0))
                windows[k, start] = (n + 1, odd + i % 2)
        times = [t for _, _, t in part if t is not None]
        totals.apply(events(spark, part), b)
        totals.apply(events(spark, part), b)                       # replayed
        if times:
            wm = max([max(times) - timedelta(minutes=15), *([wm] if wm else [])])
        seen += len(part)
        assert {r.place: r.n for r in late.accounted(totals, "events").collect()}["late"] == len(lost)
        assert sum(r.n for r in late.accounted(totals, "events").collect()) == seen
        got = {}
        for place, df in (("closed", totals.closed()), ("open", totals.open())):
            for r in df.collect():
                assert (r.window_start + timedelta(minutes=10) <= wm) == (place == "closed")
                got[r.k, r.window_start] = (r.events, r.odd)
        assert got == windows
        closed = {(r.k, r.window_start, r.events) for r in totals.closed().collect()}
        assert closed_before <= closed                             # what was closed never changes
        closed_before = closed
    assert sorted((r.id, r.late_reason) for r in totals.late_rows().collect()) == sorted(lost)
    assert {late.LATE, late.UNDATED} == {reason for _, reason in lost}


# --- supervised streams ------------------------------------------------------------------

CHANGE = T.StructType([
    T.StructField("key", T.StructType([T.StructField("id", T.LongType())])),
    T.StructField("after", T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])),
    T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()), T.StructField("seq", T.LongType())])


def record(i, value):
    raw = None if value is None else value if isinstance(value, bytes) else json.dumps(value).encode()
    return (b"k", raw, "assets", i % 3, i, datetime(2026, 1, 1, tzinfo=timezone.utc) + i * timedelta(hours=7))


def change(i, **more):
    return {"key": {"id": i}, "after": {"id": i, "v": "x"}, "op": "u", "ts_ms": i, "seq": i, **more}


def records(spark):
    bad = {3: (b"{not json", "not JSON of the schema"), 4: (b"\xff\x00", "not JSON of the schema"),
           5: (change(5, key=None), "no key"), 6: (change(6, op="z"), "unknown op"), 7: (change(7, after=None), "no image"),
           8: (change(8, ts_ms="soon"), "not JSON of the schema")}
    skipped = {9: None, 10: b""}
    rows = [record(i, bad[i][0] if i in bad else skipped[i] if i in skipped else change(i)) for i in range(14)]
    rows.append(record(14, change(14, op="d", after=None)))
    return spark.createDataFrame(rows, supervise.RECORD), {i: r for i, (_, r) in bad.items()}, [0, 1, 2, 11, 12, 13, 14]


def test_undecodable_changes_become_dead_letters(spark, tmp_path):
    df, bad, fine = records(spark)
    letters = supervise.DeadLetters(spark, str(tmp_path / "dead"), CHANGE)
    seen = []
    sink = letters.sink(lambda good, b: seen.extend(r.key.id for r in good.collect()))
    sink(df, 0)
    sink(df, 0)
    assert sorted(seen) == sorted(fine * 2)
    assert {r.offset: r.reason for r in letters.rows().collect()} == bad
    assert letters.rows().count() == len(bad)                      # replayed, not repeated
    raw = {r.offset: bytes(r.value) for r in letters.rows().collect()}
    assert raw[4] == b"\xff\x00" and raw[3] == b"{not json"
    # A mended record can be read again from its dead letter.
    good, _ = supervise.split_changes(letters.rows().filter("offset = 6").withColumn(
        "value", F.regexp_replace(F.col("value").cast("string"), '"z"', '"u"').cast("binary")), CHANGE)
    assert [r.key.id for r in good.collect()] == [6]


def stream_of(spark, tmp_path, n):
    src = tmp_path / "in"
    for i in range(n):
        events(spark, [(i, "a", BASE)]).coalesce(1).write.mode("append").parquet(str(src))
        files = sorted(src.glob("*.parquet"), key=os.path.getmtime)
        os.utime(files[-1], (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(src))


def test_a_failing_batch_is_retried_recorded_and_put_aside(spark, tmp_path):
    state = {"tries": {}, "done": {}, "broken": True}

    def sink(batch, batch_id):
        state["tries"][batch_id] = state["tries"].get(batch_id, 0) + 1
        if batch_id == 1 and state["tries"][1] == 1:
            raise OSError("the sink is away")                      # passes on the second try
        if batch_id == 2 and state["broken"]:
            raise ValueError("poison")
        state["done"][batch_id] = ids(batch)

    retried = supervise.RetriedSink(sink, str(tmp_path / "sup"), attempts=3, wait_s=0)

    def start():
        return (stream_of_df.writeStream.foreachBatch(retried).option("checkpointLocation", str(tmp_path / "ck"))
                .trigger(availableNow=True).start())

    stream_of_df = stream_of(spark, tmp_path, 4)
    assert supervise.supervise(spark, start, str(tmp_path / "sup"), wait_s=0) == 0
    assert state["done"] == {0: [0], 1: [1], 3: [3]} and state["tries"] == {0: 1, 1: 2, 2: 3, 3: 1}
    log = sorted((r.batch_id, r.attempt, r.error) for r in supervise.errors(spark, str(tmp_path / "sup")).collect())
    assert log == [(1, 1, "OSError"), (2, 1, "ValueError"), (2, 2, "ValueError"), (2, 3, "ValueError")]
    state["broken"] = False
    retried.replay(spark, 2)
    assert state["done"][2] == [2] and not os.path.exists(tmp_path / "sup" / "batches" / "batch_id=2")


def test_a_stream_that_ends_with_an_error_starts_again(spark, tmp_path):
    state = {"fail": {0: 1, 2: 2}, "done": []}

    def sink(batch, batch_id):
        if state["fail"].get(batch_id, 0) > 0:
            state["fail"][batch_id] -= 1
            raise RuntimeError("executor lost")
        state["done"].append((batch_id, ids(batch)))

    df = stream_of(spark, tmp_path, 3)

    def start():
        return (df.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "ck"))
                .trigger(availableNow=True).start())

    assert supervise.supervise(spark, start, str(tmp_path / "sup"), max_restarts=2, wait_s=0) == 3
    assert state["done"] == [(0, [0]), (1, [1]), (2, [2])]
    assert supervise.errors(spark, str(tmp_path / "sup")).count() == 3
    state["fail"] = {3: 9}
    events(spark, [(3, "a", BASE)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="executor lost"):
        supervise.supervise(spark, start, str(tmp_path / "sup"), max_restarts=1, wait_s=0)
    assert supervise.errors(spark, str(tmp_path / "none")).count() == 0


# --- bulk documents ----------------------------------------------------------------------

def docs(spark, n, note="one"):
    return spark.range(n).repartition(4).select(
        F.concat(F.lit("d"), "id").alias("_id"), F.col("id").alias("n"), F.lit(note).alias("note"),
        F.when(F.col("id") % 2 == 0, "line\n{\"index\": \"x\"}").alias("index"))


def test_documents_are_published_once_by_commit_messages(spark, tmp_path):
    path = str(tmp_path / "bulk")
    sink = bulk.bulk_sink(path, "findings")
    assert bulk.manifests(path) == []
    sink(docs(spark, 25), 0)
    sink(docs(spark, 25, "replayed"), 0)
    sink(docs(spark, 3, "later"), 1)
    sink(docs(spark, 0), 2)
    assert [m["documents"] for m in bulk.manifests(path)] == [25, 3, 0]
    got = {r._id: json.loads(r.document) for r in bulk.read_documents(spark, path).collect()}
    assert len(got) == 25 and got["d1"] == {"n": 1, "note": "later"} and got["d9"] == {"n": 9, "note": "one"}
    assert got["d4"]["index"] == "line\n{\"index\": \"x\"}"
    lines = [x for m in bulk.manifests(path) for f in m["files"] for x in open(os.path.join(path, f)).read().splitlines()]
    assert len(lines) == 56 and json.loads(lines[0])["index"]["_index"] == "findings"


def test_a_failing_task_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "bulk")
    bad = docs(spark, 20).withColumn("_id", F.when(F.col("n") != 13, F.col("_id")))
    with pytest.raises(Exception, match="_id"):
        bulk.bulk_sink(path)(bad, 0)
    assert bulk.manifests(path) == [] and bulk.read_documents(spark, path).count() == 0
    assert not [f for f in os.listdir(path) if f.startswith("job-")] if os.path.isdir(path) else True
    bulk.bulk_sink(path)(docs(spark, 20), 0)                       # the batch can be written afterwards
    assert bulk.read_documents(spark, path).count() == 20
    with pytest.raises(Exception, match="_id"):
        docs(spark, 2).drop("_id").write.format(bulk.NAME).mode("append").option("path", path).option("batch", 9).save()
