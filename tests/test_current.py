"""Current-state forms after every micro-batch against the batch operators on all changes so far."""

import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.operators import cdc, enrich, rollups
from secflow.sinks.keyed import KeyedTable, hash_bucket
from secflow.streaming import current
from secflow.streaming import pipelines as P

KINDS = {"string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def ddl(text):
    return T.StructType([T.StructField(n, KINDS[k]) for n, k in (c.split() for c in text.split(", "))])


AS_OF = "2026-01-05 00:00:00"
ASSET = ddl("tenant_id string, asset_id string, device_type string, risk_level string")
IFACE = ddl(
    "tenant_id string, interface_id string, asset_id string, ip_address string, is_active boolean")
CVE = ddl(
    "tenant_id string, cve_record_id int, asset_id string, cve_id string, cvss_score double, severity string")
ENTITIES = {"assets": (ASSET, ["tenant_id", "asset_id"]), "interfaces": (IFACE, ["tenant_id", "interface_id"]),
            "cves": (CVE, ["tenant_id", "cve_record_id"])}


def make_changes(n, seed):
    """Changes of the three tables in shuffled order, with deletes, moves and repeated versions."""
    rnd = random.Random(seed)
    out = {k: [] for k in ENTITIES}
    for seq in range(n):
        name = rnd.choice(list(out))
        t = rnd.choice("ab")
        asset = str(rnd.randrange(6))
        if name == "assets":
            key, row = (t, asset), (t, asset, "router", rnd.choice(["HIGH", "HIGH", "LOW", None]))
        elif name == "interfaces":
            i = str(rnd.randrange(8))
            key, row = (t, i), (t, i, asset, f"10.0.0.{seq % 7}", rnd.random() < 0.8)
        else:
            i = rnd.randrange(10)
            key, row = (t, i), (t, i, asset, f"CVE-{i}", rnd.choice([9.1, 9.8, 5.0, None]),
                                rnd.choice(["CRITICAL", "CRITICAL", "LOW"]))
        gone = rnd.random() < 0.15
        out[name].append((key, None if gone else row, "d" if gone else rnd.choice("cru"), 1000 + seq // 3, seq))
    for rows in out.values():
        rnd.shuffle(rows)
    return out


def frames(spark, changes):
    out = {}
    for name, (image, keys) in ENTITIES.items():
        key = T.StructType([image[k] for k in keys])
        schema = T.StructType([T.StructField("key", key), T.StructField("after", image),
                               T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType()),
                               T.StructField("seq", T.LongType())])
        out[name] = spark.createDataFrame(changes[name], schema)
    return out


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def batch_rule(spark, changes):
    cur = [cdc.latest_state(df).drop("ts_ms", "seq") for df in frames(spark, changes).values()]
    return enrich.detection_rule(*cur, as_of=AS_OF)


def parts(changes, k):
    """Batches of consecutive changes, every fifth change one batch late."""
    out = [{n: [] for n in changes} for _ in range(k)]
    for n, r in changes.items():
        for c in r:
            out[min(k - 1, c[4] * k // 160 + (c[4] % 5 == 0))][n].append(c)
    return out


def test_rule_and_aggregate_follow_every_batch(spark, tmp_path):
    changes = make_changes(160, 4)
    rule = current.current_detection_rule(spark, str(tmp_path / "rule"), ENTITIES, AS_OF, buckets=4)
    risk = current.high_risk_assets(spark, str(tmp_path / "risk"), buckets=2)
    so_far, seen, rises_and_falls = {n: [] for n in ENTITIES}, None, set()
    for b, part in enumerate(parts(changes, 3)):
        so_far = {n: so_far[n] + part[n] for n in ENTITIES}
        batch = frames(spark, part)
        rule.apply(batch, b)
        delta = rule.latest["assets"].delta(b)
        risk.apply(delta, b)
        want = batch_rule(spark, so_far)
        assert rows(rule.rows()) == rows(want)
        high = rollups.high_risk_assets(cdc.latest_state(frames(spark, so_far)["assets"]))
        assert rows(risk.rows().filter("high_risk_assets > 0")) == rows(high)
        # The retractions and additions lead from the earlier result to this one.
        signed = rule.delta(b)
        before = seen if seen is not None else want.limit(0)
        moved = current.net(before.withColumn("sign", F.lit(1)).unionByName(signed))
        assert rows(moved.drop("sign")) == rows(want)
        rises_and_falls |= {r.sign for r in signed.select("sign").distinct().collect()}
        seen = spark.createDataFrame(want.collect(), want.schema)
        # Replaying a batch changes nothing.
        rule.apply(batch, b)
        risk.apply(delta, b)
        assert rows(rule.rows()) == rows(want)
    assert rises_and_falls == {-1, 1}


def test_rule_on_a_stream_of_three_tables(spark, tmp_path):
    changes = make_changes(120, 9)
    dirs = {}
    for n, df in frames(spark, changes).items():
        dirs[n] = (str(tmp_path / n), df.schema)
        df.repartition(3).write.parquet(dirs[n][0])
    streams = {n: P.file_changes(spark, d, s, 1) for n, (d, s) in dirs.items()}
    rule = current.current_detection_rule(spark, str(tmp_path / "rule"), ENTITIES, AS_OF, buckets=3)
    P.run_available(current.tagged(streams), f"current_{uuid.uuid4().hex}", "append", sink=current.rule_sink(rule))
    assert rows(rule.rows()) == rows(batch_rule(spark, changes))


def findings(spark, n, seed):
    rnd = random.Random(seed)
    start = datetime(2026, 1, 1)
    data = [(rnd.choice(["a", "b", None]), rnd.choice(["HIGH", "LOW", None]), rnd.choice(["CRITICAL", None]),
             rnd.choice([7.3, 9.9, None, 1e14, 0.1]), rnd.choice([0.99, 0.73]),
             rnd.choice([(start + timedelta(minutes=rnd.randrange(5000))).strftime("%Y-%m-%d %H:%M:%S.000"), "junk"]))
            for _ in range(n)]
    return spark.createDataFrame(data, "tenant_id string, severity string, predicted_risk string, cvss_score double, "
                                       "anomaly_score double, event_time string")


def test_rollup_refresh_equals_full_rebuild_and_leaves_other_days(spark, tmp_path):
    roll = current.IncrementalRollup(spark, str(tmp_path / "bi"))
    batches = [findings(spark, 150, s) for s in range(3)]
    everything = None
    for b, batch in enumerate(batches):
        roll.apply(batch, b)
        roll.apply(batch, b)
        everything = batch if everything is None else everything.unionByName(batch)
        assert rows(roll.rows()) == rows(rollups.bi_rollup(everything))
    one_day = batches[0].filter("event_time LIKE '2026-01-02%'")
    roll.apply(one_day, 3)
    assert list(roll.sums.table._list(3)) == ["20260102"]
    assert {k: v for k, v in roll.sums.table.versions().items() if v == 3} == {"20260102": 3}
    # Taken away again, the day is as before.
    roll.apply(one_day.withColumn("sign", F.lit(-1)), 4)
    assert rows(roll.rows()) == rows(rollups.bi_rollup(everything))


def test_keyed_table_reads_its_buckets_only_and_survives_a_crash(spark, tmp_path):
    schema = ddl("k int, v string")
    table = KeyedTable(spark, str(tmp_path / "t"), schema, hash_bucket(["k"], 8))
    first = spark.createDataFrame([(i, "old") for i in range(40)], schema)
    assert table.read().count() == 0
    table.rewrite(0, first, table.buckets_of(first))
    come = spark.createDataFrame([(3, "new")], schema)
    buckets = table.buckets_of(come)
    assert len(buckets) == 1
    others = [f for f in table.read().inputFiles() if f"_bucket={buckets[0]}/" not in f]
    kept = table.read(buckets, 1).filter("k <> 3").unionByName(come)
    # A writer that broke off between staging and publishing is not seen.
    table.stage(1, kept, buckets)
    assert table.read().filter("v = 'new'").count() == 0 and not table.published(1)
    table.rewrite(1, kept, buckets)
    assert sorted(r.v for r in table.read().filter("k = 3").collect()) == ["new"] and table.read().count() == 40
    assert set(others) <= set(table.read().inputFiles())
    assert table.read(buckets, 1).filter("v = 'new'").count() == 0
    # A late second writer of the batch changes nothing, an emptied bucket stays empty, vacuum keeps the rows.
    table.publish(1, table.stage(1, come.limit(0), buckets))
    table.rewrite(2, come.limit(0), buckets)
    left = rows(table.read())
    assert table.read(buckets).count() == 0 and 0 < len(left) < 40
    table.stage(3, come, buckets)
    gone = table.vacuum(3)
    assert any("_staging-3" in g for g in gone) and any(g.endswith("batch_id=1") for g in gone)
    assert rows(table.read()) == left
    with pytest.raises(ValueError, match="outside"):
        table.stage(4, first, buckets)
