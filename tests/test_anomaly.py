"""Anomaly model: edge cases and the blocked distributed form against brute force."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from secflow.operators.anomaly import AnomalyParams, detect, running_stats

BASE = datetime(2026, 1, 1)


def _series(spark, values, tenant="t1", start=0):
    rows = [(tenant, start + i, v, BASE + timedelta(minutes=start + i)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "tenant_id string, rid int, v double, ts timestamp")


def _flags(spark, df, params=AnomalyParams()):
    out = detect(df, "v", "tenant_id", [F.col("ts"), F.col("rid")], params, num_partitions=4)
    return {(r.tenant_id, r.rid): r.anomaly for r in out.collect()}


def brute_force(values, params=AnomalyParams()):
    """Direct refit per point on the previous <= max lag pairs (float least squares)."""
    out = []
    ys = [v for v in values]
    for i in range(len(ys)):
        pairs = [(ys[k - 1], ys[k]) for k in range(max(1, i - params.max_training_size), i)]
        n = len(pairs)
        if ys[i] is None or n < params.min_training_size:
            out.append(None)
            continue
        mx = sum(p[0] for p in pairs) / n
        my = sum(p[1] for p in pairs) / n
        sxx = sum((p[0] - mx) ** 2 for p in pairs)
        if abs(sxx) < 1e-12:
            out.append(None)
            continue
        sxy = sum((p[0] - mx) * (p[1] - my) for p in pairs)
        syy = sum((p[1] - my) ** 2 for p in pairs)
        b = sxy / sxx
        a = my - b * mx
        fc = a + b * ys[i - 1]
        rmse = math.sqrt(max(0.0, syy - b * sxy) / n)
        out.append(abs(ys[i] - fc) > max(params.z * rmse, params.floor))
    return out


def test_min_training_size(spark):
    base = [5.0, 5.2, 5.1, 5.3, 5.0, 5.2, 5.4, 5.1, 5.3, 5.2, 5.1, 5.3]
    for n_pairs, expect in ((9, None), (10, True), (11, True)):
        vals = base[: n_pairs + 1] + [9.9]
        flags = _flags(spark, _series(spark, vals))
        assert flags[("t1", len(vals) - 1)].is_anomaly is expect, n_pairs
        assert flags[("t1", len(vals) - 1)].n == n_pairs


def test_only_last_100_pairs_train(spark):
    vals = [float(3 + (i % 7)) / 1.0 for i in range(150)] + [9.9]
    flags = _flags(spark, _series(spark, vals))
    assert flags[("t1", 150)].n == 100
    assert flags[("t1", 150)].is_anomaly == brute_force(vals)[150]


def test_tenants_are_independent(spark):
    calm = [5.0, 5.1, 5.2, 5.1, 5.0, 5.2, 5.1, 5.0, 5.2, 5.1, 5.0, 5.1, 5.2, 5.1]
    df = _series(spark, calm + [9.9], "A").unionByName(_series(spark, calm + [5.1], "B"))
    flags = _flags(spark, df)
    assert flags[("A", len(calm))].is_anomaly is True
    assert flags[("B", len(calm))].is_anomaly is False


def test_null_values_not_in_series(spark):
    vals = [5.0, 5.1, None, 5.2, 5.1, 5.0, 5.2, 5.1, 5.0, 5.2, 5.1, 5.0, 5.1, 9.9]
    flags = _flags(spark, _series(spark, vals))
    assert flags[("t1", 2)].is_anomaly is None and flags[("t1", 2)].n is None
    expect = brute_force([v for v in vals if v is not None])
    got = [flags[("t1", i)].is_anomaly for i, v in enumerate(vals) if v is not None]
    assert got == expect


@pytest.mark.parametrize("block_rows", [150, 257])
def test_blocks_match_brute_force(spark, block_rows):
    rnd = random.Random(7)
    data = {}
    for t in ("A", "B", "C"):
        vals = []
        for i in range(700 if t != "C" else 90):
            v = round(rnd.uniform(3.0, 10.0) if rnd.random() < 0.1 else 6.0 + rnd.uniform(-0.5, 0.5), 1)
            vals.append(None if rnd.random() < 0.03 else v)
        data[t] = vals
    df = None
    for t, vals in data.items():
        part = _series(spark, vals, t)
        df = part if df is None else df.unionByName(part)
    params = AnomalyParams(block_rows=block_rows)
    flags = _flags(spark, df, params)
    for t, vals in data.items():
        clean = [(i, v) for i, v in enumerate(vals) if v is not None]
        expect = brute_force([v for _, v in clean], params)
        got = [flags[(t, i)].is_anomaly for i, _ in clean]
        assert got == expect, t


def test_running_stats_peers_and_blocks(spark):
    rows = [("t", i, float(i % 5), BASE + timedelta(minutes=i // 3)) for i in range(400)]
    rows.append(("u", 1000, None, BASE))
    df = spark.createDataFrame(rows, "tenant_id string, rid int, v double, ts timestamp")
    out = {r.rid: r for r in running_stats(df, "v", "tenant_id", "ts", ["rid"], block_rows=64,
                                           num_partitions=4).collect()}
    for i in range(400):
        upto = [r for r in rows if r[0] == "t" and r[3] <= rows[i][3]]
        assert out[i].running_count == len(upto)
        assert out[i].running_max == max(r[2] for r in upto)
        assert abs(out[i].running_avg - sum(r[2] for r in upto) / len(upto)) < 1e-12
    assert out[1000].running_count == 0 and out[1000].running_avg is None


def test_params_json(spark):
    row = spark.range(1).select(AnomalyParams().to_json_col().alias("j")).first()
    assert row.j == '{"minTrainingSize":10,"maxTrainingSize":100,"enableStl":false}'
    with pytest.raises(ValueError):
        AnomalyParams(enable_stl=True)


def test_hot_tenant_spread_over_blocks_matches_sequential(spark):
    """One tenant holds almost all rows: it is split over range partitions and blocks,
    and every flag equals the sequential scorer on the whole series."""
    from secflow.streaming.scorer import score_points
    rnd = random.Random(11)
    hot = [round(6.0 + rnd.uniform(-0.6, 0.6), 1) if rnd.random() > 0.05 else round(rnd.uniform(3, 10), 1)
           for _ in range(20000)]
    cold = [round(rnd.uniform(3, 10), 1) for _ in range(50)]
    df = _series(spark, hot, "hot").unionByName(_series(spark, cold, "cold"))
    params = AnomalyParams(block_rows=1000)
    out = detect(df, "v", "tenant_id", [F.col("ts"), F.col("rid")], params, num_partitions=8)
    got = {(r.tenant_id, r.rid): (r.anomaly.n, r.anomaly.is_anomaly) for r in out.collect()}
    for name, vals in (("hot", hot), ("cold", cold)):
        scored, _ = score_points([], vals, params)
        for i, (n, _fc, flag) in enumerate(scored):
            assert got[(name, i)] == (n, flag), (name, i)
