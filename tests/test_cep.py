"""Burst detection against brute force, with ties, hot keys and tiny blocks."""

import random
from datetime import datetime, timedelta

from secflow.operators.cep import burst


def test_burst_matches_brute_force(spark):
    rnd = random.Random(3)
    base = datetime(2026, 1, 1)
    rows = []
    eid = 0
    for asset, n in (("hot", 900), ("a", 40), ("b", 5)):
        for _ in range(n):
            eid += 1
            minute = rnd.randint(0, 600) if asset == "hot" else rnd.randint(0, 3000)
            rows.append(("t", asset, eid, base + timedelta(minutes=minute)))
    df = spark.createDataFrame(rows, "tenant_id string, asset_id string, activity_id long, activity_time timestamp")
    w_ms, k = 30 * 60_000, 3
    got = {r.activity_id: r.events_in_window
           for r in burst(df, ["tenant_id", "asset_id"], "activity_time", "activity_id", w_ms, k,
                          num_partitions=5, block_rows=16).collect()}
    want = {}
    for (_, a, i, t) in rows:
        c = sum(1 for (_, a2, _, t2) in rows if a2 == a and t - timedelta(milliseconds=w_ms) <= t2 <= t)
        if c >= k:
            want[i] = c
    assert got == want and len(want) > 100
