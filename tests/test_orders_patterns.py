"""Autoregression of chosen order and the ordered pattern against brute force."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from secflow.operators.anomaly import AnomalyParams, detect
from secflow.operators.autoregressive import OrderParams, detect_order
from secflow.operators.cep import followed_by

BASE = datetime(2026, 1, 1)
ORDER = ["ts", "rid"]


def frame(spark, series):
    rows = [(t, i, v, BASE + timedelta(minutes=i)) for t, values in series.items() for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "tenant_id string, rid int, v double, ts timestamp")


def brute(values, params):
    """Per point: (n, {(p, d): (aic, forecast, rmse)}) from least squares over the training points."""
    base, depth = params.base, params.depth
    y = [v for v in values if v is not None and not math.isnan(v)]
    out = []
    for i in range(len(y)):
        train = [j for j in range(max(depth, i - base.max_training_size), i)]
        n, fits = len(train), {}
        if i >= depth and n >= base.min_training_size:
            for d in range(params.max_d + 1):
                z = np.diff(np.array(y), n=d)        # z[j - d] belongs to y[j]
                for p in range(1, params.max_p + 1):
                    x = np.array([[1.0] + [z[j - d - k] for k in range(1, p + 1)] for j in train])
                    t = np.array([z[j - d] for j in train])
                    if np.linalg.matrix_rank(x, tol=1e-6) <= p:
                        continue
                    b = np.linalg.lstsq(x, t, rcond=None)[0]
                    rss = max(float(((t - x @ b) ** 2).sum()), 0.0)
                    step = b[0] + sum(b[k] * z[i - d - k] for k in range(1, p + 1))
                    ahead = step + (0 if d == 0 else y[i] - (z[i - d] if d else 0))
                    fits[p, d] = (rss * math.exp(2 * (p + 1) / n), ahead, math.sqrt(rss / n))
        out.append((n if i >= depth else 0, fits))
    return out


def hold(got, values, params):
    want = brute(values, params)
    known = [i for i, v in enumerate(values) if v is not None and not math.isnan(v)]
    assert all(got[i].n is None and got[i].is_anomaly is None for i in range(len(values)) if i not in set(known))
    chosen = set()
    for i, (n, fits) in zip(known, want, strict=True):
        g = got[i]
        assert (g.n or 0) == n
        if not fits:
            assert g.forecast is None and g.is_anomaly is None
            continue
        least = min(a for a, _, _ in fits.values())
        assert (g.p, g.d) in fits
        aic, ahead, rmse = fits[g.p, g.d]
        assert aic <= least * (1 + 1e-6) + 1e-6          # the chosen order is the best, but for rounding
        assert g.forecast == pytest.approx(ahead, rel=1e-6, abs=1e-6)
        assert g.rmse == pytest.approx(rmse, rel=1e-4, abs=1e-5)
        band = max(params.base.z * g.rmse, params.base.floor)
        if abs(abs(values[i] - g.forecast) - band) > 1e-6:
            assert g.is_anomaly == (abs(values[i] - g.forecast) > band)
        chosen.add((g.p, g.d))
    return chosen


def second_order(n, rnd):
    y = [5.0, 5.3]
    for _ in range(n):
        y.append(round(1.5 + 1.3 * y[-1] - 0.6 * y[-2] + rnd.gauss(0, 0.3), 1))
    return y


def scores(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.tenant_id, {})[r.rid] = r.anomaly
    return out


@pytest.mark.parametrize("finer", [False, True])
def test_orders_against_least_squares(spark, finer):
    rnd = random.Random(5)
    walk = [0.0]
    for _ in range(180):
        walk.append(round(walk[-1] + rnd.gauss(0.4, 1), 1))
    series = {"two": second_order(200, rnd), "walk": walk, "short": [1.0, 2.0, 1.5], "flat": [3.0] * 30,
              "gaps": [None if i % 7 == 0 else float("nan") if i % 11 == 0 else round(rnd.gauss(5, 1), 1)
                       for i in range(90)]}
    if finer:                                             # no whole numbers: moving frames of doubles
        series = {t: [v if v is None else v + rnd.random() * 1e-3 if t != "flat" else v for v in vs]
                  for t, vs in series.items()}
    params = OrderParams(2, 1, AnomalyParams(max_training_size=30, block_rows=48))
    got = scores(detect_order(frame(spark, series), "v", "tenant_id", ORDER, params, num_partitions=4))
    chosen = {t: hold(got[t], vs, params) for t, vs in series.items()}
    assert (2, 0) in chosen["two"] and any(d == 1 for _, d in chosen["walk"])
    assert all(a.forecast is None for a in got["flat"].values())


def test_third_order_and_second_difference(spark):
    rnd = random.Random(8)
    values = [round(0.05 * i * i + rnd.gauss(0, 1), 1) for i in range(120)]
    params = OrderParams(3, 2, AnomalyParams(max_training_size=40, block_rows=64, min_training_size=12))
    got = scores(detect_order(frame(spark, {"t": values}), "v", "tenant_id", ORDER, params, num_partitions=3))
    assert len(hold(got["t"], values, params)) > 1


def test_order_one_is_the_first_model(spark):
    rnd = random.Random(2)
    df = frame(spark, {"a": second_order(150, rnd), "b": [round(rnd.random() * 9, 1) for _ in range(60)]})
    base = AnomalyParams(max_training_size=20, block_rows=32)
    one = scores(detect_order(df, "v", "tenant_id", ORDER, OrderParams(1, 0, base), num_partitions=4))
    was = scores(detect(df, "v", "tenant_id", ORDER, base, num_partitions=4))
    for t in was:
        for i, w in was[t].items():
            g = one[t][i]
            # The first point has no pair of its own but counts the pairs before it: none.
            assert (g.forecast, g.rmse, g.is_anomaly, g.n) == (w.forecast, w.rmse, w.is_anomaly, w.n)


def test_order_parameters():
    with pytest.raises(ValueError):
        OrderParams(0, 0)
    with pytest.raises(ValueError):
        OrderParams(9, 0)
    with pytest.raises(ValueError):
        OrderParams(2, 1, AnomalyParams(block_rows=102))


def test_empty_series(spark):
    assert detect_order(frame(spark, {"a": [1.0]}).limit(0), "v", "tenant_id", ORDER).count() == 0
    assert detect(frame(spark, {"a": [1.0]}).limit(0), "v", "tenant_id", ORDER).count() == 0


def test_ordered_pattern_against_pairs(spark):
    rnd = random.Random(3)

    def table(n, hot):
        keys = [None if rnd.random() < 0.03 else "hot" if rnd.random() < hot else rnd.choice("abc") for _ in range(n)]
        # Few different times, so that events tie with the start and the end of the span.
        return [(k, i, None if rnd.random() < 0.03 else BASE + timedelta(seconds=rnd.randrange(300)), f"x{i}")
                for i, k in enumerate(keys)]

    first, then = table(150, 0.5), table(200, 0.5)
    first.append(first[3])                                 # a repeated id at another time is a row of its own
    first[-1] = (first[3][0], first[3][1], BASE + timedelta(seconds=150), "again")
    one = spark.createDataFrame(first, "k string, id int, at timestamp, note string")
    two = spark.createDataFrame([(k, 1000 - i, t) for k, i, t, _ in then], "k string, act long, seen timestamp")
    got = followed_by(one, two, ["k"], "at", "id", "seen", "act", 20_000, carry=["note"], num_partitions=3, block_rows=16)
    want = []
    for k, i, t, note in first:
        hits = sorted((u, 1000 - j) for kk, j, u, _ in then
                      if k is not None and t is not None and u is not None and kk == k and t < u <= t + timedelta(seconds=20))
        if hits:
            want.append((k, i, t, note, len(hits), hits[0][1], hits[0][0]))
    rows = [(r.k, r.id, r.at, r.note, r.followers, r.act, r.seen) for r in got.collect()]
    assert want and sorted(rows, key=repr) == sorted(want, key=repr)
    assert followed_by(one.limit(0), two, ["k"], "at", "id", "seen", "act", 20_000).count() == 0
    assert followed_by(one, two.limit(0), ["k"], "at", "id", "seen", "act", 20_000).count() == 0
