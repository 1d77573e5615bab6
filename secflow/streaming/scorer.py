"""The anomaly model on one series, point by point: what the streaming form keeps state for."""

from __future__ import annotations

import numpy as np

from secflow.operators.anomaly import MAX_DECIMALS, AnomalyParams


def window_scale(values: np.ndarray, least: int) -> int | None:
    """The power of ten that makes a window's values whole numbers without loss, as the batch operator has for a table."""
    scale = 1
    while scale <= 10 ** MAX_DECIMALS:
        if scale >= least and np.array_equal(np.round(values * scale) / scale, values):
            return scale if np.abs(values).max(initial=0.0) * scale <= float(1 << 24) else None
        scale *= 10
    return None


def score_points(history: list[float], ys: list[float | None], p: AnomalyParams):
    """Score points in order given the previous series values.

    The batch operator's model: exact whole-number sums where the window's values have at most four decimals, sums of
    doubles otherwise; no value is rounded.  Returns (n, forecast, is_anomaly) per point and the new history tail.
    """
    out, hist = [], list(history)
    for y in ys:
        if y is None:
            out.append((None, None, None))
            continue
        n = max(0, min(len(hist) - 1, p.max_training_size))
        res = (n, None, None)
        if n >= p.min_training_size:
            res = (n, *_fit(np.array(hist[-n - 1:], dtype=np.float64), y, p))
        out.append(res)
        hist.append(y)
        hist = hist[-(p.max_training_size + 1):]
    return out, hist


def _fit(series: np.ndarray, y: float, p) -> tuple[float | None, bool | None]:
    scale = window_scale(np.append(series, y), p.scale)
    n = len(series) - 1
    v = np.round(series * scale).astype(np.int64) if scale else series
    last, now = (int(v[-1]), round(y * scale)) if scale else (float(v[-1]), y)
    x, z = v[:-1], v[1:]
    sx, sy, sum_xx = x.sum().item(), z.sum().item(), (x * x).sum().item()
    sxx, sxy = n * sum_xx - sx * sx, n * (x * z).sum().item() - sx * sy
    syy = n * (z * z).sum().item() - sy * sy
    if not (sxx != 0 if scale else sxx > 1e-12 * n * sum_xx):
        return None, None
    unit = float(scale or 1)
    slope = float(sxy) / float(sxx)
    forecast = (float(sy) - slope * float(sx)) / float(n) + slope * float(last)
    rss = max(float(syy) - slope * float(sxy), 0.0)
    band = max(p.z * (np.sqrt(rss) / float(n) / unit), p.floor)
    return forecast / unit, bool(abs(float(now) - forecast) / unit > band)
