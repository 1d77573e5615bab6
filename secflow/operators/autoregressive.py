"""Anomaly detection by autoregression of any order, the order chosen for every point.

Model.  For each order (p, d) with 1 <= p <= ``max_p`` and 0 <= d <= ``max_d`` the d times differenced series is
regressed on its p previous values and an intercept, by least squares over the points before the one to judge: those
of the last ``max_training_size`` that have ``max_p + max_d`` predecessors, the same points for every order, so
that the fits compare.  The order with the least AIC, ``n ln(rss / n) + 2 (p + 1)``, makes the forecast; ties go to the smaller p, then the
smaller d.  Flags and bands are those of ``operators.anomaly``; with ``max_p = 1`` and ``max_d = 0`` so are all results.

Scale.  The layout is that of ``operators.anomaly`` (global positions, blocks of the total order, each with the
rows before it that its first rows look back on), so no task holds a tenant.  The normal equations of all orders come
from one set of sliding sums, differences of prefix sums: a row costs O(1) of the training size.  Orders of one d share an
elimination, since without exchanges its first p steps are those of the p-th order's equations.

Defined cases: NULL and NaN are not part of the series and get n = NULL; a point with fewer than
``min_training_size`` training points, or for which no order's equations have full rank, gets no forecast.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import comb

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from secflow.functions.exact import not_nan
from secflow.operators.anomaly import AnomalyParams, exact_scale, global_positions, observed, scale_metrics

RANK = 1e-9          # a pivot below this share of its own moment counts as zero
_EXACT = float(1 << 62)


@dataclass(frozen=True)
class OrderParams:
    max_p: int = 2
    max_d: int = 1
    base: AnomalyParams = field(default_factory=AnomalyParams)

    def __post_init__(self):
        if self.max_p < 1 or self.max_d < 0:
            raise ValueError("need max_p >= 1 and max_d >= 0")
        if self.base.min_training_size <= self.max_p + 1:
            raise ValueError("min_training_size must exceed max_p + 1")
        if self.base.block_rows <= self.base.max_training_size + self.depth:
            raise ValueError("block_rows must exceed max_training_size + max_p + max_d")

    @property
    def depth(self) -> int:
        """How many values before a point its equations take."""
        return self.max_p + self.max_d


def difference(values: list[Column], d: int, lag: int) -> Column:
    """The d-th difference at ``lag`` steps back, from the values at 0, 1, ... steps back."""
    out = values[lag]
    for j in range(1, d + 1):
        term = values[lag + j] * F.lit(comb(d, j))
        out = out - term if j % 2 else out + term
    return out


def _whole_numbers(found: dict, params: OrderParams) -> int | None:
    """The factor that makes the values whole numbers whose sums of products stay within 64 bits, or None."""
    scale = exact_scale(found, params.base.scale)
    if scale is None:
        return None
    most = ((found["top"] or 0.0) * scale * 2 ** params.max_d) ** 2
    rows = max(params.base.max_training_size ** 2, params.base.block_rows + params.base.max_training_size + params.depth)
    return scale if 2 * most * rows < _EXACT else None


def detect_order(df: DataFrame, value: str, partition: str, order: list[Column],
                 params: OrderParams = OrderParams(), num_partitions: int | None = None,
                 out: str = "anomaly") -> DataFrame:
    """Append struct ``out`` = (n, p, d, forecast, lower, upper, rmse, is_anomaly) to every row.

    ``order`` orders rows inside ``partition`` and, with it, must identify a row.
    """
    base, spark = params.base, df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    span, block, depth = base.max_training_size, base.block_rows, params.depth
    clean = not_nan(F.col(value))
    seen = Observation()
    pos = global_positions(df.observe(seen, *scale_metrics(clean)), [F.col(partition), clean.isNull(), *order],
                           num_partitions)
    scale = _whole_numbers(observed(seen, pos), params)

    # The rows that a block's first rows look back on are the last span + depth of the block before.
    last = (F.col("_g") % F.lit(block)) >= F.lit(block - span - depth)
    own = F.floor(F.col("_g") / F.lit(block)).cast("bigint")
    blocks = pos.withColumn("_own", own).withColumn(
        "_blk", F.explode(F.when(last, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
    w = Window.partitionBy(partition, "_blk").orderBy("_g")
    kind = "bigint" if scale else "double"
    y = F.round(clean * F.lit(scale)).cast("bigint") if scale else clean
    stage = blocks.select("*", y.alias("_y0"))
    stage = stage.select("*", *[F.lag("_y0", k).over(w).alias(f"_y{k}") for k in range(1, depth + 1)])

    values = [F.col(f"_y{k}") for k in range(depth + 1)]
    whole = values[0].isNotNull()
    for v in values[1:]:
        whole = whole & v.isNotNull()
    lags, degrees = range(params.max_p + 1), range(params.max_d + 1)
    z = {(d, a): difference(values, d, a) for d in degrees for a in lags}
    terms = {"n": F.lit(1).cast(kind)}
    for d in degrees:
        terms.update({f"{d}_{a}": z[d, a] for a in lags})
        terms.update({f"{d}_{a}_{b}": z[d, a] * z[d, b] for a in lags for b in lags if a <= b})
    stage = stage.select("*", *[F.when(whole, t).otherwise(F.lit(0).cast(kind)).alias("_k_" + k)
                                for k, t in terms.items()])
    if scale:
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        stage = stage.select("*", *[F.sum("_k_" + k).over(upto).alias("_c_" + k) for k in terms])
        sums = [F.col("_c_" + k) - F.col("_k_" + k) - F.lag("_c_" + k, span + 1, 0).over(w) for k in terms]
    else:
        before = w.rowsBetween(-span, -1)
        sums = [F.coalesce(F.sum("_k_" + k).over(before), F.lit(0.0)) for k in terms]
    kept = [c for c in stage.columns if not c.startswith(("_k_", "_c_"))]
    stage = stage.select(*kept, *[s.alias("_s_" + k) for s, k in zip(sums, terms, strict=True)])

    # Moments about the mean, times n * n: whole numbers until here where the values allow it.
    n = F.col("_s_n")
    stage = stage.select("*", *[
        (n * F.col(f"_s_{d}_{a}_{b}") - F.col(f"_s_{d}_{a}") * F.col(f"_s_{d}_{b}")).cast("double").alias(f"_m_{d}_{a}_{b}")
        for d in degrees for a in lags for b in lags if a <= b])
    known = whole & (n >= base.min_training_size)
    fits = []
    for d in degrees:
        stage = _eliminate(stage, d, params.max_p)
        for p in range(1, params.max_p + 1):
            stage, fit = _solve(stage, d, p, z, values, known)
            fits.append(fit)
    # With one n for all orders, n ln(rss / n) + 2 (p + 1) orders them as rss exp(2 (p + 1) / n) does.
    stage = stage.withColumn("_best", F.array_min(F.array(*fits)))
    best, unit = F.col("_best"), F.lit(float(scale or 1))
    stage = stage.withColumn("_fc", best["forecast"] / unit).withColumn(
        "_rmse", F.try_divide(F.sqrt(best["rss"]), n.cast("double")) / unit)
    band = F.greatest(F.lit(base.z) * F.col("_rmse"), F.lit(base.floor))
    resid = F.abs(F.col("_y0").cast("double") - best["forecast"]) / unit
    result = F.struct(
        F.when(F.col("_y0").isNotNull(), n.cast("int")).alias("n"), best["p"].alias("p"), best["d"].alias("d"),
        F.col("_fc").alias("forecast"), (F.col("_fc") - band).alias("lower"), (F.col("_fc") + band).alias("upper"),
        F.when(best.isNotNull(), F.col("_rmse")).alias("rmse"),
        F.when(best.isNotNull(), resid > band).alias("is_anomaly"))
    return stage.filter(F.col("_blk") == F.col("_own")).select(*df.columns, result.alias(out))


def _eliminate(stage: DataFrame, d: int, max_p: int) -> DataFrame:
    """Columns ``_a_d_i_j`` (i <= j) and ``_r_d_i``: the equations of order max_p in triangular form."""
    a = {(i, j): F.col(f"_m_{d}_{i}_{j}") for i in range(1, max_p + 1) for j in range(i, max_p + 1)}
    r = {i: F.col(f"_m_{d}_0_{i}") for i in range(1, max_p + 1)}
    for k in range(1, max_p + 1):
        new = {f"_a_{d}_{k}_{j}": a[k, j] for j in range(k, max_p + 1)}
        new[f"_r_{d}_{k}"] = r[k]
        stage = stage.withColumns(new)
        row = {j: F.col(f"_a_{d}_{k}_{j}") for j in range(k, max_p + 1)}
        for i in range(k + 1, max_p + 1):
            # A zero pivot leaves NULL behind; such an order is not fitted.
            stage = stage.withColumn(f"_f_{d}_{k}_{i}", F.try_divide(row[i], row[k]))
            f = F.col(f"_f_{d}_{k}_{i}")
            for j in range(i, max_p + 1):
                a[i, j] = a[i, j] - f * row[j]
            r[i] = r[i] - f * F.col(f"_r_{d}_{k}")
    return stage


def _solve(stage: DataFrame, d: int, p: int, z, values: list[Column], known: Column) -> tuple[DataFrame, Column]:
    """Back substitution for order (p, d); the fit as a struct that sorts by AIC, NULL without one."""
    coef: dict[int, Column] = {}
    ranked = known
    for k in range(p, 0, -1):
        rest = F.col(f"_r_{d}_{k}")
        for j in range(p, k, -1):
            rest = rest - F.col(f"_a_{d}_{k}_{j}") * coef[j]
        name = f"_b_{d}_{p}_{k}"
        stage = stage.withColumn(name, F.try_divide(rest, F.col(f"_a_{d}_{k}_{k}")))
        coef[k] = F.col(name)
        moment = F.col(f"_m_{d}_{k}_{k}")
        # Doubles: a spread below their precision is no spread.
        spread = F.lit(1e-12) * (F.col("_s_n") * F.col(f"_s_{d}_{k}_{k}")).cast("double")
        ranked = ranked & (F.col(f"_a_{d}_{k}_{k}") > F.lit(RANK) * moment) & (moment > spread)
    n = F.col("_s_n").cast("double")
    level, rss, step = F.col(f"_s_{d}_0").cast("double"), F.col(f"_m_{d}_0_0"), F.lit(0.0)
    for k in range(1, p + 1):
        level = level - coef[k] * F.col(f"_s_{d}_{k}").cast("double")
        rss = rss - coef[k] * F.col(f"_m_{d}_0_{k}")
    step = F.try_divide(level, n)
    for k in range(1, p + 1):
        step = step + coef[k] * z[d, k].cast("double")
    rss = F.greatest(rss, F.lit(0.0))
    # From the forecast of the difference to that of the value: the rest of the difference is known.
    ahead = step - (difference(values, d, 0) - values[0]).cast("double")
    name = f"_fit_{d}_{p}"
    stage = stage.withColumn(name, F.when(ranked, F.struct(
        (rss * F.exp(F.try_divide(F.lit(2.0 * (p + 1)), n))).alias("aic"), F.lit(p).alias("p"), F.lit(d).alias("d"),
        ahead.alias("forecast"), rss.alias("rss"))))
    return stage, F.col(name)
