"""Online autoregressive anomaly detection over a per-tenant time series.

Model (ours; the modelled pipeline fixes only "ARIMA, train on 10..100 points,
no seasonal decomposition, causal"): AR(1) with intercept, refitted for every
point by least squares on the previous <= ``max_training_size`` lag pairs
(the point itself is not trained on).  A point is anomalous when at least
``min_training_size`` pairs exist and ``|y - forecast| > max(z * rmse, floor)``.
Points with fewer pairs, or whose training x values are constant, get
``is_anomaly = NULL``.  NULL values are not part of the series.

Scale.  A window partitioned by tenant puts a whole tenant in one task, and
tenants are few and hot.  Instead:

1. Range-partition the rows on the total order (tenant, value-is-null, time,
   tie-breaks) into ``num_partitions`` pieces and sort within each piece.
2. Give every row a global position: position inside its piece plus the row
   count of all earlier pieces (a table with one row per piece, so its size is
   bounded by ``num_partitions`` and it is safe to broadcast).
3. Cut the global order into fixed blocks of ``block_rows`` rows.  Each block
   also receives the ``max_training_size + 1`` rows that precede it, as
   context.  Windows then run per (tenant, block): no task ever holds more
   than ``block_rows + max_training_size + 1`` rows, whatever the tenant size.
4. Inside a block, the sliding sums over the previous pairs come from exact
   integer prefix sums when all values have at most ``MAX_DECIMALS`` decimals
   (scaled to integers without loss, e.g. CVSS tenths): each row costs O(1)
   instead of O(window) and there is no cancellation error.  A series with
   finer values takes a moving frame of doubles instead; nothing is rounded.
   NaN counts as NULL.

A series whose neighbours repeat (one CVE record on many interfaces) goes through ``detect_runs``: the same model,
positions and blocks over one row per run; a run's neighbours exist only inside the task that scores them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow import schemas as S
from secflow.functions.exact import PARTS, mean, not_nan, split
from secflow.session import materialize, ship_package

_POS_BITS = 33  # monotonically_increasing_id(): partition id in the upper bits, row index in the lower 33


@dataclass(frozen=True)
class AnomalyParams:
    min_training_size: int = S.ANOMALY_MIN_TRAINING
    max_training_size: int = S.ANOMALY_MAX_TRAINING
    enable_stl: bool = False
    z: float = 2.5758          # two-sided 99 % band
    floor: float = 1e-6        # residual band floor (float noise on exactly linear data)
    scale: int = 10            # least factor that makes the values integers (one decimal)
    block_rows: int = 8192

    def __post_init__(self):
        if not (0 < self.min_training_size <= self.max_training_size):
            raise ValueError("need 0 < min_training_size <= max_training_size")
        if self.enable_stl:
            raise ValueError("seasonal decomposition is not supported")
        if self.block_rows <= self.max_training_size + 1:
            raise ValueError("block_rows must exceed max_training_size + 1")

    def to_json_col(self) -> Column:
        """Parameter document, as ``JSON_OBJECT('minTrainingSize' VALUE …, …)``."""
        return F.to_json(F.struct(
            F.lit(self.min_training_size).alias("minTrainingSize"),
            F.lit(self.max_training_size).alias("maxTrainingSize"),
            F.lit(self.enable_stl).alias("enableStl"),
        ))


def range_index(df: DataFrame, order: list[Column], num_partitions: int, name: str) -> DataFrame:
    """Range-partition on ``order``, sort, tag rows with (``_pid``, ``_local``) and materialize.

    The range bounds come from sampling (seeded per exchange instance), so the
    tagged rows are written once as a parquet table in the shared checkpoint
    folder; every later branch reads the same rows, and a lost executor
    re-reads files instead of re-sampling.  ``order`` must be a total order.

    Sampling reads its input once more than the shuffle.  An input that joins or aggregates is therefore written
    first and sampled from the file.
    """
    if re.search("Join|Aggregate|Window|Exchange", df._jdf.queryExecution().optimizedPlan().toString()):
        df = materialize(df, name + "-input")
    ranged = df.repartitionByRange(num_partitions, *order).sortWithinPartitions(*order)
    return materialize(ranged.select(
        "*",
        F.spark_partition_id().cast("bigint").alias("_pid"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_local"),
    ), name)


def global_positions(df: DataFrame, order: list[Column], num_partitions: int) -> DataFrame:
    """Add ``_g``: the 0-based position of each row in the total order ``order``.

    Distributed zip-with-index: position inside the range partition plus the
    row count of earlier partitions, from a table with one row per partition
    (broadcast; its size is bounded by ``num_partitions``).
    """
    indexed = range_index(df, order, num_partitions, "positions")
    counts = indexed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # A partition's row index has ``_POS_BITS`` bits; more rows must fail, not wrap.
    counts = counts.withColumn("_n", F.when(F.col("_n") < F.lit(1 << _POS_BITS), F.col("_n")).otherwise(
        F.raise_error(F.lit("range partition too large: raise num_partitions")).cast("bigint")))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_n")).alias("_offset"),
    )
    return (indexed.join(F.broadcast(offsets), "_pid")
            .withColumn("_g", F.col("_offset") + F.col("_local"))
            .drop("_pid", "_local", "_offset"))


MAX_DECIMALS = 4
_INT_LIMIT = float(1 << 24)     # squares of scaled values then sum within 64 bits over a block


def scale_metrics(value: Column) -> list[Column]:
    """What ``exact_scale`` decides on, as aggregates."""
    need = F.lit(None).cast("long")
    for d in range(MAX_DECIMALS, -1, -1):
        f = F.lit(float(10 ** d))
        need = F.when(F.round(value * f) / f == value, F.lit(10 ** d).cast("long")).otherwise(need)
    return [F.max(need).alias("scale"), F.max(F.abs(value)).alias("top"),
            F.count(F.when(value.isNotNull() & need.isNull(), 1)).alias("finer")]


def exact_scale(found: dict, least: int = 1) -> int | None:
    """The power of ten (at least ``least``) that makes every value a small integer without loss, or None."""
    scale = max(least, found["scale"] or 1)
    return scale if not found["finer"] and (found["top"] or 0.0) * scale <= _INT_LIMIT else None


def observed(seen: Observation, written: DataFrame) -> dict:
    """The metrics observed while ``written`` was made; of no rows where the optimizer dropped an empty input with its
    observation."""
    try:
        return seen.get
    except Exception:  # noqa: BLE001 - raised again unless there was nothing to observe
        if not written.isEmpty():
            raise
        return {"scale": None, "top": None, "finer": 0}


def detect(df: DataFrame, value: str, partition: str, order: list[Column],
           params: AnomalyParams = AnomalyParams(), num_partitions: int | None = None,
           out: str = "anomaly") -> DataFrame:
    """Append struct ``out`` = (n, forecast, lower, upper, rmse, is_anomaly) to every row.

    ``order`` orders rows inside ``partition`` and, with it, must identify a row.
    """
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    span = params.max_training_size
    block = params.block_rows

    clean = not_nan(F.col(value))
    full_order = [F.col(partition), clean.isNull()] + list(order)
    # Observed while the positions are written: no pass of its own.
    seen = Observation()
    pos = global_positions(df.observe(seen, *scale_metrics(clean)), full_order, num_partitions)
    scale = exact_scale(observed(seen, pos), params.scale)

    # Each row belongs to its block; the last span+1 rows of a block are also context for the next.
    own = F.floor(F.col("_g") / F.lit(block)).cast("bigint")
    tail = (F.col("_g") % F.lit(block)) >= F.lit(block - span - 1)
    blocks = pos.withColumn("_own", own).withColumn(
        "_blk", F.explode(F.when(tail, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))))

    w = Window.partitionBy(partition, "_blk").orderBy("_g")
    kind = "bigint" if scale else "double"
    y = F.round(clean * F.lit(scale)).cast("bigint") if scale else clean
    # Three window passes over one sort: lag, running sums, sliding differences.
    stage = blocks.select("*", y.alias("_y")).select("*", F.lag("_y", 1).over(w).alias("_x"))
    has = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    zero = F.lit(0).cast(kind)
    contrib = {
        "n": F.when(has, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint")),
        "x": F.when(has, F.col("_x")).otherwise(zero),
        "y": F.when(has, F.col("_y")).otherwise(zero),
        "xx": F.when(has, F.col("_x") * F.col("_x")).otherwise(zero),
        "xy": F.when(has, F.col("_x") * F.col("_y")).otherwise(zero),
        "yy": F.when(has, F.col("_y") * F.col("_y")).otherwise(zero),
    }
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Sum over the previous ``span`` rows = C(i-1) - C(i-span-1), with C(i-1) = C(i) - c(i).
    stage = stage.select("*", *[e.alias("_k_" + k) for k, e in contrib.items()])
    if scale:
        stage = stage.select("*", *[F.sum("_k_" + k).over(cum).alias("_c_" + k) for k in contrib])
        stage = stage.select("*", *[(F.col("_c_" + k) - F.col("_k_" + k)
                                     - F.lag("_c_" + k, span + 1, 0).over(w)).alias("_w_" + k) for k in contrib])
    else:
        frame = w.rowsBetween(-span, -1)
        stage = stage.select("*", *[F.coalesce(F.sum("_k_" + k).over(frame), F.lit(0).cast(
            "bigint" if k == "n" else kind)).alias("_w_" + k) for k in contrib])

    n, sx, sy = F.col("_w_n"), F.col("_w_x"), F.col("_w_y")
    sxx = n * F.col("_w_xx") - sx * sx
    sxy = n * F.col("_w_xy") - sx * sy
    syy = n * F.col("_w_yy") - sy * sy
    # Doubles: a spread below their precision is no spread.
    spread = (sxx != 0) if scale else (sxx > F.lit(1e-12) * n * F.col("_w_xx"))
    fit = (n >= params.min_training_size) & spread & F.col("_y").isNotNull()
    # try_divide: NULL instead of an ANSI error where a row has no fit (its value is discarded anyway).
    slope = F.try_divide(sxy.cast("double"), sxx.cast("double"))
    intercept = F.try_divide(sy.cast("double") - slope * sx.cast("double"), n.cast("double"))
    forecast_t = intercept + slope * F.col("_x").cast("double")
    rss = F.greatest(syy.cast("double") - slope * sxy.cast("double"), F.lit(0.0))
    scale = F.lit(float(scale or 1))
    stage = stage.withColumn("_fc", F.when(fit, forecast_t / scale)).withColumn(
        "_rmse", F.when(fit, F.try_divide(F.sqrt(rss), n.cast("double")) / scale))
    band = F.greatest(F.lit(params.z) * F.col("_rmse"), F.lit(params.floor))
    resid = F.abs(F.col("_y").cast("double") - forecast_t) / scale
    result = F.struct(
        F.when(F.col("_y").isNotNull(), n.cast("int")).alias("n"),
        F.col("_fc").alias("forecast"),
        (F.col("_fc") - band).alias("lower"),
        (F.col("_fc") + band).alias("upper"),
        F.col("_rmse").alias("rmse"),
        F.when(fit, resid > band).alias("is_anomaly"),
    )
    keep = [c for c in df.columns]
    return stage.filter(F.col("_blk") == F.col("_own")).select(*keep, result.alias(out))


FIELDS = {"n": "int", "forecast": "double", "lower": "double", "upper": "double", "rmse": "double",
          "is_anomaly": "boolean"}
_ARROW = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
POINTS_PER_TASK = 1 << 18


def tasks_for(rows: int, spark, per_task: int = POINTS_PER_TASK) -> int:
    """Shuffle partitions so that none gets much more than ``per_task`` rows; few for small inputs."""
    least = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // 16384))
    return max(1, least, -(-rows // per_task))


def detect_runs(df: DataFrame, value: str, partition: str, order: list[Column], weight: str, points: int,
                params: AnomalyParams = AnomalyParams(), fields: tuple[str, ...] = tuple(FIELDS)) -> DataFrame:
    """``detect`` on a series whose rows stand for ``weight`` equal neighbours each.

    Appends one array column ``_<field>`` per requested field: entry i belongs to neighbour i, and the last entry to
    all later ones.  An array has at most ``max_training_size + 2`` entries, since from there on a neighbour sees
    nothing but its own run.  ``points`` is the number of rows of ``df``.
    """
    spark = df.sparkSession
    span, block, tasks = params.max_training_size, params.block_rows, tasks_for(points, df.sparkSession)
    clean = not_nan(F.col(value))
    seen = Observation()
    pos = global_positions(df.observe(seen, *scale_metrics(clean)), [F.col(partition), clean.isNull()] + list(order),
                           tasks)
    scale = exact_scale(observed(seen, pos), params.scale)
    own = F.floor(F.col("_g") / F.lit(block)).cast("bigint")
    # A row stands for at least one neighbour: so many rows before a block hold its context.
    tail = (F.col("_g") % F.lit(block)) >= F.lit(block - span - 1)
    y = F.round(clean * F.lit(scale)).cast("bigint") if scale else clean
    blocks = pos.withColumn("_own", own).withColumn("_y", y).withColumn(
        "_blk", F.explode(F.when(tail, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))))
    sorted_ = blocks.repartition(tasks, "_blk").sortWithinPartitions("_blk", "_g").drop("_g")
    ship_package(spark)
    schema = T.StructType(list(df.schema.fields) + [T.StructField("_" + f, T.ArrayType(
        T.IntegerType() if FIELDS[f] == "int" else T.DoubleType() if FIELDS[f] == "double" else T.BooleanType()))
        for f in fields])
    return sorted_.mapInArrow(_score_runs(list(df.columns), partition, weight, scale, params, fields), schema)


def _score_runs(columns: list[str], partition: str, weight: str, scale: int | None, params: AnomalyParams,
                fields: tuple[str, ...]):
    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            blk = held.column("_blk").to_numpy()
            done = int(np.searchsorted(blk, blk[-1])) if len(blk) else 0    # the last block may go on
            if done:
                yield from scored(held.slice(0, done))
                held = held.slice(done)
        if held is not None and held.num_rows:
            yield from scored(held)

    def scored(t: pa.Table):
        blk = t.column("_blk").to_numpy()
        mine = blk == t.column("_own").to_numpy()
        code = t.column(partition).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        start = np.ones(len(blk), dtype=bool)
        start[1:] = (blk[1:] != blk[:-1]) | (code[1:] != code[:-1])
        y, known = t.column("_y"), t.column("_y").is_valid().to_numpy()
        size, found = run_scores(y.fill_null(0).to_numpy(), known, start, t.column(weight).to_numpy(), scale, params)
        keep = np.repeat(mine, size)
        offsets = pa.array(np.concatenate([[0], np.cumsum(size[mine])]).astype(np.int32))
        rows = t.select(columns).filter(pa.array(mine))
        for f in fields:
            values, valid = found[f]
            rows = rows.append_column("_" + f, pa.ListArray.from_arrays(
                offsets, pa.array(values[keep], type=_ARROW[FIELDS[f]], mask=~valid[keep])))
        yield from rows.combine_chunks().to_batches()
    return run


def run_scores(y: np.ndarray, known: np.ndarray, start: np.ndarray, weight: np.ndarray, scale: int | None,
               params: AnomalyParams) -> tuple[np.ndarray, dict[str, tuple[np.ndarray, np.ndarray]]]:
    """Entries per row and, by field, (values, valid) of all entries.  ``start`` marks the first row of a series."""
    span = params.max_training_size
    size = np.where(known, np.minimum(weight, span + 2), 1).astype(np.int64)
    of = np.repeat(np.arange(len(y)), size)
    at = np.arange(len(of))
    first_row = np.cumsum(size) - size
    begin = np.zeros(len(of), dtype=bool)
    begin[first_row[start]] = True
    first = np.maximum.accumulate(np.where(begin, at, 0))     # the first entry of one's series
    v, ok = y[of], known[of]
    x = np.concatenate([v[:1], v[:-1]])
    has = ok & np.concatenate([ok[:1], ok[:-1]]) & ~begin
    v0, x0 = np.where(has, v, 0), np.where(has, x, 0)
    parts = {"n": has.astype(np.int64), "x": x0, "y": v0, "xx": x0 * x0, "xy": x0 * v0, "yy": v0 * v0}
    lo = np.maximum(at - span, first)
    w = {}
    for k, c in parts.items():
        if c.dtype == np.int64:
            # Sums may wrap; their differences over a window are right.
            total = np.concatenate([[0], np.cumsum(c)])
            w[k] = total[at] - total[lo]
        else:
            # A moving frame of doubles, oldest first.
            w[k] = np.zeros(len(c))
            for back in range(span, 0, -1):
                w[k][back:] += np.where(at[back:] - back >= first[back:], c[:len(c) - back], 0.0)
    n = w["n"]
    sxx, sxy, syy = (n * w[a + b] - w[a] * w[b] for a, b in ("xx", "xy", "yy"))
    spread = (sxx != 0) if scale else (sxx > 1e-12 * n * w["xx"])
    fit = (n >= params.min_training_size) & spread & ok
    factor = float(scale or 1)
    with np.errstate(all="ignore"):
        nd = n.astype(np.float64)
        slope = sxy.astype(np.float64) / sxx.astype(np.float64)
        intercept = (w["y"].astype(np.float64) - slope * w["x"].astype(np.float64)) / nd
        ahead = intercept + slope * x.astype(np.float64)
        rss = np.maximum(syy.astype(np.float64) - slope * sxy.astype(np.float64), 0.0)
        forecast, rmse = ahead / factor, np.sqrt(rss) / nd / factor
        band = np.maximum(params.z * rmse, params.floor)
        far = np.abs(v.astype(np.float64) - ahead) / factor > band
    return size, {"n": (n, ok), "forecast": (forecast, fit), "lower": (forecast - band, fit),
                  "upper": (forecast + band, fit), "rmse": (rmse, fit), "is_anomaly": (far, fit)}


def global_prefix_count(df: DataFrame, order: list[Column], flag: Column, num_partitions: int,
                        block_rows: int = 8192) -> DataFrame:
    """Add ``_before``: how many rows with ``flag`` true precede each row in the total order.

    Same layout as ``global_positions``; the count is the sum of three bounded
    parts: flagged rows in earlier range partitions (one row per partition,
    broadcast), in earlier blocks of the same partition (a window over the
    per-block totals of one partition) and earlier in the row's own block (a
    window over at most ``block_rows`` rows).
    """
    indexed = range_index(df.withColumn("_f", flag.cast("long")), order, num_partitions, "prefix")
    indexed = indexed.withColumn("_blk", F.floor(F.col("_local") / F.lit(block_rows)).cast("bigint"))
    earlier = Window.unboundedPreceding, -1
    per_part = indexed.groupBy("_pid").agg(F.sum("_f").alias("_pf")).select(
        "_pid", F.coalesce(F.sum("_pf").over(Window.orderBy("_pid").rowsBetween(*earlier)), F.lit(0))
        .alias("_pre_p"))
    per_blk = indexed.groupBy("_pid", "_blk").agg(F.sum("_f").alias("_bf")).select(
        "_pid", "_blk", F.coalesce(F.sum("_bf").over(
            Window.partitionBy("_pid").orderBy("_blk").rowsBetween(*earlier)), F.lit(0)).alias("_pre_b"))
    w = Window.partitionBy("_pid", "_blk").orderBy("_local").rowsBetween(*earlier)
    rows = indexed.join(per_blk, ["_pid", "_blk"]).join(F.broadcast(per_part), "_pid")
    return rows.withColumn("_before", F.col("_pre_p") + F.col("_pre_b") + F.coalesce(F.sum("_f").over(w), F.lit(0))) \
               .drop("_pid", "_local", "_blk", "_f", "_pre_p", "_pre_b")


def running_stats(df: DataFrame, value: str, partition: str, order: str, tie_breaks: list[str],
                  block_rows: int = 8192, num_partitions: int | None = None) -> DataFrame:
    """Running count / avg / max of ``value`` per ``partition`` ordered by ``order``.

    Frame: RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW, so rows with equal
    ``order`` values (peers) share one result.  Distributed form, every piece
    bounded: rows are range-partitioned on the total order; a row's running
    values combine (1) the key's rows in earlier range partitions (a table with
    at most one row per partition and key, prefixed per key over <=
    ``num_partitions`` rows), (2) earlier blocks of its own partition (prefixed
    per partition and key), (3) earlier rows of its own block (<= ``block_rows``
    rows).  Peers then take the values of their last row through a partially
    aggregated group-by.  Sums are order-independent (``functions.exact``); NaN counts as NULL.
    """
    spark = df.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(partition), F.col(order)] + [F.col(c) for c in tie_breaks]
    parts = {"_v_" + k: c for k, c in split(F.col(value)).items()}
    idx = range_index(df.withColumns({"_v": not_nan(F.col(value)), **parts}), keys, num_partitions, "running")
    idx = idx.withColumn("_blk", F.floor(F.col("_local") / F.lit(block_rows)).cast("bigint"))
    earlier = Window.unboundedPreceding, -1

    def totals(cols):
        return idx.groupBy(*cols).agg(F.count("_v").alias("_c"), F.max("_v").alias("_m"),
                                      *[F.sum(p).alias("_s" + p) for p in parts])

    def prefixed(t, part, order_col, tag):
        w = Window.partitionBy(*part).orderBy(order_col).rowsBetween(*earlier)
        return t.select(*part, order_col, F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_c" + tag),
                        F.max("_m").over(w).alias("_m" + tag),
                        *[F.coalesce(F.sum("_s" + p).over(w), F.lit(0)).alias(p + tag) for p in parts])

    by_part = prefixed(totals([partition, "_pid"]), [partition], "_pid", "1")
    by_blk = prefixed(totals([partition, "_pid", "_blk"]), [partition, "_pid"], "_blk", "2")
    w_in = Window.partitionBy(partition, "_pid", "_blk").orderBy("_local").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = idx.join(by_blk, [partition, "_pid", "_blk"]).join(by_part, [partition, "_pid"]).select(
        *df.columns, "_pid", "_local", *[c + tag for tag in "12" for c in ("_c", "_m", *parts)],
        F.count("_v").over(w_in).alias("_c3"), F.max("_v").over(w_in).alias("_m3"),
        *[F.coalesce(F.sum(p).over(w_in), F.lit(0)).alias(p + "3") for p in parts])
    sums = {p: F.col(p + "1") + F.col(p + "2") + F.col(p + "3") for p in ("_c", *parts)}
    cum = rows.select(*df.columns, F.struct("_pid", "_local").alias("_pos"), F.struct(
        F.greatest("_m1", "_m2", "_m3").alias("_m"), *[c.alias(p) for p, c in sums.items()]).alias("_now"))
    # Peers: every row takes the running values of the last row with its (partition, order) value.
    peers = cum.groupBy(partition, order).agg(F.max_by("_now", "_pos").alias("_last"))
    out = cum.drop("_now", "_pos").join(peers, [partition, order])
    return out.select(
        *df.columns,
        F.col("_last._c").alias("running_count"),
        mean({k: F.col("_last._v_" + k) for k in PARTS}, F.col("_last._c")).alias("running_avg"),
        F.col("_last._m").alias("running_max"),
    )
