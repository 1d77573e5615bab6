"""SparkSession construction and cluster-safe scratch locations.

Every job in the library is expressed with the DataFrame API; this module only
pins the settings the library relies on (UTC session zone, AQE with skew-join
handling, Arrow for the few pandas stages) and resolves the shared checkpoint
folder.  On a cluster ``spark.checkpoint.dir`` is set by the deployment and is
read, never overridden; only local runs (tests, bench) get a scratch folder.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the library's results depend on (time zone) or that its plans assume.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "secflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode.

    The cluster names its shared folder in ``spark.checkpoint.dir``; we read it
    from the session.  Local runs without the setting get a fresh scratch folder;
    on a cluster a missing setting is an error, since no machine's own folder is shared.
    """
    sc = _context(spark)
    path = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not re.match(r"local($|\[)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="secflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    # Setting the folder makes a new subfolder each time: once per application and folder is enough.
    if sc is not None and (sc.applicationId, path) not in _CHECKPOINTED:
        sc.setCheckpointDir(path)
        _CHECKPOINTED.add((sc.applicationId, path))
    return path


_CHECKPOINTED: set[tuple[str, str]] = set()


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A location under the shared checkpoint folder (for stream checkpoints, staged tables)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``secflow`` importable in Python workers (``addPyFile`` of the package as a zip).

    Needed by the stages that run Python inside tasks (wire decode, streaming
    state functions); done once per application.  With the package installed on
    the executors this is redundant but harmless.
    """
    sc = _context(spark)
    key = sc.applicationId if sc is not None else f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    import zipfile

    import secflow
    root = os.path.dirname(os.path.abspath(secflow.__file__))
    # Built on the driver and served to executors by Spark's file server (``addPyFile``);
    # executors never read this path, so a driver-local folder is correct here.
    zpath = os.path.join(tempfile.mkdtemp(prefix="secflow-pkg-"), "secflow.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    if sc is not None:
        sc.addPyFile(zpath)
    else:
        spark.addArtifacts(zpath, pyfile=True)
    _SHIPPED.add(key)


_MATERIALIZED: list[tuple[SparkSession, str]] = []


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the
    plan) and pins nondeterministic values (positions, partition ids) so every
    later use of the result sees the same rows.
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _MATERIALIZED.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, deleted with the materialized tables."""
    import uuid
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    _MATERIALIZED.append((spark, path))
    return path


def materialized_count() -> int:
    """How many tables exist now; a mark for ``release_materialized(since=...)``."""
    return len(_MATERIALIZED)


def release_materialized(spark: SparkSession | None = None, since: int = 0) -> int:
    """Delete the tables this process materialized (optionally only for ``spark``, or only those
    after the first ``since``).

    Call when the DataFrames built on them are no longer needed.  Only paths
    recorded by ``materialize`` are removed, through the Hadoop FileSystem API
    so it works on the cluster's shared storage.
    """
    keep, removed = _MATERIALIZED[:since], 0
    for sess, path in _MATERIALIZED[since:]:
        if spark is not None and sess is not spark:
            keep.append((sess, path))
            continue
        try:
            jvm = sess.sparkContext._jvm
            hpath = jvm.org.apache.hadoop.fs.Path(path)
            fs = hpath.getFileSystem(sess.sparkContext._jsc.hadoopConfiguration())
            removed += int(bool(fs.delete(hpath, True)))
        except Exception:  # noqa: BLE001 - best effort (session already stopped)
            pass
    _MATERIALIZED[:] = keep
    return removed


atexit.register(release_materialized)
