"""A table of keyed rows in buckets, rewritten bucket by bucket, one version per batch.

A batch publishes one directory, ``batch_id=N``, with a sub-directory for each bucket that it rewrote and a list of
those buckets.  A bucket's rows are those of the newest batch that rewrote it, so a micro-batch reads and writes
its own buckets and no others.  A bucket that a batch left empty is in its list without a sub-directory.

A batch is written under a staging name and published by one rename: readers see all of it or nothing.  A
replayed batch that was published is skipped; what a broken-off writer left is not seen and ``vacuum`` deletes it.
The state before batch N stays readable, so that a replay of N computes the same deltas.

Buckets are a hash of the key (``hash_bucket``) or a coarse value of it, such as the day of a window.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
LIST = "_buckets.json"


def hash_bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


class KeyedTable:
    """``bucket`` is a string column expression over the rows' columns."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, bucket: Column):
        self.spark, self.path, self.schema, self.bucket = spark, path, schema, bucket

    # --- files ---------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _batches(self) -> list[int]:
        fs, root = self._fs(self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("batch_id="))

    def _dir(self, batch_id: int) -> str:
        return os.path.join(self.path, f"batch_id={batch_id}")

    def _list(self, batch_id: int) -> dict[str, bool]:
        """The buckets that a batch rewrote, and whether it left rows in them."""
        fs, where = self._fs(os.path.join(self._dir(batch_id), LIST))
        stream = fs.open(where)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def published(self, batch_id: int) -> bool:
        fs, where = self._fs(self._dir(batch_id))
        return bool(fs.exists(where))

    # --- reading -------------------------------------------------------------------------

    def versions(self, before: int | None = None) -> dict[str, int]:
        """Each bucket's newest batch (among those before batch ``before``), without buckets that hold no row."""
        found: dict[str, tuple[int, bool]] = {}
        for b in reversed(self._batches()):
            if before is None or b < before:
                for bucket, rows in self._list(b).items():
                    found.setdefault(bucket, (b, rows))
        return {k: b for k, (b, rows) in found.items() if rows}

    def read(self, buckets: list[str] | None = None, before: int | None = None) -> DataFrame:
        """The rows (of the named buckets, as they were before batch ``before``)."""
        at = self.versions(before)
        paths = [f"{self._dir(b)}/{BUCKET}={k}" for k, b in at.items() if buckets is None or k in set(buckets)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def buckets_of(self, rows: DataFrame) -> list[str]:
        """The buckets of some rows: at most as many as the table has."""
        return sorted(r[0] for r in rows.select(self.bucket.alias(BUCKET)).distinct().collect())

    # --- writing -------------------------------------------------------------------------

    def stage(self, batch_id: int, rows: DataFrame, buckets: list[str]) -> str:
        """Write the new rows of the buckets and their list under a staging name."""
        staging = os.path.join(self.path, f"_staging-{batch_id}-{uuid.uuid4().hex}")
        out = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn(BUCKET, self.bucket)
        # Adaptive execution joins small buckets in a task and splits a large one.
        out.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(staging)
        fs, root = self._fs(staging)
        full = {s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(root) if s.isDirectory()}
        if full - set(buckets):
            raise ValueError(f"rows outside the rewritten buckets: {sorted(full - set(buckets))[:3]}")
        stream = fs.create(self._fs(os.path.join(staging, LIST))[1])
        stream.write(bytearray(json.dumps({k: k in full for k in buckets}).encode()))
        stream.close()
        return staging

    def publish(self, batch_id: int, staging: str) -> None:
        fs, src = self._fs(staging)
        if self.published(batch_id):
            fs.delete(src, True)
        elif not fs.rename(src, self._fs(self._dir(batch_id))[1]):
            raise OSError(f"batch {batch_id} was not published")

    def rewrite(self, batch_id: int, rows: DataFrame, buckets: list[str]) -> None:
        """Replace the rows of the buckets by ``rows``."""
        if not self.published(batch_id):
            self.publish(batch_id, self.stage(batch_id, rows, buckets))

    def vacuum(self, before: int) -> list[str]:
        """Delete what no reader of the state before batch ``before``, or of a later one, needs."""
        needed = set(self.versions(before).values())
        gone = [self._dir(b) for b in self._batches() if b < before and b not in needed
                and not self._covers_empty(b, before)]
        fs, root = self._fs(self.path)
        if fs.exists(root):
            names = [s.getPath().getName() for s in fs.listStatus(root)]
            gone += [os.path.join(self.path, n) for n in names if n.startswith("_staging-")]
        for path in gone:
            fs.delete(self._fs(path)[1], True)
        return gone

    def _covers_empty(self, batch_id: int, before: int) -> bool:
        """True if the batch emptied a bucket of which an earlier batch still holds rows."""
        emptied = {k for k, rows in self._list(batch_id).items() if not rows}
        return any(emptied & {k for k, rows in self._list(b).items() if rows} for b in self._batches() if b < batch_id)
