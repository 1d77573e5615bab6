"""Small shared helpers: projected inputs, pinned intermediate tables, Arrow batches."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from secflow.session import scratch_path, ship_package

_TABLES: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id long, text string): extra or clashing input columns never reach an operator."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def pinned(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Later stages re-read the table instead of recomputing the plan, so a lost executor costs only
    its tasks and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    _TABLES.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def _delete(t: tuple[SparkSession, str]) -> None:
    path = t[0].sparkContext._jvm.org.apache.hadoop.fs.Path(t[1])
    path.getFileSystem(t[0].sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _TABLES.remove(t)


def _reads(df: DataFrame, path: str) -> bool:
    name = path.rsplit("/", 1)[-1]
    return any(name in f for f in df.inputFiles()[:1])


def release(spark: SparkSession, needed: DataFrame | None = None) -> None:
    """Delete the tables that ``pinned`` made for ``spark``, but for the one that ``needed`` reads."""
    for t in [t for t in _TABLES if t[0] is spark and not (needed is not None and _reads(needed, t[1]))]:
        _delete(t)


def drop(df: DataFrame) -> None:
    """Delete the table made by ``pinned`` that ``df`` is, once no later plan reads it."""
    for t in [t for t in _TABLES if t[0] is df.sparkSession and _reads(df, t[1])]:
        _delete(t)


@atexit.register
def _delete_left() -> None:
    """What nobody released goes with the process, if its session still runs."""
    for t in list(_TABLES):
        try:
            _delete(t)
        except Exception:  # noqa: BLE001 - the session has stopped
            break


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the package present on the workers, which give freed memory back after a task."""
    ship_package(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        give_back()
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that this process has freed: a worker lives on, idle or in another stage's tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # only glibc has it
    if trim is not None:
        trim(0)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type)
         for n, c in ((n, columns[n]) for n in schema.names)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], text_col: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the text bytes of each piece stay near ``limit`` (whole rows)."""
    for b in batches:
        col = b.column(text_col)
        lens = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(lens):
            if size and size + n > limit:
                yield b.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < b.num_rows:
            yield b.slice(start)


def usable_vector(col: Column) -> Column:
    """True for a vector without null or non-finite components (and not empty)."""
    finite = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(col.isNotNull() & (F.size(col) > 0) & finite, F.lit(False))
