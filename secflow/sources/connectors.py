"""Source connectors: relational snapshot, lakehouse table, change topics.

All return DataFrames with the declared entity/envelope schemas; nothing is
inferred.  Connectors that need packages absent from a deployment (JDBC
driver, message-bus connector, table-format jars) fail at ``load`` time with
Spark's own error; the offline forms (parquet files) need nothing extra.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow import schemas as S
from secflow.operators.cdc import snapshot_envelope


def jdbc_snapshot(spark: SparkSession, url: str, table: str, schema: T.StructType, key_cols: list[str],
                  as_of, partition_column: str | None = None, lower: int | None = None,
                  upper: int | None = None, num_partitions: int = 1, properties: dict | None = None) -> DataFrame:
    """Snapshot of an operational table as change records with op 'r'.

    With ``partition_column``/bounds the read is split into ``num_partitions``
    parallel range queries instead of one connection reading the whole table.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower)
                  .option("upperBound", upper).option("numPartitions", num_partitions))
    rows = reader.load().select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return snapshot_envelope(rows, key_cols, as_of)


def lakehouse_table(spark: SparkSession, name: str) -> DataFrame:
    """Findings table by catalog name; an empty name is a configuration error."""
    if not name:
        raise ValueError("a fully qualified table name is required")
    return spark.table(name)


def parquet_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def change_files(spark: SparkSession, path: str, after: T.StructType, key_fields: list[str]) -> DataFrame:
    """Batch read of change records stored as files in envelope form."""
    return spark.read.schema(S.envelope(after, key_fields)).parquet(path)
