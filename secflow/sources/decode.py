"""Finding records on the wire: registry-framed protobuf values.

Frame: magic byte 0, 4-byte big-endian schema id, message-index list (zig-zag
varints, count first; a single 0 byte stands for the first message), then the
protobuf payload.  Decoding runs as a ``mapInArrow`` job over the binary
column, so it is partitioned like its input; Spark's own
``from_protobuf`` can replace it where the protobuf connector is on the
classpath.  Empty values (tombstones) are skipped; records that fail to decode
go to a rejects frame with the error text instead of failing the job.
Absent proto3 scalars decode to '' and 0.0.
"""

from __future__ import annotations

import struct
from operator import attrgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from secflow.session import ship_package

# Field names and numbers of the finding message (proto3).
FINDING_FIELDS = [
    ("tenant_id", 1, "string"), ("asset_id", 2, "string"), ("device_type", 3, "string"),
    ("ip_address", 4, "string"), ("cve_id", 5, "string"), ("cvss_score", 6, "double"),
    ("severity", 7, "string"), ("anomaly_score", 8, "double"), ("finding_type", 9, "string"),
    ("predicted_risk", 10, "string"), ("model_version", 11, "string"), ("event_time", 12, "string"),
]
MAGIC = 0

DECODED = T.StructType(
    [T.StructField(n, T.DoubleType() if t == "double" else T.StringType()) for n, _, t in FINDING_FIELDS]
    + [T.StructField("schema_id", T.IntegerType()), T.StructField("_error", T.StringType()), T.StructField("_raw", T.BinaryType())]
)

ARROW = pa.schema([(n, pa.float64() if t == "double" else pa.string()) for n, _, t in FINDING_FIELDS]
                  + [("schema_id", pa.int32()), ("_error", pa.string()), ("_raw", pa.binary())])

_CLASS = None


def message_class():
    """The finding message class, built from ``FINDING_FIELDS`` (cached per Python worker)."""
    global _CLASS
    if _CLASS is None:
        from google.protobuf import descriptor_pb2, descriptor_pool, message_factory
        fdp = descriptor_pb2.FileDescriptorProto(name="secflow_finding.proto", package="secflow", syntax="proto3")
        msg = fdp.message_type.add(name="SecurityFinding")
        kinds = {"string": descriptor_pb2.FieldDescriptorProto.TYPE_STRING,
                 "double": descriptor_pb2.FieldDescriptorProto.TYPE_DOUBLE}
        for name, num, kind in FINDING_FIELDS:
            msg.field.add(name=name, number=num, type=kinds[kind],
                          label=descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL)
        pool = descriptor_pool.DescriptorPool()
        pool.Add(fdp)
        _CLASS = message_factory.GetMessageClass(pool.FindMessageTypeByName("secflow.SecurityFinding"))
    return _CLASS


def _read_varint(buf: bytes, pos: int) -> tuple[int, int]:
    shift = result = 0
    while True:
        if pos >= len(buf):
            raise ValueError("truncated varint")
        b = buf[pos]
        pos += 1
        result |= (b & 0x7F) << shift
        if not b & 0x80:
            return result, pos
        shift += 7
        if shift > 63:
            raise ValueError("varint too long")


def _zigzag(n: int) -> int:
    return (n >> 1) ^ -(n & 1)


def unframe(value: bytes) -> tuple[int, list[int], bytes]:
    if len(value) < 6 or value[0] != MAGIC:
        raise ValueError("unknown magic byte")
    schema_id = struct.unpack(">i", value[1:5])[0]
    count, pos = _read_varint(value, 5)
    count = _zigzag(count)
    indexes = []
    for _ in range(count):
        idx, pos = _read_varint(value, pos)
        indexes.append(_zigzag(idx))
    return schema_id, indexes or [0], value[pos:]


def frame(payload: bytes, schema_id: int) -> bytes:
    return bytes([MAGIC]) + struct.pack(">i", schema_id) + b"\x00" + payload


def _values(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _decode_batches(batches):
    parse, names = message_class().FromString, [n for n, _, _ in FINDING_FIELDS]
    fields, nothing, heads = attrgetter(*names), (None,) * len(names), {}
    for b in batches:
        rows, ids, errors, raw = [], [], [], []
        for v in _values(b.column("value")):
            try:
                # The usual frame is six bytes long; a batch has few different ones.
                schema_id, payload = heads.get(v[:6]), v[6:]
                if schema_id is None:
                    schema_id, _, payload = unframe(v)
                    if len(payload) == len(v) - 6:
                        heads[v[:6]] = schema_id
                rows.append(fields(parse(payload)))
                ids.append(schema_id)
                errors.append(None)
                raw.append(None)
            except Exception as exc:  # noqa: BLE001 - every decode failure is a reject
                rows.append(nothing)
                ids.append(None)
                errors.append(f"{type(exc).__name__}: {exc}")
                raw.append(v)
        columns = [*zip(*rows)] if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*columns, ids, errors, raw], ARROW)],
                                         schema=ARROW)


def decode_findings(records: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(decoded, rejects) from a frame with a binary ``value`` column; tombstones are dropped.

    A reject keeps its whole value (``_raw``) beside the error, so it can be identified and replayed.
    """
    ship_package(records.sparkSession)
    v = F.col(value_col)
    live = records.filter(v.isNotNull() & (F.length(v) > 0)).select(v.alias("value"))
    decoded = live.mapInArrow(_decode_batches, DECODED)
    ok = decoded.filter(F.col("_error").isNull()).drop("_error", "_raw")
    bad = decoded.filter(F.col("_error").isNotNull()).select("_error", "_raw")
    return ok, bad


def _encode_batches(batches, schema_id: int):
    cls, names = message_class(), [n for n, _, _ in FINDING_FIELDS]
    for b in batches:
        # The message leaves out what is None: absent texts, and absent or NaN numbers (both are NaN here).
        columns = [[None if x != x else x for x in _values(b.column(n))] for n in names]
        yield pa.RecordBatch.from_arrays([pa.array([
            frame(cls(**dict(zip(names, row))).SerializeToString(), schema_id) for row in zip(*columns)],
            pa.binary())], names=["value"])


def encode_findings(findings_df: DataFrame, schema_id: int = 1) -> DataFrame:
    """Finding rows -> framed protobuf values (the producer side, for replays and tests)."""
    ship_package(findings_df.sparkSession)
    names = [n for n, _, _ in FINDING_FIELDS]
    return findings_df.select(*names).mapInArrow(lambda it: _encode_batches(it, schema_id), "value binary")
