"""Bulk documents as files: a Spark data source whose tasks report what they wrote and whose driver commits it.

``register(spark)``, then ``df.write.format("bulk_documents").option("path", p).option("batch", n).mode("append").save()``.
Rows need ``_id``; a file holds an action line and a document line per row (keys sorted, NULLs left out), as bulk endpoints take
them.  Tasks write into a folder of the job.  Commit publishes the batch by moving one manifest into place: files and
documents, from the tasks' commit messages, so nothing is counted by a second job.  A task that fails or is run twice
publishes nothing that is not in the manifest; a batch that has a manifest is not published again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from secflow.session import ship_package

NAME = "bulk_documents"


@dataclass
class Written(WriterCommitMessage):
    file: str
    documents: int


def _manifest(root: str, batch: int) -> str:
    return os.path.join(root, "manifests", f"batch-{batch:012d}.json")


def _exists(files: fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != fs.FileType.NotFound


class BulkWriter(DataSourceArrowWriter):
    def __init__(self, path: str, batch: int, index: str | None):
        self.path, self.batch, self.index = path, batch, index
        self.job = f"job-{batch:012d}-{uuid.uuid4().hex}"

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = self._at()
        files.create_dir(os.path.join(root, self.job), recursive=True)
        name, n = os.path.join(self.job, f"part-{uuid.uuid4().hex}.ndjson"), 0
        with files.open_output_stream(os.path.join(root, name)) as out:
            for rows in iterator:
                lines = []
                for row in rows.to_pylist():
                    action = {"_id": row.pop("_id")}
                    if action["_id"] is None:
                        raise ValueError("a document has no _id")
                    if self.index:
                        action["_index"] = self.index
                    doc = {k: v for k, v in row.items() if v is not None}
                    lines.append(json.dumps({"index": action}, sort_keys=True))
                    lines.append(json.dumps(doc, sort_keys=True, default=str, separators=(",", ":")))
                if lines:
                    out.write(("\n".join(lines) + "\n").encode())
                n += rows.num_rows
        return Written(name, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = self._at()
        if _exists(files, _manifest(root, self.batch)):        # replayed: the first one counts
            self.abort(messages)
            return
        done = [m for m in messages if isinstance(m, Written)]
        made = {"batch": self.batch, "documents": sum(m.documents for m in done),
                "files": sorted(m.file for m in done if m.documents)}
        files.create_dir(os.path.join(root, "manifests"), recursive=True)
        staged = os.path.join(root, "manifests", f"_{self.job}.json")
        with files.open_output_stream(staged) as out:
            out.write(json.dumps(made, sort_keys=True).encode())
        files.move(staged, _manifest(root, self.batch))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        files, root = self._at()
        if _exists(files, os.path.join(root, self.job)):
            files.delete_dir(os.path.join(root, self.job))


class BulkDocuments(DataSource):
    """Options: ``path`` (shared folder), ``batch`` (whole number, names the batch), ``index`` (optional)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> BulkWriter:
        if overwrite:
            raise ValueError("batches are appended; use mode('append')")
        if "_id" not in schema.names:
            raise ValueError("documents need a column _id")
        return BulkWriter(self.options["path"], int(self.options["batch"]), self.options.get("index"))


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(BulkDocuments)


def bulk_sink(path: str, index: str | None = None):
    """``foreachBatch`` target: each micro-batch's documents, published once."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        register(batch.sparkSession)
        writer = batch.write.format(NAME).mode("append").option("path", path).option("batch", batch_id)
        (writer.option("index", index) if index else writer).save()
    return sink


def manifests(path: str) -> list[dict]:
    """The published batches in order, each with its files and number of documents."""
    files, root = fs.FileSystem.from_uri(path)
    found = files.get_file_info(fs.FileSelector(os.path.join(root, "manifests"), allow_not_found=True))
    names = sorted(f.path for f in found if os.path.basename(f.path).startswith("batch-"))
    out = []
    for name in names:
        with files.open_input_stream(name) as src:
            out.append(json.loads(src.read()))
    return out


# How an action line starts; a document line is compact, without the blank, so it never starts like that.
_ACTION = '{"index": '


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(_id, document) of the published batches, a later batch replacing a document of an earlier one."""
    # Split before each action line: a record is an action's rest and its document, and files are cut anywhere.
    reader = spark.read.option("lineSep", "\n" + _ACTION)
    found = spark.createDataFrame([], "_id string, batch long, document string")
    for made in manifests(path):
        if made["files"]:
            parts = F.split("value", "\n")
            action = F.when(parts[0].startswith(_ACTION), parts[0]).otherwise(F.concat(F.lit(_ACTION), parts[0]))
            found = found.unionByName(reader.text([os.path.join(path, f) for f in made["files"]]).select(
                F.get_json_object(action, "$.index._id").alias("_id"), F.lit(made["batch"]).cast("long").alias("batch"),
                parts[1].alias("document")))
    return found.groupBy("_id").agg(F.max(F.struct("batch", "document")).alias("v")).select("_id", "v.document")
