"""Appends of JSON lines that readers see whole or not at all, as a Spark data source.

Each task writes a file of its own and tells its name; the driver commits an append by one manifest that
names the files, under another name first. Readers take the files of manifests alone, so whatever a killed
task, a second try or an aborted job leaves behind is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = "atomic_jsonl"
MANIFESTS, FILES = "_commits", "files"


@dataclass
class Written(WriterCommitMessage):
    """What one task has written; no file for no rows."""

    file: str | None
    rows: int


def _open(path: str) -> tuple[fs.FileSystem, str]:
    store, root = fs.FileSystem.from_uri(path)
    store.create_dir(f"{root}/{FILES}", recursive=True)
    store.create_dir(f"{root}/{MANIFESTS}", recursive=True)
    return store, root


class AtomicWriter(DataSourceArrowWriter):
    """Lines of one JSON column named value. transaction: a name under which an append is committed once, whoever tries it again."""

    def __init__(self, path: str, transaction: str | None):
        self.path, self.transaction, self.job = path, transaction, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _open(self.path)
        task = TaskContext.get()
        name, rows, out = f"{self.job}-{task.partitionId():06d}-{task.taskAttemptId()}.jsonl", 0, None
        try:
            for batch in iterator:
                lines = batch.column(0).drop_null().to_pylist()
                if lines:
                    out = out or store.open_output_stream(f"{root}/{FILES}/{name}")
                    out.write(("\n".join(lines) + "\n").encode())
                    rows += len(lines)
        finally:
            if out:
                out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        done = [m for m in messages if m is not None and m.file]
        name = f"{root}/{MANIFESTS}/{f'named-{self.transaction}' if self.transaction else f'job-{self.job}'}.json"
        if store.get_file_info(name).type != fs.FileType.NotFound:
            self.abort(messages)  # committed before: this try's files go
            return
        draft = f"{root}/{MANIFESTS}/.draft-{self.job}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps({"files": [m.file for m in done], "rows": sum(m.rows for m in done)}).encode())
        store.move(draft, name)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _open(self.path)
        for m in messages:
            if m is not None and m.file:
                store.delete_file(f"{root}/{FILES}/{m.file}")


class AtomicJsonLines(DataSource):
    """Options: path, and transaction if the append has a name."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: T.StructType, overwrite: bool) -> AtomicWriter:
        if overwrite or [f.dataType for f in schema.fields] != [T.StringType()]:
            raise ValueError("one column of JSON lines can be appended, nothing else")
        return AtomicWriter(self.options["path"], self.options.get("transaction"))


def append_whole(rows: DataFrame, path: str, transaction: str | None = None) -> None:
    """Appends rows as JSON lines, all of them or none; nulls are left out of a line. A transaction that was committed before adds nothing."""
    spark = rows.sparkSession
    spark.dataSource.register(AtomicJsonLines)
    writer = rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.format(NAME).mode("append").option("path", path)
    (writer.option("transaction", transaction) if transaction else writer).save()


def read_whole(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The rows of committed appends. Manifests are read by the driver: a name a file."""
    store, root = _open(path)
    found = [x.path for x in store.get_file_info(fs.FileSelector(f"{root}/{MANIFESTS}")) if x.base_name.endswith(".json")]
    files = []
    for manifest in sorted(found):
        with store.open_input_stream(manifest) as file:
            files += json.loads(file.read())["files"]
    reader = spark.read.schema(schema)
    return reader.json([f"{path.rstrip('/')}/{FILES}/{name}" for name in files]) if files else spark.createDataFrame([], schema)
