"""Single files out of rows: a writer with commit and abort, whose files appear only when all are written.

Tasks write their rows below a staging folder, each attempt below its own. Spark's commit notes which attempts count; a
second job then renames their files to where they belong, a task an attempt, which may be repeated. An abort removes the
staging folder, and nothing has appeared.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from boxlake.sources.store import store

FORMAT = "single_files"
#: Contents come to a worker in batches of about this size: it holds one, whatever the number of files.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


@dataclass
class Attempt(WriterCommitMessage):
    folder: str
    files: int


class SingleFileWriter(DataSourceArrowWriter):
    """Rows of (name, content) to files below ``staging``."""

    def __init__(self, staging: str) -> None:
        self.staging = staging

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        folder, names = f"{self.staging}/{uuid.uuid4().hex}", []
        to = store(folder)
        for batch in iterator:
            for i in range(batch.num_rows):
                # Bytes go from the batch to the file; a worker makes no second copy of them.
                name, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_buffer()
                if name is None or ".." in name.split("/"):
                    raise ValueError(f"not a name below the root: {name}")
                to.write(f"{folder}/{len(names)}", content or b"")
                names.append(name)
        to.write(f"{folder}/names.json", json.dumps(names).encode())
        return Attempt(folder, len(names))

    def commit(self, messages: list[Attempt | None]) -> None:
        store(self.staging).write(f"{self.staging}/committed.json", json.dumps([[m.folder, m.files] for m in messages if m is not None]).encode())

    def abort(self, messages: list[Attempt | None]) -> None:
        if store(self.staging).kind(self.staging):
            store(self.staging).remove(self.staging)


class SingleFiles(DataSource):
    """``df.write.format("single_files").mode("append").save(staging)`` for rows of (name string, content binary)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> SingleFileWriter:
        if [(f.name, f.dataType.simpleString()) for f in schema.fields] != [("name", "string"), ("content", "binary")]:
            raise ValueError(f"(name string, content binary) is asked for, not {schema.simpleString()}")
        return SingleFileWriter(self.options["path"])


def write_files(rows: DataFrame, root: str, name: str = "name", content: str = "content") -> int:
    """Writes each row's bytes (or text, as UTF-8) as the file ``root``/name, replacing what is there; gives their number.

    Contents go from tasks to the store, names too; the driver learns of attempts only. Nothing appears below the root before
    all is written; then files appear one after another. A null content is an empty file, a null name an error. Of rows
    with one name, one is kept.
    """
    spark = rows.sparkSession
    spark.dataSource.register(SingleFiles)
    staging = f"{root.rstrip('/')}/.staging-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH[0], None)
    spark.conf.set(*BATCH)
    try:
        rows.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content")).write.format(FORMAT).mode("append").save(staging)
    finally:
        spark.conf.unset(BATCH[0]) if before is None else spark.conf.set(BATCH[0], before)
    return publish(spark, staging, root)


def publish(spark: SparkSession, staging: str, root: str) -> int:
    """Renames the files of a committed staging folder to their places below ``root`` and removes it; may be repeated."""
    attempts = json.loads(store(staging).read(f"{staging}/committed.json"))  # a row a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                to = store(folder)
                names = json.loads(to.read(f"{folder}/names.json"))
                for i, name in enumerate(names):
                    if to.kind(f"{folder}/{i}"):
                        to.move(f"{folder}/{i}", f"{root.rstrip('/')}/{name}", over=True)
                yield pa.RecordBatch.from_arrays([pa.array([len(names)], pa.int64())], names=["n"])

    folders = spark.createDataFrame([(f,) for f, _ in attempts], "folder string")
    done = folders.repartition(max(1, len(attempts))).mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0
    store(staging).remove(staging)
    return done

