"""Documents as files, for the landing zone."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.streaming.common import start


def write_document_files(documents: DataFrame, directory: str) -> None:
    """One file per row of a one-column DataFrame, written by the executors.

    On a disk that all executors mount, tasks write the files themselves: for each file
    Spark's writer has Hadoop start two `chmod` processes, and the driver then moves the
    files one after the other. A file appears whole, under a name that an attempt of the
    same task repeats. Elsewhere Spark's writer does it, and tasks move
    their own files to the folder.
    """
    mounted = _mounted(documents.sparkSession, directory)
    if mounted is None or [field.dataType.typeName() for field in documents.schema] != ["string"]:
        moving = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
        documents.write.mode("append").options(maxRecordsPerFile=1, **moving).text(directory)
        return
    os.makedirs(mounted, exist_ok=True)
    job = uuid.uuid4()

    def write(rows: Iterator[Row]) -> None:
        task = TaskContext.get()
        hidden = f"{mounted}/.{job}-{task.taskAttemptId()}"
        for number, (text,) in enumerate(rows):
            with open(hidden, "wb") as out:
                out.write(b"\n" if text is None else text + b"\n")
            os.replace(hidden, f"{mounted}/part-{task.partitionId():05d}-{job}-c{number:06d}.txt")

    # As bytes, which no way through Python changes.
    documents.select(documents[0].cast("binary")).foreachPartition(write)


def _mounted(spark: SparkSession, directory: str) -> str | None:
    """The folder as a path of this machine, None if it is of another file system."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", directory):
        return os.path.abspath(directory) if default.startswith("file:") else None
    local = re.fullmatch(r"file:(?://)?(/.*)", directory)
    return local[1].rstrip("/") if local else None


def start_document_files(documents: DataFrame, directory: str, checkpoint: str) -> StreamingQuery:
    """The same for a stream of documents."""

    def write(batch: DataFrame, _: int) -> None:
        write_document_files(batch, directory)

    return start(documents.writeStream.foreachBatch(write), checkpoint, {"processingTime": "1 second"})
