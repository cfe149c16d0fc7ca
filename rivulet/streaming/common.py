"""Small things all three jobs share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

DRAIN = {"availableNow": True}
EVERY_MINUTE = {"processingTime": "1 minute"}
ADAPTIVE = "spark.sql.adaptive.enabled"


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that owns a checkpoint.

    It survives restarts and changes with a new checkpoint, where batch ids
    start over at zero; (query id, batch id) therefore names a batch for good.
    Inside a batch Spark has it at hand; elsewhere it is read from the checkpoint.
    """
    running = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return running or spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


@contextmanager
def adaptive(batch: DataFrame, chosen: str) -> Iterator[None]:
    """Adaptive execution within a batch as its caller has chosen it.

    Spark turns it off for a stream with state, whose shuffles must keep their number of
    partitions. Those lie before the batch; the plans of its writers, made here, need it:
    without it "rebalance" says nothing, and each task writes a file for every date.
    """
    conf = batch.sparkSession.conf
    before = conf.get(ADAPTIVE)
    conf.set(ADAPTIVE, chosen)
    try:
        yield
    finally:
        conf.set(ADAPTIVE, before)


def start(writer: DataStreamWriter, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    """Starts a query with its own checkpoint; no trigger means as fast as possible."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_console(stream: DataFrame) -> StreamingQuery:
    """Prints a stream's batches, for debugging."""
    return stream.writeStream.outputMode("append").format("console").start()
