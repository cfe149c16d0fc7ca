"""Landing job: files to topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.envelope import wrap_files
from rivulet.sinks.topic import append_topic_log, kafka_writer
from rivulet.sources.files import stream_files
from rivulet.sources.records import record_files, stream_records
from rivulet.streaming.common import query_id, start


def land_to_kafka(
    spark: SparkSession,
    directory: str,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    **source_options: str,
) -> StreamingQuery:
    messages = wrap_files(stream_files(spark, directory, **source_options))
    return start(kafka_writer(messages, servers, topic), checkpoint, trigger)


def land_to_log(
    spark: SparkSession,
    directory: str,
    topic_log: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    **source_options: str,
) -> StreamingQuery:
    """The same job with a Parquet folder in the broker's place."""

    def write(batch: DataFrame, batch_id: int) -> None:
        source = query_id(batch.sparkSession, checkpoint)
        append_topic_log(wrap_files(batch), batch_id, topic_log, topic, source)

    files = stream_files(spark, directory, **source_options)
    return start(files.writeStream.foreachBatch(write), checkpoint, trigger)


def land_records_to_log(
    spark: SparkSession,
    directory: str,
    topic_log: str,
    topic: str,
    checkpoint: str,
    trigger: dict | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Large files, and files of several roots, as one message per transaction (`sources.records`)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        source = query_id(batch.sparkSession, checkpoint)
        append_topic_log(wrap_files(record_files(batch)), batch_id, topic_log, topic, source)

    records = stream_records(spark, directory, **source_options)
    return start(records.writeStream.foreachBatch(write), checkpoint, trigger)
