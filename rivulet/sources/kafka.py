"""Topic source. Needs the `spark-sql-kafka-0-10` package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.operators.topic import project_topic


def kafka_options(servers: str, topic: str, starting_offsets: str = "earliest", **options: str) -> dict[str, str]:
    """Reads from the earliest record on, so that none sent before the first start is skipped.

    Pass `maxOffsetsPerTrigger` to bound a batch and `minPartitions` to read a
    topic with more tasks than it has partitions.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **options,
    }


def stream_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    records = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()
    return project_topic(records)
