"""Topic sinks: the real topic, and a Parquet folder where there is no broker."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rivulet.functions.audit import batch_time

_ROW_BITS = 22
_ROW_MASK = (1 << 33) - 1
_CLOCK_START = datetime(2020, 1, 1, tzinfo=timezone.utc)


def kafka_writer(messages: DataFrame, servers: str, topic: str) -> DataStreamWriter:
    """Needs the `spark-sql-kafka-0-10` package on the class path."""
    return messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)


def append_topic_log(
    messages: DataFrame, batch_id: int, directory: str, topic: str, source: str, at: datetime | None = None
) -> None:
    """Writes one batch of `key`, `value` rows as topic records.

    The writing task stands for the topic partition. Offsets begin with the
    batch's clock time, so they grow from batch to batch even when a checkpoint
    is lost and batch ids start over. A batch written again replaces itself.
    """
    at = at or datetime.now(timezone.utc)
    clock = int((at - _CLOCK_START).total_seconds() * 1000)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
    records = messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.spark_partition_id().cast("string").alias("partition"),
        (F.lit(clock << _ROW_BITS) + row).cast("string").alias("offset"),
        batch_time(at).cast("string").alias("timestamp"),
        F.lit("0").alias("timestampType"),
    )
    records.write.mode("overwrite").parquet(f"{directory}/_source={source}/_batch_id={batch_id}")
