"""Bronze job: topic messages, as they are, to a date/hour-partitioned table."""

from __future__ import annotations

import logging
import traceback

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.audit import batch_time
from rivulet.sinks.bronze import append_bronze
from rivulet.sinks.dead_letters import write_failed_bronze
from rivulet.streaming.common import EVERY_MINUTE, query_id, start

logger = logging.getLogger(__name__)


def process_batch(
    records: DataFrame, batch_id: int, bronze: str, failed: str, source: str, files: int | None = None
) -> None:
    """Appends one batch; if that fails, keeps its payloads as dead letters.

    The batch then counts as done. Only a failure to write the dead letters
    fails the query.
    """
    if records.isEmpty():
        logger.info("batch %d is empty", batch_id)
        return
    at = batch_time()
    try:
        written = append_bronze(records, bronze, at, files)
        logger.info("batch %d: %d messages to bronze", batch_id, written)
    except Exception:  # noqa: BLE001 - whatever it was, the payloads must be kept
        logger.exception("batch %d failed", batch_id)
        write_failed_bronze(records, failed, source, batch_id, at, traceback.format_exc())


def start_bronze(
    records: DataFrame,
    bronze: str,
    failed: str,
    checkpoint: str,
    trigger: dict | None = EVERY_MINUTE,
    files: int | None = None,
) -> StreamingQuery:
    """`records` is a stream of topic records (`stream_kafka`, `stream_topic_log`).

    A longer trigger interval and `files`, the most files per batch, both make
    for fewer and larger bronze files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, bronze, failed, query_id(batch.sparkSession, checkpoint), files)

    return start(records.writeStream.foreachBatch(write), checkpoint, trigger)
