"""What became of each batch, as a table that alerts can be read from."""

from __future__ import annotations

import logging
import threading
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import (
    QueryProgressEvent,
    QueryStartedEvent,
    QueryTerminatedEvent,
    StreamingQueryListener,
)

from rivulet.schemas import OUTCOME
from rivulet.sources.files import read_table

logger = logging.getLogger(__name__)


class OutcomeLog(StreamingQueryListener):
    """Appends a row per batch, and one per run when it ends, of every query of the session.

    A run that ends with an error has it in `error`; so has its batch no row of its own, as
    it did not count as done. Spark tells of these events a little later than they happen:
    `settled` waits for the end of a run to be written. `rows` is Spark's figure, which has a
    row as often as the batch was read. Errors while writing are logged,
    and never reach the query.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def __enter__(self) -> OutcomeLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def _run(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def _append(self, **row: object) -> None:
        try:
            row["at"] = datetime.now(timezone.utc)
            values = [tuple(row.get(name) for name in OUTCOME.names)]
            self.spark.createDataFrame(values, OUTCOME).coalesce(1).write.mode("append").parquet(self.path)
        except Exception:  # noqa: BLE001 - a lost note must not stop anything
            logger.exception("no outcome written for %s", row)

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        self._run(str(event.runId))

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        done = event.progress
        self._append(
            query_id=str(done.id), run_id=str(done.runId), name=done.name, event="batch", batch_id=done.batchId,
            rows=done.numInputRows, seconds=done.batchDuration / 1000.0,
        )

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        kind = "failed" if event.exception else "ended"
        self._append(query_id=str(event.id), run_id=str(event.runId), event=kind, error=event.exception)
        self._run(str(event.runId)).set()

    def settled(self, query: StreamingQuery, timeout: float = 60.0) -> bool:
        """Whether the end of this run of the query has been written, waiting for it if need be."""
        return self._run(str(query.runId)).wait(timeout)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, OUTCOME)
