"""Audit columns: when a row entered a layer, and the partitions derived from it."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_time(at: datetime | None = None) -> Column:
    """One instant for a whole micro-batch.

    Taken on the driver, as `current_timestamp()` would differ between the
    several actions of one batch. `at` must carry a time zone.
    """
    return F.lit(at or datetime.now(timezone.utc)).cast(T.TimestampType())


def with_audit(df: DataFrame, prefix: str, at: Column | None = None) -> DataFrame:
    """Appends `{prefix}_date`, two-digit `{prefix}_hour` and `{prefix}_timestamp`.

    All three come from one instant, so that date and hour cannot straddle
    midnight.
    """
    at = F.current_timestamp() if at is None else at
    return df.withColumns(
        {
            f"{prefix}_date": F.to_date(at),
            f"{prefix}_hour": F.date_format(at, "HH"),
            f"{prefix}_timestamp": at,
        }
    )
