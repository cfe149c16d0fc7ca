"""Text to typed values, without ever failing a batch over one bad value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.schemas import AMOUNT


def present(text: Column) -> Column:
    """NULL for absent and blank element text, else the text."""
    return F.when(F.trim(text) != "", text)


def identifier(text: Column) -> Column:
    return present(text).try_cast("bigint")


def amount(text: Column) -> Column:
    """Decimal with two places; NULL when unreadable or too large."""
    return present(text).try_cast(AMOUNT)


def event_time(text: Column) -> Column:
    """Zone-less wall-clock time of the session zone.

    Text that names an offset is converted to the session zone first. The
    zone-less cast decides what is readable: it refuses a bare time of day,
    which the zoned cast would complete with today's date.
    """
    return F.when(
        present(text).try_cast(T.TimestampNTZType()).isNotNull(),
        text.try_cast(T.TimestampType()).cast(T.TimestampNTZType()),
    )


def label(text: Column) -> Column:
    return F.upper(F.trim(text))
