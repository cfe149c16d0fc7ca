"""Topic records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators.latest import latest_per_key
from rivulet.schemas import TOPIC_COLUMNS

_MESSAGE = ["topic", "partition", "offset"]


def project_topic(records: DataFrame) -> DataFrame:
    """The seven message columns, each as text."""
    return records.select(*[F.col(c).cast("string").alias(c) for c in TOPIC_COLUMNS])


def dedup_offsets(bronze: DataFrame) -> DataFrame:
    """One row per message.

    Bronze is appended at least once, so a message may be there again after a
    crash. (topic, partition, offset) names a message; the last copy stays. Keys are
    counted first: only messages that are there again are ranked with their payload.
    """
    message = _MESSAGE
    again = bronze.groupBy(*message).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").alias("again")
    rows = bronze.alias("rows")
    same = [F.col(f"rows.{c}").eqNullSafe(F.col(f"again.{c}")) for c in message]
    repeated = latest_per_key(rows.join(again, same, "left_semi"), message, ["_raw_insert_timestamp"])
    return rows.join(again, same, "left_anti").unionByName(repeated)


def once_per_message(bronze: DataFrame, keep: str) -> DataFrame:
    """A stream of bronze rows, with one row per message and the copies left out.

    A message that was read in any batch of the last `keep` ("7 days") is not passed on
    again; Spark keeps the names of those messages, not their payload, in the query's
    state, so a restart forgets nothing. The time that counts is when a row is read, which
    never lies behind the watermark: no row is late, however old its file. Copies that
    come further apart than `keep` pass; the upsert keeps silver right all the same. A row
    without topic, partition or offset is named by all its columns. Which of two copies
    in one batch goes on is open.
    """
    named = [F.col(c).isNotNull() for c in _MESSAGE]
    name = F.concat_ws("\x00", *_MESSAGE)
    whole = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in bronze.columns])), 256)
    seen = bronze.withColumns(
        {"_message": F.when(named[0] & named[1] & named[2], name).otherwise(whole), "_seen": F.current_timestamp()}
    )
    return seen.withWatermark("_seen", keep).dropDuplicatesWithinWatermark(["_message"]).drop("_message", "_seen")


def with_topic_order(bronze: DataFrame) -> DataFrame:
    """Typed order columns from the text that bronze holds."""
    return bronze.withColumns(
        {
            "_topic_timestamp": F.col("timestamp").try_cast(T.TimestampType()),
            "_topic_partition": F.col("partition").try_cast("int"),
            "_topic_offset": F.col("offset").try_cast("bigint"),
        }
    )
