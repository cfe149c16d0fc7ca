"""Bronze to refined rows: one narrow plan, no shuffle, everything accounted for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.envelope import decode_envelope
from rivulet.operators.documents import explode_transactions, first_of_document, parse_documents
from rivulet.operators.latest import latest_per_key
from rivulet.operators.topic import with_topic_order
from rivulet.operators.transactions import clean_transactions, is_valid_row
from rivulet.schemas import BRONZE, KEY, ORDER, SILVER_ROW

_RECORD_ID = ["key", "topic", "partition", "offset"]


def refine(bronze: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per transaction, plus one per document that has none.

    Each row is either valid, rejected (`_row_reason`) or stands for an empty
    document; the first row of a document also says what is wrong with it
    (`_doc_reason`) and then carries its bronze row (`_record`). Everything else
    about the document is dropped here, so what a batch persists is small.
    `keep` names further input columns to pass on.
    """
    parsed = parse_documents(decode_envelope(with_topic_order(bronze)))
    slim = parsed.select(
        *keep,
        *ORDER[:-1],
        F.struct(*_RECORD_ID).alias("_record_id"),
        F.when(F.col("_doc_reason").isNotNull(), F.struct(*BRONZE.names)).alias("_record"),
        "_doc_reason",
        "parsed",
    )
    rows = clean_transactions(explode_transactions(slim, keep_empty=True))
    return rows.withColumns(
        {
            "_record": F.when(first_of_document(), F.col("_record")),
            "_record_id": F.when(F.col("_row_reason").isNotNull(), F.col("_record_id")),
        }
    )


def silver_rows(refined: DataFrame, batch_id: int | Column, at: Column) -> DataFrame:
    """The valid rows of a batch, latest per key, ready for the upsert."""
    latest = latest_per_key(refined.filter(is_valid_row()), KEY, ORDER)
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    stamped = latest.withColumn("_processed_insert_timestamp", at).withColumn("_batch_id", batch.cast("int"))
    return stamped.select(*SILVER_ROW.names)


def batch_counts(refined: DataFrame) -> DataFrame:
    """How many documents, malformed documents, empty documents, rows and rejects."""
    first, malformed = first_of_document(), F.col("_doc_reason").isNotNull()
    return refined.agg(
        F.count_if(first).alias("documents"),
        F.count_if(first & malformed).alias("malformed"),
        F.count_if(F.col("_position").isNull() & ~malformed).alias("empty"),
        F.count_if(is_valid_row()).alias("valid"),
        F.count_if(F.col("_row_reason").isNotNull()).alias("rejected"),
    )
