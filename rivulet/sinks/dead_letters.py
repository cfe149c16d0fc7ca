"""Dead-letter tables.

Letters of a batch live in folders named after the query and the batch. A batch
that runs again overwrites its own letters, so none is there twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.audit import with_audit
from rivulet.functions.envelope import decode_envelope
from rivulet.operators.documents import first_of_document, parse_documents
from rivulet.schemas import BRONZE_PARTITIONS, BRONZE, ENVELOPE, ERROR_PARTITIONS


def _write(letters: DataFrame, path: str, source: str, batch_id: int, partitions: list[str]) -> None:
    letters.write.mode("overwrite").partitionBy(*partitions).parquet(f"{path}/_source={source}/_batch_id={batch_id}")


def malformed_letters(refined: DataFrame) -> DataFrame:
    """Full bronze rows of malformed documents, with every decoding step.

    Only the bronze row of such a document travels with the refined rows; the
    steps are worked out again here, for these few. Give it persisted rows: on a
    plan that is not, Spark pushes the filter below the parse and parses twice.
    """
    bad = refined.filter(first_of_document() & F.col("_doc_reason").isNotNull())
    bronze = bad.select("_record.*")
    return (
        parse_documents(decode_envelope(bronze))
        .withColumn("_corrupt_file", F.coalesce("parsed._corrupt_record", "xml_content", "value"))
        .withColumnRenamed("_doc_reason", "_reason")
        .select(
            *BRONZE.names,
            F.col("json_data").cast(ENVELOPE),
            "decoded_content",
            "xml_content",
            "parsed",
            "_corrupt_file",
            "_reason",
        )
    )


def rejected_letters(refined: DataFrame) -> DataFrame:
    """Single transactions that cannot be upserted, with the place they came from."""
    return refined.filter(F.col("_row_reason").isNotNull()).select(
        F.col("_rejected").alias("transaction"),
        F.col("_row_reason").alias("_reason"),
        F.col("_record_id.key").alias("key"),
        F.col("_record_id.topic").alias("topic"),
        F.col("_record_id.partition").alias("partition"),
        F.col("_record_id.offset").alias("offset"),
        "_position",
        "_raw_insert_timestamp",
    )


def write_letters(letters: DataFrame, path: str, source: str, batch_id: int, at: Column) -> None:
    _write(with_audit(letters, "_error_insert", at), path, source, batch_id, ERROR_PARTITIONS)


def write_failed_batch(
    batch: DataFrame, path: str, source: str, batch_id: int, at: Column, message: str, trace: str
) -> None:
    """The whole input of a failed silver batch."""
    letters = batch.withColumn("error_message", F.lit(message)).withColumn("_traceback", F.lit(trace))
    write_letters(letters, path, source, batch_id, at)


def write_failed_bronze(records: DataFrame, path: str, source: str, batch_id: int, at: Column, trace: str) -> None:
    """The payloads of a bronze batch that could not be written."""
    letters = records.select(F.col("value").cast("string").alias("xml_data"), F.lit(trace).alias("_raw_error_text"))
    _write(with_audit(letters, "_raw_insert", at), path, source, batch_id, BRONZE_PARTITIONS)
