"""The JSON envelope that carries a file through the topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.schemas import CORRUPT, ENVELOPE

_ENVELOPE_OR_CORRUPT = T.StructType(ENVELOPE.fields + [T.StructField(CORRUPT, T.StringType())])


def wrap_files(files: DataFrame) -> DataFrame:
    """File rows to topic messages: the path as key, the whole row as JSON value.

    Binary content becomes base64 text and timestamps ISO-8601 text.
    """
    return files.select(
        F.col("path").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in files.columns])).alias("value"),
    )


def decode_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds `json_data`, `decoded_content`, `xml_content` and `_decode_reason`.

    `_decode_reason` is NULL when the payload could be read, else `bad_envelope`
    (not JSON, or no content), `bad_base64` or `bad_utf8`; `xml_content` is NULL
    exactly when there is a reason.
    """
    envelope = F.from_json(value, _ENVELOPE_OR_CORRUPT, {"columnNameOfCorruptRecord": CORRUPT})
    # Line breaks may wrap base64, but Spark takes one after the padding for an error.
    # Trimming goes over the whole text, whatever it ends in, so only what ends in white space is trimmed.
    content = F.col("json_data.content")
    blank = F.endswith(content, F.lit(" ")) | F.endswith(content, F.lit("\n")) | F.endswith(content, F.lit("\r")) | F.endswith(content, F.lit("\t"))
    content = F.when(blank, F.rtrim(content, F.lit(" \t\r\n"))).otherwise(content)
    decoded = messages.withColumn("json_data", envelope).withColumn(
        "decoded_content",
        F.when(F.col(f"json_data.{CORRUPT}").isNull(), F.try_to_binary(content, F.lit("base64"))),
    )
    return (
        decoded.withColumn("_decode_reason", _decode_reason())
        .withColumn("xml_content", F.when(F.col("_decode_reason").isNull(), F.col("decoded_content").cast("string")))
        .withColumn("json_data", F.col("json_data").dropFields(CORRUPT))
    )


def _decode_reason() -> Column:
    content, decoded = F.col("json_data.content"), F.col("decoded_content")
    return (
        F.when(content.isNull() | F.col(f"json_data.{CORRUPT}").isNotNull(), "bad_envelope")
        .when(decoded.isNull(), "bad_base64")
        .when(~F.is_valid_utf8(decoded.cast("string")), "bad_utf8")
    )
