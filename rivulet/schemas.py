"""Every schema that crosses a stage boundary, declared once.

Explicit schemas keep streaming reads from inferring anything and make the
partition columns come back with the type declared here, whatever the
directory names look like ("05" stays a two-digit string).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


_STRING = T.StringType()

# One row per landed file, as the binary-file source produces it.
FILE_ROW = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("modificationTime", T.TimestampType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("content", T.BinaryType(), True),
    ]
)

# The JSON message value: a file row with every field as text.
ENVELOPE = _fields(path=_STRING, modificationTime=_STRING, length=_STRING, content=_STRING)

# One message of the topic, every field as text.
TOPIC_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]
TOPIC = T.StructType([T.StructField(name, T.StringType()) for name in TOPIC_COLUMNS])

BRONZE_PARTITIONS = ["_raw_insert_date", "_raw_insert_hour"]
BRONZE = T.StructType(
    TOPIC.fields
    + _fields(
        _raw_insert_timestamp=T.TimestampType(),
        _raw_insert_date=T.DateType(),
        _raw_insert_hour=_STRING,
    ).fields
)

# The document. Fields are text so that one bad value cannot void the whole
# document; types are applied per transaction after the unnest.
CORRUPT = "_corrupt_record"
TRANSACTION = _fields(
    TransactionId=_STRING,
    Amount=_STRING,
    CustomerId=_STRING,
    DateTime=_STRING,
    Location=_STRING,
    Result=_STRING,
)
DOCUMENT = T.StructType(
    [
        T.StructField("Transaction", T.ArrayType(TRANSACTION)),
        T.StructField(CORRUPT, T.StringType()),
    ]
)

# Silver as readers see it.
KEY = "TransactionId"
AMOUNT = T.DecimalType(10, 2)
SILVER_PARTITION = "TransactionDate"
SILVER = _fields(
    TransactionId=T.LongType(),
    Amount=AMOUNT,
    CustomerId=T.LongType(),
    TransactionDateTime=T.TimestampNTZType(),
    TransactionDate=T.DateType(),
    Location=_STRING,
    Status=_STRING,
    _processed_insert_timestamp=T.TimestampType(),
    _raw_insert_timestamp=T.TimestampType(),
    _batch_id=T.IntegerType(),
)

# "Latest" is decided by this tuple, greatest first: when bronze received the
# message, when the topic did, where in the topic it sits, where in its document.
# The topic time goes before the offset because offsets of different topic
# partitions cannot be compared.
ORDER = ["_raw_insert_timestamp", "_topic_timestamp", "_topic_partition", "_topic_offset", "_position"]
ORDER_EXTRA = _fields(
    _topic_timestamp=T.TimestampType(),
    _topic_partition=T.IntegerType(),
    _topic_offset=T.LongType(),
    _position=T.IntegerType(),
)

# Silver as stored: the public columns and the rest of the order tuple.
SILVER_ROW = T.StructType(SILVER.fields + ORDER_EXTRA.fields)

# Dead letters. `_source` and `_batch_id` are directories, so that writing the
# letters of a batch again replaces them.
ERROR_PARTITIONS = ["_error_insert_date", "_error_insert_hour"]
_ERROR_AUDIT = _fields(
    _error_insert_date=T.DateType(),
    _error_insert_hour=_STRING,
    _error_insert_timestamp=T.TimestampType(),
)
_LETTER_ID = _fields(_source=_STRING, _batch_id=T.IntegerType())

MALFORMED = T.StructType(
    BRONZE.fields
    + _fields(
        json_data=ENVELOPE,
        decoded_content=T.BinaryType(),
        xml_content=_STRING,
        parsed=DOCUMENT,
        _corrupt_file=_STRING,
        _reason=_STRING,
    ).fields
    + _ERROR_AUDIT.fields
    + _LETTER_ID.fields
)
REJECTED = T.StructType(
    _fields(
        transaction=TRANSACTION,
        _reason=_STRING,
        key=_STRING,
        topic=_STRING,
        partition=_STRING,
        offset=_STRING,
        _position=T.IntegerType(),
        _raw_insert_timestamp=T.TimestampType(),
    ).fields
    + _ERROR_AUDIT.fields
    + _LETTER_ID.fields
)
FAILED_BATCH = T.StructType(
    BRONZE.fields
    + _fields(error_message=_STRING, _traceback=_STRING).fields
    + _ERROR_AUDIT.fields
    + _LETTER_ID.fields
)
BRONZE_FAILED = T.StructType(
    _fields(xml_data=_STRING, _raw_error_text=_STRING).fields
    + _fields(
        _raw_insert_date=T.DateType(),
        _raw_insert_hour=_STRING,
        _raw_insert_timestamp=T.TimestampType(),
    ).fields
    + _LETTER_ID.fields
)
# What became of a batch (`batch`) or of a run (`ended`, `failed`).
OUTCOME = _fields(
    query_id=_STRING,
    run_id=_STRING,
    name=_STRING,
    event=_STRING,
    batch_id=T.LongType(),
    rows=T.LongType(),
    seconds=T.DoubleType(),
    error=_STRING,
    at=T.TimestampType(),
)
