"""The driver's tables, reshaped on the fly into what the pipeline ingests.

All of it is row-local: a table row becomes a document (and its bronze row)
without a shuffle, however the table is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.schemas import AMOUNT, BRONZE, SILVER_ROW
from rivulet.session import dealt

_REST = "</TransactionId></Transaction></Data>"
_ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TOPIC_NAME = "transactions"
BATCHES = 4
# A session may name here in how many tasks documents are made of tables.
TASKS_SETTING = "spark.rivulet.inputTasks"
# Otherwise a scan of fewer splits than this per core is dealt over so many tasks per core.
TASKS_PER_CORE = 4
ORDER_KINDS = 13
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a table, dealt over tasks if its scan has few splits.

    A small file can hold rows whose documents take all cores: making, writing and parsing
    a document costs far more than moving its row. A scan of many splits stays as it is.
    """
    scan, tasks = table(spark, sf_dir, name).select(*columns), spark.conf.get(TASKS_SETTING, None)
    wanted = int(tasks) if tasks else TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return dealt(scan, wanted if tasks or scan.rdd.getNumPartitions() < wanted else None)


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def event_number(n: int) -> Column:
    return F.pmod(F.col("event_id"), F.lit(n))


def transaction(id_: Column, amount: Column, customer: Column, time: Column, place: Column, result: Column) -> Column:
    return F.struct(
        id_.alias("TransactionId"),
        amount.alias("Amount"),
        customer.alias("CustomerId"),
        time.alias("DateTime"),
        place.alias("Location"),
        result.alias("Result"),
    )


def document(transactions: Column) -> Column:
    return F.to_xml(F.struct(transactions.alias("Transaction")), {"rowTag": "Data"})


def event_document() -> Column:
    """An event's document: one to four transactions, neighbours sharing an id.

    Ids repeat heavily over the table (they come from the user), times move on by
    an hour per position, labels are padded and in mixed case.
    """

    def at_position(i: Column) -> Column:
        return transaction(
            text(F.col("user_id") * 2 + F.floor(i / 2)),
            text(F.col("value").cast(AMOUNT) + i),
            text("event_id"),
            F.date_format(F.col("ts") + F.make_dt_interval(hours=i), _ISO_MICROS),
            F.concat(F.lit("  "), F.initcap("event_type"), F.lit(" ")),
            F.when(event_number(3) == 0, "Failure").otherwise("Success"),
        )

    return document(F.transform(F.sequence(F.lit(0), event_number(BATCHES).cast("int")), at_position))


def enveloped(rows: DataFrame, path: Column, modified: Column, content: Column, *others: str) -> DataFrame:
    """`key` and `value` of the message that would carry `content`, next to `others`."""
    file_row = rows.select(*others, path.alias("path"), modified.alias("modificationTime"), content.alias("content"))
    message = F.struct("path", "modificationTime", F.octet_length("content").cast("long").alias("length"), "content")
    return file_row.select(*others, F.col("path").alias("key"), F.to_json(message).alias("value"))


def pages_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as the binary-file source would deliver them."""
    content = F.encode("html", "UTF-8")
    return spread_table(spark, sf_dir, "pages", "url", "html").select(
        F.col("url").alias("path"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"),
        F.octet_length(content).cast("long").alias("length"),
        content.alias("content"),
    )


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as bronze rows: four topic partitions, one ingest time per hour."""
    events = spread_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    messages = enveloped(
        events,
        F.concat(F.lit("/in/"), text("event_id"), F.lit(".xml")),
        F.col("ts").cast("timestamp"),
        F.encode(event_document(), "UTF-8"),
        "event_id",
        "ts",
    )
    ingested = F.date_trunc("hour", F.col("ts")).cast("timestamp")
    return messages.select(
        "key",
        "value",
        F.lit(TOPIC_NAME).alias("topic"),
        text(event_number(BATCHES)).alias("partition"),
        text(F.floor(F.col("event_id") / BATCHES)).alias("offset"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.lit("0").alias("timestampType"),
        ingested.alias("_raw_insert_timestamp"),
        F.to_date(ingested).alias("_raw_insert_date"),
        F.date_format(ingested, "HH").alias("_raw_insert_hour"),
    ).select(*BRONZE.names)


def order_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bronze rows of which a good half is broken, each in a known way.

    Some hold transactions where the parser does not look: behind the first root, below
    another element, in lower case.
    """
    orders = spread_table(spark, sf_dir, "orders", *ORDER_COLUMNS)
    key = text("o_orderkey")
    kind = F.pmod(F.col("o_orderkey"), F.lit(ORDER_KINDS))
    good = document(
        F.array(
            transaction(
                key,
                text(F.col("o_totalprice").cast(AMOUNT)),
                text("o_custkey"),
                F.date_format("o_orderdate", _ISO_MICROS),
                F.col("o_orderpriority"),
                F.col("o_orderstatus"),
            )
        )
    )
    lower = F.concat(F.lit("<Data><transaction><TransactionId>"), key, F.lit("</TransactionId></transaction></Data>"))
    xml = (
        F.when(kind == 0, F.concat(F.lit("<Data><Transaction><TransactionId>"), key))
        .when(kind == 1, F.lit("<Data/>"))
        .when(kind == 5, F.concat(F.lit("<Data/><Data><Transaction><TransactionId>"), key, F.lit(_REST)))
        .when(kind == 10, F.concat(F.lit("<Data><Transaction/></Data><Data><Transaction><TransactionId>"), key, F.lit(_REST)))
        .when(kind == 11, F.concat(lower, lower))
        .when(kind == 12, F.concat(F.lit("<Data><g><transaction><TransactionId>"), key, F.lit("</TransactionId></transaction></g></Data>")))
        .otherwise(good)
    )
    no_utf8 = F.concat(F.encode(key, "UTF-8"), F.unhex(F.lit("FF")))
    messages = enveloped(
        orders,
        key,
        F.col("o_orderdate").cast("timestamp"),
        F.when(kind == 4, no_utf8).otherwise(F.encode(xml, "UTF-8")),
        "o_orderkey",
        "o_orderdate",
    )
    value = (
        F.when(kind == 2, F.concat(F.lit('{"path":"p","content":"###'), key, F.lit('"}')))
        .when(kind == 3, F.concat(F.lit("no envelope "), key))
        .otherwise(F.col("value"))
    )
    return messages.select(
        "key",
        value.alias("value"),
        F.lit("orders").alias("topic"),
        F.lit("0").alias("partition"),
        key.alias("offset"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.lit("0").alias("timestampType"),
        F.col("o_orderdate").cast("timestamp").alias("_raw_insert_timestamp"),
        F.to_date("o_orderdate").alias("_raw_insert_date"),
        F.date_format("o_orderdate", "HH").alias("_raw_insert_hour"),
    )


def _silver(rows: DataFrame, time: Column, **columns: Column) -> DataFrame:
    """Silver rows straight from a table, without the detour through XML."""
    typed = rows.select(
        columns["id_"].cast("long").alias("TransactionId"),
        columns["amount"].cast(AMOUNT).alias("Amount"),
        columns["customer"].cast("long").alias("CustomerId"),
        time.alias("TransactionDateTime"),
        F.to_date(time).alias("TransactionDate"),
        F.upper(columns["place"]).alias("Location"),
        F.upper(columns["result"]).alias("Status"),
        time.cast("timestamp").alias("_processed_insert_timestamp"),
        time.cast("timestamp").alias("_raw_insert_timestamp"),
        F.lit(0).alias("_batch_id"),
        time.cast("timestamp").alias("_topic_timestamp"),
        F.lit(0).alias("_topic_partition"),
        columns["id_"].cast("long").alias("_topic_offset"),
        F.lit(0).alias("_position"),
    )
    return typed.select(*SILVER_ROW.names)


def order_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders (1995 to 2001) as silver rows, unique by id, dated by the month."""
    return _silver(
        table(spark, sf_dir, "orders"),
        F.date_trunc("month", F.col("o_orderdate")).cast("timestamp_ntz"),
        id_=F.col("o_orderkey"),
        amount=F.col("o_totalprice"),
        customer=F.col("o_custkey"),
        place=F.col("o_orderpriority"),
        result=F.col("o_orderstatus"),
    )


def event_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events (all of 2024) as silver rows, unique by id; every other order is among their ids."""
    return _silver(
        table(spark, sf_dir, "events"),
        F.col("ts"),
        id_=F.col("event_id") * 2,
        amount=F.col("value"),
        customer=F.col("user_id"),
        place=F.col("event_type"),
        result=F.lit("event"),
    )
