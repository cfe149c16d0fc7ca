"""One query per operator group, each over whole tables.

Decimals, dates and times leave as text, so that comparing results does not
depend on how a client renders them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.audit import batch_time, with_audit
from rivulet.functions.envelope import decode_envelope, wrap_files
from rivulet.operators.documents import document_class, explode_transactions, parse_documents
from rivulet.operators.generate import MAX_ID, generate_documents
from rivulet.operators.inference import infer_document_schema, schema_of_document, schema_rows
from rivulet.operators.latest import latest_per_key
from rivulet.operators.topic import dedup_offsets, project_topic
from rivulet.operators.transactions import amount_invalid, clean_transactions
from rivulet.operators.upsert import merge_upsert
from rivulet.operators.transactions import is_valid_row
from rivulet.operators.views import latest_bronze, latest_silver, newest_bronze
from rivulet.plans import inputs
from rivulet.plans.inputs import BATCHES, ORDER_COLUMNS, document, enveloped, spread_table, table, text, transaction
from rivulet.plans.refine import batch_counts, refine, silver_rows
from rivulet.schemas import BRONZE_FAILED, BRONZE_PARTITIONS, FAILED_BATCH, KEY, MALFORMED, ORDER, REJECTED
from rivulet.session import work_dir
from rivulet.sinks.bronze import append_bronze
from rivulet.sinks.dead_letters import malformed_letters, rejected_letters, write_letters
from rivulet.sinks.documents import write_document_files
from rivulet.sinks.silver_log import SilverLog
from rivulet.sources.files import read_bronze, read_merged_bronze, read_table, read_transactions, stream_topic_log
from rivulet.sources.records import read_records, record_files
from rivulet.streaming.bronze import start_bronze
from rivulet.streaming.common import DRAIN
from rivulet.streaming.landing import land_records_to_log, land_to_log
from rivulet.streaming.outcomes import OutcomeLog, read_outcomes
from rivulet.streaming.silver import replay_failed_batches, start_silver
from rivulet.streaming.supervise import run_with_restarts
from rivulet.zones import Zones

Query = Callable[[SparkSession, str], DataFrame]
POISONED = 2
UNREACHABLE = "no-such-filesystem://bronze"


def _date(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd").alias(column)


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def _silver_columns(silver: DataFrame, *more: str) -> DataFrame:
    return silver.select(
        KEY,
        text("Amount").alias("Amount"),
        "CustomerId",
        _time("TransactionDateTime"),
        _date("TransactionDate"),
        "Location",
        "Status",
        *more,
    )


def _zones(spark: SparkSession, purpose: str) -> Zones:
    return Zones(work_dir(spark, purpose))


def _processed_at(batch_id: int) -> datetime:
    return datetime(2024, 3, 1, 12, tzinfo=timezone.utc) + timedelta(days=batch_id)


# Envelope, topic, landing


def envelope_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_envelope(wrap_files(inputs.pages_as_files(spark, sf_dir)))
    return decoded.select(
        F.col("key").alias("path"),
        F.col("json_data.length").cast("long").alias("declared_bytes"),
        F.octet_length("decoded_content").cast("long").alias("n_bytes"),
        F.md5("decoded_content").alias("md5"),
    )


def topic_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "events").select(
        F.encode(text("event_id"), "UTF-8").alias("key"),
        F.encode("props", "UTF-8").alias("value"),
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(8)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return project_topic(records)


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _zones(spark, "landing")
    write_document_files(spread_table(spark, sf_dir, "pages", "html"), zones.landing)

    def land():
        return land_to_log(spark, zones.landing, zones.topic_log, "pages", zones.checkpoint("landing"), DRAIN)

    run_with_restarts(land, max_attempts=2)
    run_with_restarts(land, max_attempts=2)  # resumes from its checkpoint, so nothing lands twice
    messages = spark.read.option("recursiveFileLookup", "true").parquet(zones.topic_log)
    return decode_envelope(messages).select(
        (F.col("key") == F.col("json_data.path")).alias("key_is_path"),
        F.octet_length("decoded_content").cast("long").alias("n_bytes"),
        F.md5("decoded_content").alias("md5"),
    )


# Bronze


def bronze_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_audit(table(spark, sf_dir, "events"), "_raw_insert", F.col("ts").cast("timestamp"))
    counts = events.groupBy(*BRONZE_PARTITIONS).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(_date("_raw_insert_date"), "_raw_insert_hour", "n_rows")


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _zones(spark, "bronze")
    project_topic(inputs.event_bronze(spark, sf_dir)).write.parquet(zones.topic_log)
    records = stream_topic_log(spark, zones.topic_log)
    for _ in range(2):  # the second run finds nothing new
        start_bronze(
            records, zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN
        ).awaitTermination()
    bronze = read_bronze(spark, zones.bronze)
    at = F.col("_raw_insert_timestamp")
    consistent = (F.col("_raw_insert_date") == F.to_date(at)) & (F.col("_raw_insert_hour") == F.date_format(at, "HH"))
    return bronze.select("key", "topic", "partition", "offset", "timestamp", consistent.alias("audit_consistent"))


def bronze_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _zones(spark, "bronze-failed")
    project_topic(inputs.event_bronze(spark, sf_dir)).write.parquet(zones.topic_log)
    records = stream_topic_log(spark, zones.topic_log)
    start_bronze(records, UNREACHABLE, zones.bronze_failed, zones.checkpoint("raw"), DRAIN).awaitTermination()
    letters = read_table(spark, zones.bronze_failed, BRONZE_FAILED)
    return letters.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.md5("xml_data")).alias("n_payloads"),
        F.count_if(F.contains("_raw_error_text", F.lit("no-such-filesystem"))).alias("n_explained"),
    )


def _messages(bronze: DataFrame) -> DataFrame:
    return bronze.select("key", "partition", "offset")


def empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which nothing is left counts as done: only messages that come later arrive."""
    zones = _zones(spark, "empty-batch")
    messages = project_topic(inputs.event_bronze(spark, sf_dir))
    messages.write.parquet(zones.topic_log)
    records = stream_topic_log(spark, zones.topic_log)
    for wanted in (records.filter(F.length("topic") == 0), records):
        start_bronze(wanted, zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN).awaitTermination()
    messages.write.mode("append").parquet(zones.topic_log)
    start_bronze(records, zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN).awaitTermination()
    return _messages(read_bronze(spark, zones.bronze))


def _running_bronze(spark: SparkSession, sf_dir: str, purpose: str, trigger: dict | None) -> DataFrame:
    """Bronze of a query that goes on running while more messages come."""
    zones = _zones(spark, purpose)
    messages = project_topic(inputs.event_bronze(spark, sf_dir))
    early = F.col("partition").isin("0", "1")
    messages.filter(early).write.parquet(zones.topic_log)
    records = stream_topic_log(spark, zones.topic_log)
    query = start_bronze(records, zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), trigger)
    try:
        query.processAllAvailable()
        messages.filter(~early).write.mode("append").parquet(zones.topic_log)
        query.processAllAvailable()
    finally:
        query.stop()
    return _messages(read_bronze(spark, zones.bronze))


def interval_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running_bronze(spark, sf_dir, "interval", {"processingTime": "1 second"})


def default_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _running_bronze(spark, sf_dir, "default-trigger", None)


def restarted_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query that can write neither bronze nor letters fails; the next attempt takes up its batch."""
    zones = _zones(spark, "restarted")
    project_topic(inputs.event_bronze(spark, sf_dir)).write.parquet(zones.topic_log)
    targets = [(UNREACHABLE, UNREACHABLE), (zones.bronze, zones.bronze_failed)]

    def start():
        bronze, failed = targets.pop(0)
        return start_bronze(stream_topic_log(spark, zones.topic_log), bronze, failed, zones.checkpoint("raw"), DRAIN)

    outcome = run_with_restarts(start, max_attempts=3, backoff_seconds=0)
    return _messages(read_bronze(spark, zones.bronze)).withColumn("attempts", F.lit(outcome.attempts))


def merged_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second with one more column."""
    zones = _zones(spark, "merged")
    messages = project_topic(inputs.event_bronze(spark, sf_dir))
    early = F.col("partition").isin("0", "1")
    grown = messages.filter(~early).withColumn("headers", F.concat(F.lit("h"), "offset"))
    append_bronze(messages.filter(early), zones.bronze, batch_time(_processed_at(0)))
    append_bronze(grown, zones.bronze, batch_time(_processed_at(1)))
    bronze = read_merged_bronze(spark, zones.bronze)
    return bronze.select("key", "partition", "offset", "headers", _date("_raw_insert_date"))


def bronze_dedup_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = inputs.event_bronze(spark, sf_dir)
    next_day = F.col("_raw_insert_timestamp") + F.make_dt_interval(F.lit(1))
    appended_again = bronze.withColumn("_raw_insert_timestamp", next_day)
    once = dedup_offsets(bronze.unionByName(appended_again))
    return once.select("topic", "partition", "offset", "key", _time("_raw_insert_timestamp"))


def latest20_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_bronze(inputs.event_bronze(spark, sf_dir))
    return newest.select("key", "partition", "offset", _time("_raw_insert_timestamp"))


# Documents


def _parsed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(decode_envelope(inputs.order_bronze(spark, sf_dir)))


def document_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = _parsed_orders(spark, sf_dir).select(
        document_class().alias("class"), F.coalesce("_doc_reason", F.lit("none")).alias("reason")
    )
    return classes.groupBy("class", "reason").agg(F.count(F.lit(1)).alias("n_documents"))


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _zones(spark, "malformed")
    refined = refine(inputs.order_bronze(spark, sf_dir)).persist()
    write_letters(malformed_letters(refined), zones.malformed, "orders", 0, batch_time())
    refined.unpersist()
    letters = read_table(spark, zones.malformed, MALFORMED)
    # A payload that is no text stays in its envelope.
    content = F.get_json_object("_corrupt_file", "$.content")
    shown = F.when(F.col("_reason") == "bad_utf8", content).otherwise(F.col("_corrupt_file"))
    return letters.select("key", "_reason", shown.alias("corrupt_text"))


def counted_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_counts(refine(inputs.order_bronze(spark, sf_dir)))


def flatten_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_documents(decode_envelope(inputs.event_bronze(spark, sf_dir)))
    return explode_transactions(parsed.select("key", "parsed")).select(
        "key", F.col("_position").cast("long").alias("position"), "_transaction.*"
    )


def generated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    seeds = spread_table(spark, sf_dir, "orders", "o_orderkey")
    documents = generate_documents(seeds, seed="o_orderkey", at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    parsed = parse_documents(documents.select("o_orderkey", "xml"), "xml")
    found = F.col("parsed.Transaction")

    def all_of(check: Callable[[Column], Column]) -> Column:
        return F.forall(found, check)

    return parsed.select(
        "o_orderkey",
        F.size(found).between(3, 5).alias("size_ok"),
        all_of(lambda t: t.TransactionId.cast("int").between(1, MAX_ID)).alias("ids_ok"),
        all_of(lambda t: t.CustomerId.cast("int").between(1, MAX_ID)).alias("customers_ok"),
        all_of(lambda t: t.Amount.cast("decimal(10,2)").between(0, 1000)).alias("amounts_ok"),
        all_of(lambda t: t.Location.isin("New York", "London", "Tokyo", "Sydney", "Paris")).alias("locations_ok"),
        all_of(lambda t: t.Result.isin("Success", "Failure")).alias("results_ok"),
        all_of(lambda t: t.DateTime == "2024-01-01T00:00:00").alias("times_ok"),
    )


def schema_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = text("c_custkey")
    documents = spread_table(spark, sf_dir, "customer", "c_custkey", "c_acctbal", "c_mktsegment", "c_name").select(
        document(
            F.transform(
                F.sequence(F.lit(0), F.pmod("c_custkey", F.lit(2)).cast("int")),
                lambda i: transaction(
                    F.when(F.col("c_custkey") == 0, "C-0").otherwise(key),
                    text(F.col("c_acctbal").cast("decimal(10,2)")),
                    key,
                    F.lit("2024-01-31T04:08:41"),
                    F.col("c_mktsegment"),
                    F.col("c_name"),
                ),
            )
        ).alias("xml")
    )
    inferred = infer_document_schema(documents, rowTag="Data")
    return spark.createDataFrame(schema_rows(inferred), "field string, type string")


def literal_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents read with the schema of one of them, that of the smallest key."""
    key = F.col("o_orderkey")
    documents = spread_table(spark, sf_dir, "orders", *ORDER_COLUMNS).select(
        "o_orderkey",
        document(
            F.transform(
                F.sequence(F.lit(0), F.lit(1)),
                lambda i: transaction(
                    text(key * 2 + i),
                    text(F.col("o_totalprice").cast("decimal(10,2)")),
                    text("o_custkey"),
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
                    F.col("o_orderpriority"),
                    F.col("o_orderstatus"),
                ),
            )
        ).alias("xml"),
    )
    sample = documents.orderBy("o_orderkey").select("xml").first().xml
    found = F.from_xml("xml", schema_of_document(spark, sample))
    rows = documents.select("o_orderkey", F.explode_outer(found.getField("Transaction")).alias("row"))
    return rows.select(
        "o_orderkey",
        F.col("row.TransactionId").alias("id"),
        text(F.col("row.Amount").cast("decimal(10,2)")).alias("amount"),
        F.col("row.CustomerId").alias("customer"),
        F.col("row.Location").alias("place"),
        F.typeof("row.DateTime").alias("time_type"),
    )


def large_document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "large")
    orders = spread_table(spark, sf_dir, "orders", *ORDER_COLUMNS).select(
        text("o_orderkey").alias("TransactionId"),
        text(F.col("o_totalprice").cast("decimal(10,2)")).alias("Amount"),
        text("o_custkey").alias("CustomerId"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("DateTime"),
        F.col("o_orderpriority").alias("Location"),
        F.col("o_orderstatus").alias("Result"),
    )
    orders.write.format("xml").options(rootTag="Data", rowTag="Transaction").save(folder)
    rows = read_transactions(spark, folder)
    return rows.withColumn("corrupt", F.col("_corrupt_record").isNotNull()).drop("_corrupt_record")


# Cleaning


def clean_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(10,2)")
    kind = F.pmod("o_orderkey", F.lit(5))
    raw = (
        F.when(kind == 0, F.concat(text(F.floor(price)), F.lit(",5")))
        .when(kind == 1, F.concat(F.lit("9"), F.lpad(text("o_orderkey"), 12, "0"), F.lit(".99")))
        .when(kind == 2, F.lit("  "))
        .when(kind == 3, F.concat(text(price), F.lit("5")))
        .otherwise(text(price))
    )
    key, no_time = text("o_orderkey"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.lit(0).alias("_position"),
        transaction(key, raw, text("o_custkey"), no_time, F.lit("x"), F.lit("y")).alias("_transaction"),
    )
    flagged = rows.withColumn("invalid", amount_invalid(F.col("_transaction.Amount")))
    return clean_transactions(flagged).select("o_orderkey", text("Amount").alias("amount"), "invalid")


def clean_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.lit(0).alias("_position"),
        transaction(
            text("event_id"),
            text("value"),
            text("user_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            F.concat(F.lit("   "), F.initcap("event_type"), F.lit("  ")),
            F.concat(F.initcap("event_type"), F.lit(" / "), F.lit("Ok ")),
        ).alias("_transaction"),
    )
    return clean_transactions(rows).select(
        "event_id", F.col("Location").alias("location"), F.col("Status").alias("status"),
        _date("TransactionDate"), _time("TransactionDateTime"),
    )


def _spoilt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two transactions per order, the first one with a fault that depends on its key."""
    key, kind = text("o_orderkey"), F.pmod("o_orderkey", F.lit(6))

    def one(i: Column) -> Column:
        fault = F.when(i == 0, kind)
        return transaction(
            F.when(fault == 1, "abc").when(fault == 2, F.lit(None)).when(fault == 3, " ").otherwise(key),
            text(F.col("o_totalprice").cast("decimal(10,2)")),
            F.when(fault == 4, "1.5").otherwise(text("o_custkey")),
            F.when(fault == 5, "not-a-date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")),
            F.col("o_orderpriority"),
            F.col("o_orderstatus"),
        )

    messages = enveloped(
        spread_table(spark, sf_dir, "orders", *ORDER_COLUMNS),
        key,
        F.col("o_orderdate").cast("timestamp"),
        F.encode(document(F.transform(F.sequence(F.lit(0), F.lit(1)), one)), "UTF-8"),
        "o_orderkey",
        "o_orderdate",
    )
    return messages.select(
        "key",
        "value",
        F.lit("orders").alias("topic"),
        F.lit("0").alias("partition"),
        key.alias("offset"),
        F.lit("2024-01-01 00:00:00").alias("timestamp"),
        F.lit("0").alias("timestampType"),
        F.col("o_orderdate").cast("timestamp").alias("_raw_insert_timestamp"),
        F.to_date("o_orderdate").alias("_raw_insert_date"),
        F.lit("00").alias("_raw_insert_hour"),
    )


def reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = rejected_letters(refine(_spoilt_orders(spark, sf_dir)))
    return letters.select(
        "key",
        "offset",
        F.col("_position").cast("long").alias("position"),
        "_reason",
        F.col("transaction.CustomerId").alias("raw_customer"),
        F.col("transaction.DateTime").alias("raw_time"),
    )


def clean_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What silver gets from documents with a rejected transaction: all the others."""
    return _silver_columns(silver_rows(refine(_spoilt_orders(spark, sf_dir)), 0, batch_time()))


# Latest per key, upsert


def latest_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    refined = refine(inputs.event_bronze(spark, sf_dir))
    return _silver_columns(silver_rows(refined, 0, batch_time()))


def latest_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", _time("ts"))


def merge_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, source = inputs.order_silver(spark, sf_dir), inputs.event_silver(spark, sf_dir)
    return _silver_columns(merge_upsert(target, source, KEY))


def merge_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL matches nothing: such rows of both sides stay."""

    def without_some_keys(rows: DataFrame) -> DataFrame:
        return rows.withColumn(KEY, F.when(F.pmod(KEY, F.lit(6)) != 0, F.col(KEY)))

    target = without_some_keys(inputs.order_silver(spark, sf_dir))
    source = without_some_keys(inputs.event_silver(spark, sf_dir))
    return _silver_columns(merge_upsert(target, source, KEY, ORDER))


def _log_of(spark: SparkSession, purpose: str, batches: list[DataFrame], order_guard: bool = True) -> SilverLog:
    log = SilverLog(spark, _zones(spark, purpose).silver, order_guard)
    for batch_id, rows in enumerate(batches):
        at = batch_time(_processed_at(batch_id))
        log.upsert(rows.withColumn("_processed_insert_timestamp", at), purpose, batch_id)
    return log


def merge_order_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    newer, older = inputs.event_silver(spark, sf_dir), inputs.order_silver(spark, sf_dir)
    return _silver_columns(_log_of(spark, "guarded", [newer, older]).snapshot())


def merge_last_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    newer, older = inputs.event_silver(spark, sf_dir), inputs.order_silver(spark, sf_dir)
    return _silver_columns(_log_of(spark, "unguarded", [newer, older], order_guard=False).snapshot())


def merge_partition_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = inputs.order_silver(spark, sf_dir), inputs.event_silver(spark, sf_dir)
    moved = _log_of(spark, "moved", [before, after]).snapshot()
    return moved.groupBy("TransactionDate").agg(F.count(F.lit(1)).alias("n_rows")).select(
        _date("TransactionDate"), "n_rows"
    )


def _event_batch(spark: SparkSession, sf_dir: str, batch_id: int) -> DataFrame:
    """The events of one topic partition, so every batch spans the whole month."""
    bronze = inputs.event_bronze(spark, sf_dir)
    return bronze.filter(F.col("partition") == str(batch_id))


def _fold(spark: SparkSession, sf_dir: str, purpose: str, compact_after: tuple[int, ...] = ()) -> SilverLog:
    log = SilverLog(spark, _zones(spark, purpose).silver)
    for batch_id in range(BATCHES):
        refined = refine(_event_batch(spark, sf_dir, batch_id))
        log.upsert(silver_rows(refined, batch_id, batch_time(_processed_at(batch_id))), purpose, batch_id)
        if batch_id in compact_after:
            log = log.compact(f"{log.root}-compacted")
    return log


def fold_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_columns(_fold(spark, sf_dir, "fold").snapshot(), "_batch_id")


def fold_onto_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_columns(_fold(spark, sf_dir, "fold-base", compact_after=(1,)).snapshot(), "_batch_id")


def fold_onto_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A base that is bucketed by id after two batches, and two more batches on top of it."""
    log = SilverLog(spark, _zones(spark, "fold-buckets").silver)
    for batch_id in range(BATCHES):
        refined = refine(_event_batch(spark, sf_dir, batch_id))
        log.upsert(silver_rows(refined, batch_id, batch_time(_processed_at(batch_id))), "fold", batch_id)
        if batch_id == 1:
            log = log.compact_to_table(f"{log.root}-buckets", f"silver_{uuid.uuid4().hex}", 16)
    return _silver_columns(log.snapshot(), "_batch_id")


def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_columns(_fold(spark, sf_dir, "compacted", compact_after=(1, 3)).snapshot(), "_batch_id")


def latest20_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_silver(_fold(spark, sf_dir, "latest").snapshot()).withColumn("Amount", F.round("Amount", 2))
    return _silver_columns(newest, "_batch_id", F.unix_seconds("_processed_insert_timestamp").alias("processed_at"))


# Streaming


def _drain_batches(spark: SparkSession, sf_dir: str, zones: Zones, **job) -> SilverLog:
    """Four times: more messages reach bronze, the silver job drains them."""
    log = SilverLog(spark, zones.silver)
    for batch_id in range(BATCHES):
        arrived = project_topic(_event_batch(spark, sf_dir, batch_id))
        append_bronze(arrived, zones.bronze, batch_time(_processed_at(batch_id)))
        run_with_restarts(lambda: start_silver(spark, zones, log, at=_processed_at, **job), max_attempts=3)
    return log


def _refine_poisoned(bronze: DataFrame) -> DataFrame:
    poison = F.raise_error(F.lit("poisoned")).cast("string")
    value = F.when(F.col("partition") == str(POISONED), poison).otherwise(F.col("value"))
    return refine(bronze.withColumn("value", value))


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _drain_batches(spark, sf_dir, _zones(spark, "silver"))
    return _silver_columns(log.snapshot(), "_batch_id")


def stream_failed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _zones(spark, "failed")
    log = _drain_batches(spark, sf_dir, zones, refine_rows=_refine_poisoned)
    failed = read_table(spark, zones.failed_batches, FAILED_BATCH)
    explained = F.contains("error_message", F.lit("poisoned")) & F.contains("_traceback", F.lit("poisoned"))
    counts = [
        failed.groupBy("_batch_id").agg(F.count_if(explained).alias("n_rows")).withColumn("zone", F.lit("failed")),
        log.snapshot().groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("zone", F.lit("silver")),
    ]
    return counts[0].unionByName(counts[1]).select("zone", F.col("_batch_id").cast("long").alias("batch_id"), "n_rows")


def dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _zones(spark, "replay")
    log = _drain_batches(spark, sf_dir, zones, refine_rows=_refine_poisoned)
    for _ in range(2):  # the second replay changes nothing
        replay_failed_batches(spark, zones, log, F.col("_batch_id") == POISONED)
    return _silver_columns(log.snapshot(), "_batch_id")


def end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, topic, bronze, silver: the three jobs one after the other."""
    zones = _zones(spark, "end-to-end")
    key = text("s_suppkey")
    documents = spread_table(spark, sf_dir, "supplier", "s_suppkey", "s_acctbal", "s_name").select(
        document(
            F.transform(
                F.sequence(F.lit(0), F.lit(2)),
                lambda i: transaction(
                    text(F.col("s_suppkey") * 2 + F.floor(i / 2)),
                    text(F.col("s_acctbal").cast("decimal(10,2)") + i),
                    key,
                    F.lit("2024-01-31T04:08:41"),
                    F.col("s_name"),
                    F.lit("Success"),
                ),
            )
        ).alias("xml"),
    )
    write_document_files(documents, zones.landing)
    land_to_log(
        spark, zones.landing, zones.topic_log, "suppliers", zones.checkpoint("landing"), DRAIN
    ).awaitTermination()
    start_bronze(
        stream_topic_log(spark, zones.topic_log), zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN
    ).awaitTermination()
    log = SilverLog(spark, zones.silver)
    start_silver(spark, zones, log).awaitTermination()
    return _silver_columns(log.snapshot())


# What goes wrong on the way


def stream_repeated_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message is appended to bronze twice, and each time a new run of the silver job drains it."""
    zones = _zones(spark, "repeated")
    log, documents = SilverLog(spark, zones.silver), []
    messages = project_topic(inputs.order_bronze(spark, sf_dir))

    def run():
        count = lambda _, counts: documents.append(counts.documents)
        return start_silver(spark, zones, log, once_within="7 days", report=count)

    for batch_id in range(2):
        append_bronze(messages, zones.bronze, batch_time(_processed_at(batch_id)))
        run_with_restarts(run, max_attempts=3)
    columns = ["zone", "reason", "n_rows"]

    def letters(path: str, schema, zone: str) -> DataFrame:
        counts = read_table(spark, path, schema).groupBy(F.col("_reason").alias("reason"))
        return counts.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("zone", F.lit(zone)).select(*columns)

    silver = log.snapshot().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("silver"), F.lit("none"), "n_rows")
    counted = spark.createDataFrame([("counted", "none", sum(documents))], "zone string, reason string, n_rows long")
    malformed, rejected = letters(zones.malformed, MALFORMED, "malformed"), letters(zones.rejected, REJECTED, "rejected")
    return malformed.unionByName(rejected).union(silver).union(counted)


def _refine_few_poisoned(bronze: DataFrame) -> DataFrame:
    """One message in 20,000 cannot be refined."""
    event = F.col("offset").cast("long") * BATCHES + F.col("partition").cast("long")
    poison = F.raise_error(F.concat(F.lit("poisoned "), "key")).cast("string")
    return refine(bronze.withColumn("value", F.when(F.pmod(event, F.lit(20_000)) == 3, poison).otherwise(F.col("value"))))


def stream_isolated_poison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in which single messages fail: these alone are letters, silver has all others."""
    zones = _zones(spark, "isolated")
    log = _drain_batches(spark, sf_dir, zones, refine_rows=_refine_few_poisoned, max_probes=500)
    failed = read_table(spark, zones.failed_batches, FAILED_BATCH)
    explained = F.contains("error_message", F.lit("poisoned"))
    counts = log.snapshot().groupBy("_batch_id").agg(F.count(F.lit(1)).alias("n_rows"))
    columns = ["zone", F.col("_batch_id").cast("long").alias("batch_id"), "key", "n_rows"]
    silver = counts.withColumns({"zone": F.lit("silver"), "key": F.lit("")}).select(*columns)
    bad = failed.groupBy("_batch_id", "key").agg(F.count_if(explained).alias("n_rows")).withColumn("zone", F.lit("failed"))
    return silver.unionByName(bad.select(*columns))


def latest20_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest messages of a bronze folder with a date folder for each day, without a look at older ones."""
    zones = _zones(spark, "newest")
    at = F.date_trunc("day", F.col("_raw_insert_timestamp"))
    bronze = inputs.event_bronze(spark, sf_dir).drop(*BRONZE_PARTITIONS).withColumn("_raw_insert_timestamp", at)
    daily = with_audit(bronze, "_raw_insert", F.col("_raw_insert_timestamp"))
    daily.repartition(*BRONZE_PARTITIONS).write.partitionBy(*BRONZE_PARTITIONS).parquet(zones.bronze)
    newest = newest_bronze(spark, zones.bronze)
    return newest.select("key", "partition", "offset", _time("_raw_insert_timestamp"))


RECORD_KINDS = 7


def _order_files(spark: SparkSession, sf_dir: str, directory: str) -> None:
    """Orders as XML files of very many roots, some written in ways that need care."""
    key, kind = text("o_orderkey"), F.pmod("o_orderkey", F.lit(RECORD_KINDS))

    def element(opening: str = "<Transaction>", place: Column = F.col("o_orderpriority")) -> Column:
        parts = [
            F.lit(f"{opening}<TransactionId>"), key, F.lit("</TransactionId><Amount>"),
            text(F.col("o_totalprice").cast("decimal(10,2)")), F.lit("</Amount><CustomerId>"), text("o_custkey"),
            F.lit("</CustomerId><DateTime>"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
            F.lit("</DateTime><Location>"), place, F.lit("</Location><Result>Success</Result></Transaction>"),
        ]
        return F.concat(*parts)

    quoted = F.concat(F.lit("<![CDATA["), F.col("o_orderpriority"), F.lit("]]>"))
    root = lambda *inner: F.concat(F.lit("<Data>"), *inner, F.lit("</Data>"))
    xml = (
        F.when(kind == 1, root(element(), F.lit("<!-- and -->"), F.regexp_replace(element(), "<TransactionId>", "<TransactionId>-")))
        .when(kind == 2, root(F.lit("<Transaction/>")))
        .when(kind == 3, root(element(place=quoted)))
        .when(kind == 4, root(F.lit("<!-- "), element(), F.lit(" -->"), element()))
        .when(kind == 5, root(element('<Transaction no="1">')))
        .when(kind == 6, root(element("<Transaction\t>")))
        .otherwise(root(element()))
    )
    table(spark, sf_dir, "orders").select(xml.alias("value")).write.text(directory)


def _records_read(valid: DataFrame, malformed: DataFrame) -> DataFrame:
    """Transactions, and how many opening tags lie in documents that are letters."""
    rows = valid.select(
        "TransactionId", text("Amount").alias("Amount"), "CustomerId", "Location", F.lit(0).cast("long").alias("n_tags")
    )
    tags = malformed.agg(F.sum(F.regexp_count("_corrupt_file", F.lit("<Transaction(?=[\\s/>])"))).cast("long").alias("n_tags"))
    none = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns[:-1]]
    return rows.unionByName(tags.select(*none, "n_tags"))


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of many roots, each file read by several tasks, a transaction at a time."""
    zones = _zones(spark, "split")
    _order_files(spark, sf_dir, zones.landing)
    none = [F.lit(None).cast("string").alias(c) for c in ("topic", "partition", "offset", "timestamp", "timestampType")]
    messages = wrap_files(record_files(read_records(spark, zones.landing))).select("key", "value", *none)
    refined = refine(with_audit(messages, "_raw_insert", batch_time(_processed_at(0)))).persist()
    write_letters(malformed_letters(refined), zones.malformed, "split", 0, batch_time())
    result = _records_read(refined.filter(is_valid_row()), read_table(spark, zones.malformed, MALFORMED))
    return result


def stream_split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through all three jobs."""
    zones = _zones(spark, "stream-split")
    _order_files(spark, sf_dir, zones.landing)
    land_records_to_log(spark, zones.landing, zones.topic_log, "orders", zones.checkpoint("landing"), DRAIN).awaitTermination()
    start_bronze(
        stream_topic_log(spark, zones.topic_log), zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN
    ).awaitTermination()
    log = SilverLog(spark, zones.silver)
    start_silver(spark, zones, log).awaitTermination()
    return _records_read(log.snapshot(), read_table(spark, zones.malformed, MALFORMED))


def batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the outcome table says of a run that fails, and of the one that takes up its batch."""
    zones = _zones(spark, "outcomes")
    project_topic(inputs.event_bronze(spark, sf_dir)).write.parquet(zones.topic_log)
    targets, queries = [(UNREACHABLE, UNREACHABLE), (zones.bronze, zones.bronze_failed)], []

    def start():
        bronze, failed = targets.pop(0)
        records = stream_topic_log(spark, zones.topic_log)
        queries.append(start_bronze(records, bronze, failed, zones.checkpoint("raw"), DRAIN))
        return queries[-1]

    with OutcomeLog(spark, zones.outcomes) as outcomes:
        run_with_restarts(start, max_attempts=3, backoff_seconds=0)
        settled = all([outcomes.settled(query) for query in queries])
    rows = read_outcomes(spark, zones.outcomes).filter(F.col("query_id") == str(queries[0].id))
    run = F.when(F.col("run_id") == str(queries[0].runId), 1).otherwise(2)
    explained = F.contains("error", F.lit("no-such-filesystem"))
    return rows.select(
        run.alias("run"), "event", "batch_id", (F.col("rows") > 0).alias("read"), (F.col("seconds") >= 0).alias("timed"),
        explained.alias("explained"), F.lit(settled).alias("settled"),
    )


QUERIES: dict[str, Query] = {
    "envelope_roundtrip": envelope_roundtrip,
    "topic_projection": topic_projection,
    "stream_landing": stream_landing,
    "bronze_partitions": bronze_partitions,
    "stream_bronze": stream_bronze,
    "bronze_failed_batch": bronze_failed_batch,
    "empty_batch": empty_batch,
    "interval_trigger": interval_trigger,
    "default_trigger": default_trigger,
    "restarted_stream": restarted_stream,
    "merged_bronze": merged_bronze,
    "bronze_dedup_offsets": bronze_dedup_offsets,
    "document_classes": document_classes,
    "malformed_rows": malformed_rows,
    "batch_counts": counted_batch,
    "flatten_transactions": flatten_transactions,
    "clean_amounts": clean_amounts,
    "clean_labels": clean_labels,
    "reject_rows": reject_rows,
    "clean_siblings": clean_siblings,
    "latest_per_key": latest_transactions,
    "latest_by_user": latest_by_user,
    "merge_upsert": merge_replace,
    "merge_null_keys": merge_null_keys,
    "merge_order_guard": merge_order_guard,
    "merge_last_processed": merge_last_processed,
    "merge_partition_move": merge_partition_move,
    "fold_batches": fold_batches,
    "fold_onto_base": fold_onto_base,
    "fold_onto_buckets": fold_onto_buckets,
    "compacted_silver": compacted_silver,
    "stream_silver": stream_silver,
    "stream_failed_batch": stream_failed_batch,
    "dlq_replay": dlq_replay,
    "end_to_end": end_to_end,
    "latest20_bronze": latest20_bronze,
    "latest20_silver": latest20_silver,
    "schema_inference": schema_inference,
    "literal_schema": literal_schema,
    "generate_documents": generated_documents,
    "large_document_rows": large_document_rows,
    "stream_repeated_messages": stream_repeated_messages,
    "stream_isolated_poison": stream_isolated_poison,
    "latest20_partitions": latest20_partitions,
    "split_documents": split_documents,
    "stream_split_documents": stream_split_documents,
    "batch_outcomes": batch_outcomes,
}
