from datetime import datetime, timezone

import pytest
from documents import SAMPLE, data, transaction
from helpers import bronze, message
from pyspark.sql import functions as F

from rivulet.functions.audit import batch_time, with_audit
from rivulet.operators.documents import parse_documents
from rivulet.operators.generate import generate_documents
from rivulet.operators.inference import infer_document_schema, schema_of_document, schema_rows
from rivulet.operators.topic import dedup_offsets
from rivulet.operators.views import latest_bronze, latest_rows
from rivulet.session import work_dir


def test_audit_columns_come_from_one_instant(spark):
    late = batch_time(datetime(2024, 1, 31, 23, 59, 59, 999999, tzinfo=timezone.utc))
    row = with_audit(spark.range(1), "_raw_insert", late).select(
        F.col("_raw_insert_date").cast("string"), "_raw_insert_hour", F.col("_raw_insert_timestamp").cast("string")
    ).first()
    assert tuple(row) == ("2024-01-31", "23", "2024-01-31 23:59:59.999999")
    assert "_error_insert_hour" in with_audit(spark.range(1), "_error_insert").columns


def test_latest_rows_is_a_bounded_top_n(spark):
    df = spark.range(1000).withColumn("t", F.floor(F.col("id") / 7))
    top = latest_rows(df, "t", ["id"])
    assert [r.id for r in top.collect()] == list(range(999, 979, -1))
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_latest_bronze_orders_offsets_as_numbers(spark):
    rows = bronze(spark, [message("x", offset) for offset in (9, 10, 100)])
    assert [r.offset for r in latest_bronze(rows, 2).collect()] == ["100", "10"]


def test_dedup_offsets_keeps_the_last_copy(spark):
    first = bronze(spark, [message("x", 1), message("y", 2)])
    again = bronze(spark, [message("x", 1)], datetime(2024, 2, 1, tzinfo=timezone.utc))
    rows = dedup_offsets(first.unionByName(again)).orderBy("offset").collect()
    assert [(r.offset, r._raw_insert_timestamp.month) for r in rows] == [("1", 2), ("2", 1)]


def test_generated_documents_are_valid_and_repeatable(spark):
    documents = generate_documents(spark.range(500), at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    parsed = parse_documents(documents, "xml")
    assert parsed.filter(F.col("_doc_reason").isNotNull()).isEmpty()
    sizes = {r[0] for r in parsed.select(F.size("parsed.Transaction")).distinct().collect()}
    assert sizes == {3, 4, 5}
    fields = parsed.select(F.explode("parsed.Transaction").alias("t")).select("t.*")
    spread = fields.agg(
        F.min(F.col("TransactionId").cast("int")),
        F.max(F.col("TransactionId").cast("int")),
        F.count_distinct("Location"),
        F.count_distinct("Result"),
    ).first()
    assert tuple(spread) == (1, 100, 5, 2)
    other = documents.repartition(7).select("id", "xml")
    assert documents.select("id", "xml").exceptAll(other).isEmpty()
    salted = generate_documents(spark.range(500), salt=1)
    assert salted.select("xml").first() != documents.select("xml").first()


def test_document_schema_is_merged_over_documents(spark):
    texts = spark.createDataFrame([(data(transaction("1")),), (SAMPLE,), (None,)], "xml string")
    fields = dict(schema_rows(infer_document_schema(texts, rowTag="Data")))
    assert fields["Transaction[].TransactionId"] == "bigint" and fields["Transaction[].Location"] == "string"
    widened = texts.union(spark.createDataFrame([(data(transaction("abc")),)], "xml string"))
    fields = dict(schema_rows(infer_document_schema(widened, rowTag="Data")))
    assert fields["Transaction[].TransactionId"] == "string"
    with pytest.raises(ValueError, match="one column"):
        infer_document_schema(texts.withColumn("more", F.lit(1)))


def test_schema_of_one_document(spark):
    ddl = schema_of_document(spark, data(transaction("1")))
    assert "Transaction: STRUCT<" in ddl and "TransactionId: BIGINT" in ddl


def test_work_dirs_are_new_and_shared(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(shared)
