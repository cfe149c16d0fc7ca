import pytest
from documents import data, transaction
from helpers import documents
from pyspark.sql import functions as F

from rivulet.__main__ import arguments, main
from rivulet.plans.refine import refine, silver_rows
from rivulet.schemas import FILE_ROW
from rivulet.sinks.catalog_table import CatalogTable
from rivulet.sinks.documents import start_document_files
from rivulet.sinks.silver_log import SilverLog
from rivulet.operators.generate import document_stream
from rivulet.streaming.common import start_console


def test_the_whole_pipeline_from_the_command_line(spark, zones, capfd):
    main(["generate", "--root", zones.root, "--documents", "40"])
    for _ in range(2):
        main(["land", "--root", zones.root, "--drain"])
        main(["bronze", "--root", zones.root, "--drain"])
        main(["silver", "--root", zones.root])
    with pytest.raises(SystemExit, match="--to"):
        main(["compact", "--root", zones.root])
    compacted = f"{zones.silver}-2"
    main(["compact", "--root", zones.root, "--to", compacted])
    main(["replay", "--root", zones.root, "--silver", compacted])
    main(["show", "--root", zones.root, "--silver", compacted])
    silver = SilverLog(spark, compacted).snapshot()
    assert 50 < silver.count() <= 100
    assert spark.read.format("binaryFile").load(zones.landing).count() == 40
    assert "_processed_insert_timestamp" in capfd.readouterr().out


def test_jobs_are_checked():
    with pytest.raises(SystemExit):
        arguments(["unknown", "--root", "x"])
    args = arguments(["silver", "--root", "x", "--table", "c.d.t", "--no-order-guard", "--max-bytes", "1000"])
    assert (args.table, args.no_order_guard, args.max_bytes, args.attempts) == ("c.d.t", True, "1000", None)


def test_document_stream_lands_files(spark, zones):
    stream = document_stream(spark, documents_per_second=5).select("xml")
    query = start_document_files(stream, zones.landing, zones.checkpoint("generate"))
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if (query.lastProgress or {}).get("batchId", 0) >= 2:
                break
    finally:
        query.stop()
    landed = spark.read.format("binaryFile").schema(FILE_ROW).load(zones.landing)
    assert landed.count() > 0
    assert landed.filter(~F.col("content").cast("string").startswith("<?xml")).isEmpty()


def test_console_shows_a_stream(spark, zones):
    spark.range(3).write.parquet(f"{zones.root}/n")
    query = start_console(spark.readStream.schema("id long").parquet(f"{zones.root}/n"))
    query.processAllAvailable()
    progress = query.lastProgress
    query.stop()
    assert "Console" in progress["sink"]["description"]


def test_catalog_table_creates_then_merges(spark):
    """Creation works with any format; MERGE is refused by Parquet, which has none."""
    rows = silver_rows(refine(documents(spark, data(transaction("1")))), 0, F.current_timestamp())
    table = CatalogTable(spark, "silver_by_catalog", provider="parquet")
    spark.sql("DROP TABLE IF EXISTS silver_by_catalog")
    assert not table.exists()
    table.upsert(rows, "q", 0)
    assert table.exists() and table.snapshot().count() == 1
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        table.upsert(rows, "q", 1)
    with pytest.raises(ValueError, match="parquet"):
        table.compact()
    spark.sql("DROP TABLE silver_by_catalog")


def test_fixed_dates_bound_the_merge_by_the_dates_of_the_batch(spark):
    rows = silver_rows(refine(documents(spark, data(transaction("1"), transaction("2")))), 0, F.current_timestamp())
    later = rows.withColumn("TransactionDate", F.date_add("TransactionDate", 1))
    target = rows.unionByName(later).alias("t")
    for fixed_dates, matches in ((False, 4), (True, 2)):
        table = CatalogTable(spark, "c.d.t", fixed_dates=fixed_dates)
        assert rows.alias("source").join(target, table._match(rows)).count() == matches
