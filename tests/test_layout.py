"""How silver lies on disk: clusters that let a filter skip files, buckets that spare a shuffle."""

import glob
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_upsert import content, frame, row

from rivulet.functions.morton import BITS, morton, place
from rivulet.operators.upsert import merge_joined, merge_upsert
from rivulet.schemas import KEY, ORDER
from rivulet.sinks.silver_log import SilverLog


def test_morton_takes_the_bits_in_turn(spark):
    def interleaved(a, b):
        return sum(((a >> i & 1) << (2 * i + 1)) | ((b >> i & 1) << (2 * i)) for i in range(BITS))

    pairs = [(0, 0), (1, 0), (0, 1), (65535, 65535), (65535, 0), (0, 65535), (43690, 21845), (12345, 54321)]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("m", morton(F.col("a"), F.col("b")))
    assert [r.m for r in df.collect()] == [interleaved(a, b) for a, b in pairs]


def test_place_has_an_answer_for_every_number(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.0,), (50.0,), (100.0,), (900.0,)], "x double")
    of = lambda low, high: [r.p for r in df.select(place(F.col("x"), F.lit(low), F.lit(high)).alias("p")).collect()]
    assert of(0.0, 100.0) == [0, 0, 0, 32767, 65535, 65535]
    assert of(3.0, 3.0) == [0] * 6 and of(None, None) == [0] * 6


def overlapping(folder, column, low, high):
    """(row groups that a filter must read, all row groups)."""
    hit = total = 0
    for path in glob.glob(f"{folder}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(names.index(column)).statistics
            total += 1
            hit += float_of(stats.min) <= high and float_of(stats.max) >= low
    return hit, total


def float_of(value):
    return value.timestamp() if isinstance(value, datetime) else float(value)


def test_clustering_skips_files_by_amount_and_by_time(spark, tmp_path):
    log = SilverLog(spark, str(tmp_path / "silver"))
    rows = spark.range(60_000).select(
        F.col("id").alias("TransactionId"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 100).cast("decimal(10,2)").alias("Amount"),
        F.timestamp_seconds(F.lit(1_706_659_200) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(86_400))).alias("at"),
    )
    template = frame(spark, [row(1, 1)])
    day = rows.withColumn("TransactionDateTime", F.col("at").cast("timestamp_ntz")).withColumn("TransactionDate", F.to_date("TransactionDateTime"))
    filled = [F.col(c) if c in day.columns else F.lit(None).cast(template.schema[c].dataType).alias(c) for c in template.columns]
    log.upsert(day.select(*filled).repartition(32), "s", 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        compacted = log.compact(str(tmp_path / "compacted"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    base = f"{compacted.root}/base"
    noon = datetime(2024, 1, 31, 12)
    for column, low, high in (("Amount", 100.0, 150.0), ("TransactionDateTime", noon.timestamp(), (noon + timedelta(hours=1)).timestamp())):
        before = overlapping(f"{log.root}/batch", column, low, high)
        after = overlapping(base, column, low, high)
        assert before[0] == before[1]  # each file spans it all
        assert after[1] >= 20 and after[0] <= 0.4 * after[1], (column, before, after)
    both = compacted.snapshot().filter("Amount BETWEEN 100 AND 150")
    assert both.count() == log.snapshot().filter("Amount BETWEEN 100 AND 150").count()


def test_a_joined_merge_is_the_ordered_merge(spark):
    target = frame(spark, [row(1, 5, 10), row(2, 5, 20), row(4, 3, 40), row(None, 5, 30)])
    source = frame(spark, [row(1, 6, 11), row(2, 4, 21), row(3, 1, 31), row(3, 2, 32), row(None, 1, 41), row(None, 1, 42)])
    for late in (source, source.limit(0), source.withColumn("_topic_timestamp", F.lit(None).cast("timestamp"))):
        assert content(merge_joined(target, late, KEY, ORDER)) == content(merge_upsert(target, late, KEY, ORDER))
    assert content(merge_joined(target.limit(0), source, KEY, ORDER)) == content(merge_upsert(target.limit(0), source, KEY, ORDER))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_bucketed_base_is_not_shuffled(spark, tmp_path, no_broadcast):
    log = SilverLog(spark, str(tmp_path / "silver"))
    log.upsert(frame(spark, [row(k, 1, k) for k in range(200)]), "s", 0)
    table = log.compact_to_table(str(tmp_path / "buckets"), "silver_buckets", 16)
    table.upsert(frame(spark, [row(k, 2 if k % 2 else 0, k + 1000) for k in range(0, 250, 5)]), "s", 1)
    try:
        merged = table.snapshot()
        log.upsert(frame(spark, [row(k, 2 if k % 2 else 0, k + 1000) for k in range(0, 250, 5)]), "s", 1)
        assert content(merged) == content(log.snapshot())
        lines = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
        scan = next(i for i, line in enumerate(lines) if "silver_buckets" in line)
        depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
        above = []
        for line in reversed(lines[:scan]):  # the scan's ancestors: ever less indented
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                above.append(line)
                depth = own
        assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above)
    finally:
        spark.sql("DROP TABLE silver_buckets")
