from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rivulet.operators.latest import latest_per_key
from rivulet.operators.upsert import merge_upsert
from rivulet.schemas import KEY, ORDER, SILVER_ROW
from rivulet.sinks.silver_log import SilverLog

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def row(key, order, amount=0, date=0, batch=0):
    at = T0 + timedelta(hours=order)
    day = datetime(2024, 1, 1) + timedelta(days=date)
    return (key, amount, key, day, day.date(), "X", "Y", T0, at, batch, at, 0, order, 0)


def frame(spark, rows):
    schema = "TransactionId long, Amount int, CustomerId long, TransactionDateTime timestamp_ntz, TransactionDate date, "
    schema += "Location string, Status string, _processed_insert_timestamp timestamp, _raw_insert_timestamp timestamp, "
    schema += "_batch_id int, _topic_timestamp timestamp, _topic_partition int, _topic_offset long, _position int"
    return spark.createDataFrame(rows, schema).withColumn("Amount", F.col("Amount").cast("decimal(10,2)")).select(
        *SILVER_ROW.names
    )


def content(df):
    return sorted((r.TransactionId if r.TransactionId is not None else -1, int(r.Amount)) for r in df.collect())


def test_latest_takes_the_whole_tuple_and_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 2, 1), (1, 2, 3), (2, None, 5)], "k int, a int, b int")
    assert sorted(map(tuple, latest_per_key(df, "k", ["a", "b"]).collect())) == [(1, 2, 3), (2, None, 5)]


def test_latest_trims_a_hot_key_before_the_shuffle(spark):
    """A key with nearly all rows: each task ships one row of it."""
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("k"), F.col("id").alias("a")
    )
    latest = latest_per_key(df, "k", ["a"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert latest.count() == 10_001
    assert latest.filter("k = -1").first().a == 99_999


def test_replace_update_insert_keep(spark):
    target = frame(spark, [row(1, 5, 10), row(2, 5, 20), row(None, 5, 30)])
    source = frame(spark, [row(2, 1, 21), row(3, 1, 31), row(None, 1, 41)])
    assert content(merge_upsert(target, source, KEY)) == [(-1, 30), (-1, 41), (1, 10), (2, 21), (3, 31)]


def test_ordered_merge_keeps_the_newer_row(spark):
    target = frame(spark, [row(1, 5, 10), row(2, 5, 20)])
    source = frame(spark, [row(1, 6, 11), row(2, 4, 21), row(3, 1, 31), row(3, 2, 32), row(None, 1, 41), row(None, 1, 42)])
    assert content(merge_upsert(target, source, KEY, ORDER)) == [(-1, 41), (-1, 42), (1, 11), (2, 20), (3, 32)]


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    frame(spark, [row(k, 1, k) for k in range(100)]).write.parquet(f"{tmp_path}/t")
    frame(spark, [row(k, 2, k) for k in range(5)]).write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    for order in (None, ORDER):
        merged = merge_upsert(target, source, KEY, order)
        assert len(merged.collect()) == 100
        plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        if order is None:  # the only shuffle is that of the distinct keys
            assert plan.count("hashpartitioning(TransactionId") == 1


def test_rows_without_a_key_meet_no_join(spark, tmp_path):
    frame(spark, [row(k or None, 1, k) for k in range(9)]).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    merged = merge_upsert(target, target, KEY, ORDER)
    assert content(merged) == [(-1, 0), (-1, 0), *[(k, k) for k in range(1, 9)]]
    lines = merged._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(lines) if "Join Left" in line]
    assert len(joins) == 2 and all("Filter isnotnull(TransactionId" in lines[i + 1] for i in joins)


def test_a_repeated_source_key_costs_one_row_per_task(spark):
    source = spark.range(0, 300_000, 1, 8).select(F.lit(7).cast("long").alias(KEY), F.col("id").alias("v"))
    target = spark.range(10).select(F.col("id").alias(KEY), F.lit(-1).cast("long").alias("v"))
    merged = merge_upsert(target, source, KEY, ["v"])
    found = {r[0]: r[1] for r in merged.collect()}
    assert found == {**{k: -1 for k in range(10)}, 7: 299_999}


def test_large_source_merges_by_shuffle_once_per_side(spark, tmp_path):
    """Beyond the broadcast limit the target is shuffled, but only once for both joins."""
    frame(spark, [row(k, 5, k) for k in range(200)]).write.parquet(f"{tmp_path}/t")
    frame(spark, [row(k, k % 10, 1000 + k) for k in range(100, 300)]).write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    expected = content(merge_upsert(target, source, KEY, ORDER))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_upsert(target, source, KEY, ORDER)
        assert content(merged) == expected
        merged.collect()
        final = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final and "ReusedExchange" in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


# The log


@pytest.fixture
def log(spark, tmp_path):
    return SilverLog(spark, str(tmp_path / "silver"))


def test_empty_log(log):
    assert log.snapshot().count() == 0
    assert log.compact(f"{log.root}-2").snapshot().count() == 0


def test_batches_merge_on_read(spark, log):
    log.upsert(frame(spark, [row(1, 1, 10), row(2, 1, 20)]), "q", 0)
    log.upsert(frame(spark, [row(2, 2, 21), row(3, 2, 31)]), "q", 1)
    assert content(log.snapshot()) == [(1, 10), (2, 21), (3, 31)]


def test_a_batch_that_runs_again_replaces_itself(spark, log):
    for _ in range(2):
        log.upsert(frame(spark, [row(1, 1, 10), row(2, 1, 20)]), "q", 0)
        assert content(log.snapshot()) == [(1, 10), (2, 20)]
    log.upsert(frame(spark, [row(1, 1, 10)]), "q", 0)
    assert content(log.snapshot()) == [(1, 10)]


def test_a_new_query_may_reuse_batch_ids(spark, log):
    log.upsert(frame(spark, [row(1, 1, 10)]), "q", 0)
    log.upsert(frame(spark, [row(1, 9, 99)]), "r", 0)
    assert content(log.snapshot()) == [(1, 99)]


def processed(rows, hour):
    return rows.withColumn("_processed_insert_timestamp", F.lit(T0 + timedelta(hours=hour)))


def test_late_batch_and_the_guard(spark, tmp_path):
    newer, older = frame(spark, [row(1, 5, 50)]), frame(spark, [row(1, 1, 10), row(2, 1, 20)])
    for guard, expected in [(True, [(1, 50), (2, 20)]), (False, [(1, 10), (2, 20)])]:
        log = SilverLog(spark, str(tmp_path / f"silver-{guard}"), order_guard=guard)
        log.upsert(processed(newer, 0), "q", 0)
        log.upsert(processed(older, 1), "q", 1)
        assert content(log.snapshot()) == expected
        log = log.compact(f"{log.root}-2")
        assert content(log.snapshot()) == expected
        log.upsert(processed(frame(spark, [row(2, 0, 1)]), 2), "q", 2)
        assert content(log.snapshot()) == [expected[0], (2, 20) if guard else (2, 1)]


def test_changed_date_leaves_nothing_behind(spark, log):
    log.upsert(frame(spark, [row(1, 1, 10, date=0)]), "q", 0)
    log = log.compact(f"{log.root}-2")
    log.upsert(frame(spark, [row(1, 2, 11, date=1)]), "q", 1)
    for _ in range(2):
        assert [(str(r.TransactionDate), int(r.Amount)) for r in log.snapshot().collect()] == [("2024-01-02", 11)]
        log = log.compact(f"{log.root}-2")


def test_fixed_dates_prune_partitions(spark, log):
    log.upsert(frame(spark, [row(k, 1, k, date=k % 5) for k in range(20)]), "q", 0)
    log = log.compact(f"{log.root}-2")
    log.upsert(frame(spark, [row(k, 2, 100 + k, date=k % 5) for k in range(10)]), "q", 1)
    one_day = log.snapshot(fixed_dates=True).filter("TransactionDate = date'2024-01-03'")
    assert content(one_day) == [(2, 102), (7, 107), (12, 12), (17, 17)]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TransactionDate#") and "PartitionFilters: [isnotnull(TransactionDate" in plan
    assert content(log.snapshot(fixed_dates=True)) == content(log.snapshot())


def test_a_hot_date_is_split_over_tasks(spark, log):
    """All rows on one date: rebalancing cuts them by size, each task writes its part."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    one = row(1, 1)
    rows = spark.range(0, 200_000, 1, 8).select(
        F.col("id").alias(KEY),
        F.col("id").cast("decimal(10,2)").alias("Amount"),
        F.col("id").alias("CustomerId"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("TransactionDateTime"),
        F.lit(one[4]).alias("TransactionDate"),
        F.lit("X").alias("Location"),
        F.lit("Y").alias("Status"),
        F.lit(T0).alias("_processed_insert_timestamp"),
        F.lit(T0).alias("_raw_insert_timestamp"),
        F.lit(0).alias("_batch_id"),
        F.lit(T0).alias("_topic_timestamp"),
        F.lit(0).alias("_topic_partition"),
        F.col("id").alias("_topic_offset"),
        F.lit(0).alias("_position"),
    )
    spark.conf.set(size, "1MB")
    try:
        log.upsert(rows, "q", 0)
    finally:
        spark.conf.set(size, before)
    assert len(log.snapshot().inputFiles()) > 3
    assert log.snapshot().count() == 200_000


def test_null_dates_are_kept_once(spark, log):
    def undated(order, amount):
        return (1, amount, 1, None, None, *row(1, order, amount)[5:])

    log.upsert(frame(spark, [undated(1, 10)]), "q", 0)
    log = log.compact(f"{log.root}-2")
    log.upsert(frame(spark, [undated(2, 11)]), "q", 1)
    assert content(log.snapshot()) == content(log.snapshot(fixed_dates=True)) == [(1, 11)]


def test_compaction_clusters_by_amount_within_the_date(spark, log):
    log.upsert(frame(spark, [row(k, 1, 997 * k % 1000, date=k % 3) for k in range(300)]), "q", 0)
    before = content(log.snapshot())
    log = log.compact(f"{log.root}-2")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        log.compact(log.root)
    base = spark.read.parquet(f"{log.root}/base").withColumn("file", F.input_file_name())
    ranges = base.groupBy("TransactionDate", "file").agg(F.min("Amount").alias("lo"), F.max("Amount").alias("hi"))
    by_date = {}
    for r in ranges.collect():
        by_date.setdefault(r.TransactionDate, []).append((r.lo, r.hi))
    for spans in by_date.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert content(log.snapshot()) == before
    plan = log.snapshot()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(st.tuples(st.integers(1, 6), st.integers(0, 1000), st.integers(0, 2)), min_size=1, max_size=8),
        min_size=1,
        max_size=4,
    ),
    st.sets(st.integers(0, 3)),
)
def test_folding_batches_equals_one_global_latest(spark, tmp_path_factory, batches, compact_after):
    log = SilverLog(spark, str(tmp_path_factory.mktemp("fold")))
    everything, serial = [], 0
    for batch_id, drawn in enumerate(batches):
        rows = []
        for key, order, date in drawn:
            serial += 1
            rows.append(row(key, order * 100 + serial % 100, serial, date))
        everything += rows
        log.upsert(latest_per_key(frame(spark, rows), KEY, ORDER), "q", batch_id)
        if batch_id in compact_after:
            log = log.compact(f"{log.root}-2")
    expected = {}
    for r in everything:
        if r[0] not in expected or r[12] > expected[r[0]][0]:
            expected[r[0]] = (r[12], r[1])
    assert content(log.snapshot()) == sorted((k, amount) for k, (_, amount) in expected.items())


def test_the_range_of_amounts_needs_no_merge(spark, tmp_path):
    """A compaction merges for its rows, not once more for the ends of its clusters."""
    log = SilverLog(spark, str(tmp_path / "silver"))
    for batch_id in range(2):
        log.upsert(frame(spark, [row(1, 1), row(2, 2)]), "s", batch_id)
    ends = log._amount_ends()
    plan = ends._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    merged = log.snapshot().agg(F.min("Amount").alias("low"), F.max("Amount").alias("high")).first()
    found = ends.first()
    assert found.low is None or (found.low <= merged.low and found.high >= merged.high)
