import fnmatch
import os
import time
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from documents import CASES, SAMPLE, data, transaction
from helpers import bronze, documents, envelope, message, topic
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rivulet.functions.audit import batch_time
from rivulet.operators.topic import project_topic
from rivulet.plans.refine import refine
from rivulet.schemas import BRONZE, BRONZE_FAILED, FAILED_BATCH, MALFORMED, REJECTED, TOPIC
from rivulet.sinks.bronze import append_bronze
from rivulet.sinks.silver_log import SilverLog
from rivulet.sinks.topic import kafka_writer
from rivulet.sources.files import (
    dates_from,
    read_bronze,
    read_merged,
    read_merged_bronze,
    read_table,
    stream_bronze,
    stream_topic_log,
    stream_transactions,
)
from rivulet.sources.kafka import kafka_options, stream_kafka
from rivulet.streaming import bronze as bronze_job
from rivulet.streaming import silver as silver_job
from rivulet.streaming.bronze import start_bronze
from rivulet.streaming.common import DRAIN, query_id
from rivulet.streaming.landing import land_to_kafka, land_to_log
from rivulet.streaming.silver import process_batch, replay_failed_batches, start_silver
from rivulet.streaming.supervise import AttemptsExhausted, run_with_restarts


def land(path, name, content):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "wb") as file:
        file.write(content if isinstance(content, bytes) else content.encode())


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def to_bronze(spark, zones, *texts, hour=0, first_offset=0):
    """Appends one document per text to bronze, as one batch."""
    records = topic(spark, [message(envelope(t), first_offset + i, key=f"/in/{i}") for i, t in enumerate(texts)])
    append_bronze(records, zones.bronze, batch_time(datetime(2024, 1, 31, hour, tzinfo=timezone.utc)))


def batches(table):
    """The folders of the batches in silver."""
    return sorted(Path(table.root).glob("batch/*/*"))


def amounts(table):
    return {r.TransactionId: float(r.Amount) for r in table.snapshot().collect()}


# Landing


def run_landing(spark, zones):
    drain(land_to_log(spark, zones.landing, zones.topic_log, "t", zones.checkpoint("landing"), DRAIN))


def test_landing_reads_each_file_once(spark, zones):
    land(zones.landing, "a.xml", SAMPLE)
    land(zones.landing, "b.xml", data())
    land(zones.landing, "empty.xml", "")
    land(zones.landing, "_hidden.xml", SAMPLE)
    run_landing(spark, zones)
    run_landing(spark, zones)
    land(zones.landing, "c.xml", data(transaction()))
    run_landing(spark, zones)
    log = spark.read.schema(TOPIC).option("recursiveFileLookup", "true").parquet(zones.topic_log)
    assert sorted(os.path.basename(r.key) for r in log.collect()) == ["a.xml", "b.xml", "c.xml"]
    assert log.select("topic", "partition", "offset").distinct().count() == 3
    newest = log.orderBy(F.col("offset").cast("long").desc()).first()
    assert newest.key.endswith("c.xml")


def test_offsets_grow_even_with_a_lost_checkpoint(spark, zones):
    land(zones.landing, "a.xml", SAMPLE)
    for checkpoint in ("one", "two"):
        drain(land_to_log(spark, zones.landing, zones.topic_log, "t", zones.checkpoint(checkpoint), DRAIN))
    log = spark.read.schema(TOPIC).option("recursiveFileLookup", "true").parquet(zones.topic_log)
    assert log.count() == 2 and log.select("offset").distinct().count() == 2


def test_kafka_needs_its_package(spark, zones):
    os.makedirs(zones.landing)
    with pytest.raises(AnalysisException, match="kafka"):
        stream_kafka(spark, "host:9092", "t")
    with pytest.raises(AnalysisException, match="kafka"):
        land_to_kafka(spark, zones.landing, "host:9092", "t", zones.checkpoint("landing"), DRAIN)
    assert kafka_options("h:1", "t", maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5",
    }
    assert kafka_writer(spark.readStream.format("rate").load(), "h:1", "t") is not None


# Bronze


def test_project_topic_is_all_text(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray("ä".encode()), "t", 3, 9, datetime(2024, 1, 1), 0)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp, timestampType int",
    )
    projected = project_topic(raw)
    assert projected.schema == TOPIC
    assert tuple(projected.first())[:5] == ("k", "ä", "t", "3", "9")


def test_bronze_job_appends_under_date_and_hour(spark, zones):
    topic(spark, [message(envelope(SAMPLE), i) for i in range(3)]).write.parquet(zones.topic_log)
    for _ in range(2):
        stream = stream_topic_log(spark, zones.topic_log)
        drain(start_bronze(stream, zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN))
    rows = read_bronze(spark, zones.bronze)
    assert rows.schema == BRONZE and rows.count() == 3
    assert rows.select("_raw_insert_timestamp", "_raw_insert_date", "_raw_insert_hour").distinct().count() == 1
    assert rows.filter("_raw_insert_hour <> date_format(_raw_insert_timestamp, 'HH')").isEmpty()
    assert rows.filter("_raw_insert_date <> to_date(_raw_insert_timestamp)").isEmpty()
    assert read_merged(spark, zones.bronze).count() == 3


def test_leading_zero_of_the_hour_survives(spark, zones):
    to_bronze(spark, zones, SAMPLE, hour=5)
    assert os.path.isdir(f"{zones.bronze}/_raw_insert_date=2024-01-31/_raw_insert_hour=05")
    assert read_bronze(spark, zones.bronze).first()._raw_insert_hour == "05"


def test_failed_bronze_batch_keeps_its_payloads(spark, zones, monkeypatch):
    def fail(*_):
        raise OSError("disk gone")

    monkeypatch.setattr(bronze_job, "append_bronze", fail)
    for _ in range(2):  # the same batch twice: letters are replaced, not doubled
        bronze_job.process_batch(topic(spark, [message("x"), message("y", 1)]), 4, zones.bronze, zones.bronze_failed, "q")
    letters = read_table(spark, zones.bronze_failed, BRONZE_FAILED).collect()
    assert sorted(r.xml_data for r in letters) == ["x", "y"]
    assert all("disk gone" in r._raw_error_text and r._batch_id == 4 and r._source == "q" for r in letters)


def test_bronze_failure_of_the_letters_is_raised(spark, monkeypatch):
    with pytest.raises(Exception, match="no-such"):
        bronze_job.process_batch(topic(spark, [message("x")]), 0, "no-such://a", "no-such://b", "q")


def test_empty_batches_do_nothing(spark, zones):
    bronze_job.process_batch(topic(spark, []), 0, zones.bronze, zones.bronze_failed, "q")
    process_batch(bronze(spark, []), 0, "q", SilverLog(spark, zones.silver), zones)
    assert not os.path.exists(zones.bronze) and not os.path.exists(zones.silver)


# Silver


def test_silver_job_drains_resumes_and_updates(spark, zones):
    table = SilverLog(spark, zones.silver)
    to_bronze(spark, zones, data(transaction("1", "10"), transaction("2", "20")), hour=1)
    drain(start_silver(spark, zones, table))
    assert amounts(table) == {1: 10, 2: 20}
    drain(start_silver(spark, zones, table))  # nothing new
    assert len(batches(table)) == 1
    to_bronze(spark, zones, data(transaction("2", "21"), transaction("3", "31")), hour=2)
    drain(start_silver(spark, zones, table))
    assert amounts(table) == {1: 10, 2: 21, 3: 31}
    assert {r._batch_id for r in table.snapshot().collect()} == {0, 1}


@pytest.mark.parametrize("limit", [{"maxFilesPerTrigger": "1"}, {"maxBytesPerTrigger": "1"}])
def test_backlog_in_bounded_batches(spark, zones, limit):
    table = SilverLog(spark, zones.silver)
    for i in range(3):
        to_bronze(spark, zones, data(transaction(str(i))), hour=i)
    drain(start_silver(spark, zones, table, **limit))
    assert len(batches(table)) == 3 and set(amounts(table)) == {0, 1, 2}


def test_since_leaves_out_older_dates(spark, zones):
    table = SilverLog(spark, zones.silver)
    for day in (29, 30, 31):
        at = batch_time(datetime(2024, 1, day, 5, tzinfo=timezone.utc))
        append_bronze(topic(spark, [message(envelope(data(transaction(str(day)))), day)]), zones.bronze, at)
    drain(start_silver(spark, zones, table, since=date(2024, 1, 30)))
    assert set(amounts(table)) == {30, 31}
    later = batch_time(datetime(2024, 2, 1, tzinfo=timezone.utc))
    append_bronze(topic(spark, [message(envelope(data(transaction("32"))), 32)]), zones.bronze, later)
    drain(start_silver(spark, zones, table, since=date(2024, 1, 31)))  # same checkpoint: nothing twice
    assert set(amounts(table)) == {30, 31, 32} and len(batches(table)) == 2
    stream = stream_bronze(spark, zones.bronze, date(2024, 2, 1))
    query = stream.writeStream.format("memory").queryName("since").trigger(availableNow=True).start()
    drain(query)
    row = spark.table("since").first()
    assert (str(row._raw_insert_date), row._raw_insert_hour) == ("2024-02-01", "00")


@pytest.mark.parametrize("first", ["2024-01-30", "2019-12-31", "2024-09-09", "1999-10-01"])
def test_date_patterns_match_that_day_and_all_later_ones(first):
    day = date.fromisoformat(first)
    patterns = dates_from(day)
    for offset in list(range(-800, 800)) + [-5000, -3000, 3000, 9000]:
        other = day + timedelta(days=offset)
        assert any(fnmatch.fnmatchcase(other.isoformat(), p) for p in patterns) == (other >= day), other


def test_a_batch_knows_its_query(spark, zones):
    to_bronze(spark, zones, SAMPLE)
    seen = []

    def write(batch, _):
        seen.append(query_id(batch.sparkSession, "/no/such/checkpoint"))

    stream = stream_bronze(spark, zones.bronze).writeStream.foreachBatch(write)
    query = stream.option("checkpointLocation", zones.checkpoint("seen")).trigger(availableNow=True).start()
    drain(query)
    assert seen == [query.id]


def test_grown_columns_are_read(spark, zones):
    assert read_merged_bronze(spark, zones.bronze).schema == BRONZE
    to_bronze(spark, zones, SAMPLE, hour=5)
    grown = topic(spark, [message("x", 1)]).withColumn("headers", F.lit("h"))
    append_bronze(grown, zones.bronze, batch_time(datetime(2024, 1, 31, 6, tzinfo=timezone.utc)))
    rows = {r._raw_insert_hour: r.headers for r in read_merged_bronze(spark, zones.bronze).collect()}
    assert rows == {"05": None, "06": "h"}


def test_bronze_files_per_batch(spark, zones):
    records = topic(spark, [message("x", i) for i in range(64)]).repartition(16)
    assert append_bronze(records, zones.bronze, batch_time(), files=2) == 64
    assert len(read_bronze(spark, zones.bronze).inputFiles()) == 2


def test_lost_checkpoint_reprocesses_without_harm(spark, zones, tmp_path):
    table = SilverLog(spark, zones.silver)
    to_bronze(spark, zones, data(transaction("1", "10")), hour=1)
    to_bronze(spark, zones, data(transaction("1", "11")), hour=2)
    drain(start_silver(spark, zones, table))
    first = query_id(spark, zones.checkpoint("processed"))
    os.rename(zones.checkpoint("processed"), str(tmp_path / "lost"))
    drain(start_silver(spark, zones, table, maxFilesPerTrigger="1"))
    assert query_id(spark, zones.checkpoint("processed")) != first
    assert len(batches(table)) > 1
    assert amounts(table) == {1: 11}


def test_dead_letters_of_a_mixed_batch(spark, zones):
    table = SilverLog(spark, zones.silver)
    batch = bronze(spark, [message(envelope(c[0]), i, key=name) for i, (name, c) in enumerate(CASES.items())])
    for _ in range(2):  # the batch again, as after a crash before its commit
        process_batch(batch, 7, "q", table, zones)
    malformed = read_table(spark, zones.malformed, MALFORMED).collect()
    assert {r.key: r._reason for r in malformed} == {n: c[2] for n, c in CASES.items() if c[1] == "malformed"}
    assert len(malformed) == sum(c[1] == "malformed" for c in CASES.values())
    by_key = {r.key: r for r in malformed}
    assert by_key["junk"]._corrupt_file == by_key["junk"].xml_content == "not xml"
    assert bytes(by_key["junk"].decoded_content) == b"not xml"
    assert by_key["junk"].json_data.path == "/in/a.xml"
    assert by_key["junk"]._batch_id == 7 and by_key["junk"]._source == "q"
    assert len(by_key["junk"]._error_insert_hour) == 2
    rejected = read_table(spark, zones.rejected, REJECTED).collect()
    assert len(rejected) == sum(c[4] for c in CASES.values())
    reasons = {r.key: r._reason for r in rejected}
    assert reasons["badid"] == reasons["badts"] == reasons["badcust"] == reasons["timeonly"] == "bad_type"
    assert reasons["nokey"] == reasons["blankkey"] == reasons["nothing"] == "null_key"
    assert {r.transaction.TransactionId for r in rejected if r.key == "badid"} == {"abc"}
    assert len(batches(table)) == 1
    assert None not in amounts(table)


def test_letters_are_gathered_into_few_files(spark, zones):
    batch = documents(spark, *["junk"] * 32, *[data(transaction("abc"))] * 32).repartition(16)
    process_batch(batch, 0, "q", SilverLog(spark, zones.silver), zones)
    for path, schema in ((zones.malformed, MALFORMED), (zones.rejected, REJECTED)):
        letters = read_table(spark, path, schema)
        assert letters.count() == 32 and len(letters.inputFiles()) == 1


def test_failed_batch_is_kept_swallowed_and_replayed(spark, zones):
    table = SilverLog(spark, zones.silver)

    def poisoned(rows):
        if not rows.filter("_raw_insert_hour = '02'").isEmpty():
            raise ValueError("poisoned")
        return refine(rows)

    for hour, amount in [(1, "10"), (2, "20"), (3, "30")]:
        to_bronze(spark, zones, data(transaction("1", amount), transaction(f"1{hour}", amount)), hour=hour)
        drain(start_silver(spark, zones, table, refine_rows=poisoned))
    assert amounts(table) == {1: 30, 11: 10, 13: 30}
    failed = read_table(spark, zones.failed_batches, FAILED_BATCH).collect()
    assert [(r._batch_id, r.error_message) for r in failed] == [(1, "poisoned")]
    assert "ValueError" in failed[0]._traceback and failed[0].value is not None
    for _ in range(2):
        counts = replay_failed_batches(spark, zones, table)
        assert counts.documents == 1 and counts.valid == 2
        # The replayed batch is older than the third one: only its own key is new.
        assert amounts(table) == {1: 30, 11: 10, 12: 20, 13: 30}
    assert {r.TransactionId: r._batch_id for r in table.snapshot().collect()}[12] == 1


def test_a_second_replay_writes_no_letter_twice(spark, zones):
    table = SilverLog(spark, zones.silver)

    def broken(_):
        raise ValueError("no")

    batch = documents(spark, "junk", data(transaction("abc"), transaction("5")))
    process_batch(batch, 4, "q", table, zones, refine_rows=broken)
    for _ in range(2):
        counts = replay_failed_batches(spark, zones, table)
        assert (counts.malformed, counts.rejected, counts.valid) == (1, 1, 1)
        assert read_table(spark, zones.malformed, MALFORMED).count() == 1
        assert read_table(spark, zones.rejected, REJECTED).count() == 1
    assert set(amounts(table)) == {5}


def test_files_of_any_age_are_read(spark, zones):
    """A file nine days older than one seen before still lands, and bronze files of that age still reach silver."""
    now = time.time()
    for name, age_days in (("a", 0), ("b", 9), ("c", 0)):
        land(zones.landing, f"{name}.xml", data(transaction("1")))
        os.utime(f"{zones.landing}/{name}.xml", (now - age_days * 86_400,) * 2)
        drain(land_to_log(spark, zones.landing, zones.topic_log, "t", zones.checkpoint("landing"), DRAIN))
    keys = [r.key for r in spark.read.schema(TOPIC).option("recursiveFileLookup", "true").parquet(zones.topic_log).collect()]
    assert sorted(os.path.basename(k) for k in keys) == ["a.xml", "b.xml", "c.xml"]
    table = SilverLog(spark, zones.silver)
    for hour, age_days in ((1, 0), (2, 9), (3, 0)):
        before = set(Path(zones.bronze).rglob("*.parquet")) if os.path.exists(zones.bronze) else set()
        to_bronze(spark, zones, data(transaction(str(hour))), hour=hour)
        for path in set(Path(zones.bronze).rglob("*.parquet")) - before:
            os.utime(path, (now - age_days * 86_400,) * 2)
        drain(start_silver(spark, zones, table))
    assert set(amounts(table)) == {1, 2, 3}


def test_replay_can_be_narrowed(spark, zones):
    table = SilverLog(spark, zones.silver)

    def broken(_):
        raise ValueError("no")

    for batch_id in range(2):
        process_batch(documents(spark, data(transaction(str(batch_id)))), batch_id, "q", table, zones, refine_rows=broken)
    replay_failed_batches(spark, zones, table, F.col("_batch_id") == 1)
    assert set(amounts(table)) == {1}


def test_replay_needs_the_guard(spark, zones):
    with pytest.raises(ValueError, match="guard"):
        replay_failed_batches(spark, zones, SilverLog(spark, zones.silver, order_guard=False))


def test_failing_letters_fail_the_query(spark, zones, monkeypatch):
    monkeypatch.setattr(silver_job, "write_failed_batch", lambda *_: (_ for _ in ()).throw(OSError("dlq gone")))

    def broken(_):
        raise ValueError("no")

    to_bronze(spark, zones, SAMPLE)
    query = start_silver(spark, zones, SilverLog(spark, zones.silver), refine_rows=broken)
    with pytest.raises(Exception, match="dlq gone"):
        query.awaitTermination()


def test_nothing_stays_cached(spark, zones):
    process_batch(documents(spark, SAMPLE), 0, "q", SilverLog(spark, zones.silver), zones)
    assert spark._jsparkSession.sharedState().cacheManager().isEmpty()


def test_three_jobs_end_to_end(spark, zones):
    land(zones.landing, "a.xml", SAMPLE)
    land(zones.landing, "b.xml", "<Data><Tra")
    run_landing(spark, zones)
    stream = stream_topic_log(spark, zones.topic_log)
    drain(start_bronze(stream, zones.bronze, zones.bronze_failed, zones.checkpoint("raw"), DRAIN))
    table = SilverLog(spark, zones.silver)
    drain(start_silver(spark, zones, table))
    assert amounts(table) == {501: 20.1, 77: 640.0}
    assert read_table(spark, zones.malformed, MALFORMED).count() == 1


# Large documents


def test_row_reader_shows_what_it_could_not_read(spark, tmp_path):
    land(str(tmp_path / "x"), "one.xml", data(transaction("1"), transaction("2")))
    land(str(tmp_path / "x"), "roots.xml", data(transaction("3")) + data(transaction("4")))
    query = (
        stream_transactions(spark, str(tmp_path / "x"))
        .writeStream.format("memory")
        .queryName("rows")
        .trigger(availableNow=True)
        .start()
    )
    drain(query)
    rows = spark.table("rows").collect()
    assert {r.TransactionId for r in rows if r._corrupt_record is None} == {"1", "2", "3"}
    assert any(r._corrupt_record for r in rows)


# Supervision


class FakeQuery:
    def __init__(self, error=None):
        self.error = error

    def awaitTermination(self):
        if self.error:
            raise self.error


def test_restarts_until_it_ends():
    queries = [FakeQuery(OSError("a")), FakeQuery(ValueError("b")), FakeQuery()]
    slept = []
    outcome = run_with_restarts(lambda: queries.pop(0), sleep=slept.append)
    assert outcome.attempts == 3 and slept == [10.0, 10.0]


def test_attempts_are_bounded():
    slept = []
    with pytest.raises(AttemptsExhausted, match="3 attempt") as caught:
        run_with_restarts(lambda: FakeQuery(OSError("a")), max_attempts=3, sleep=slept.append)
    assert isinstance(caught.value.__cause__, OSError) and len(slept) == 2


def test_failure_to_start_counts_too():
    def start():
        raise RuntimeError("no source")

    with pytest.raises(AttemptsExhausted):
        run_with_restarts(start, max_attempts=2, sleep=lambda _: None)
